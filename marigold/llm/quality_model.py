"""Quality classifier: evidence of the document itself, combined with what is known of its site and path.

1. Two logistic models (good quality, toxic) are fitted on at most ``SAMPLE`` labelled documents, drawn by a hash of
   their id. Features are shares that describe a text's shape, and counts of at most ``FEATURES`` words and word beginnings
   that are most over-represented in one of the two bad classes. The driver sees the sample's features, never texts.
2. Every document is scored in one pass. Its evidence is the log odds of being good, without the sample's prior.
3. Hierarchical empirical Bayes: good documents are counted by path, and paths by site (labels where there are any,
   the classifier's probability elsewhere, which weighs less). A site's rate is shrunk towards the global rate and a
   path's towards its site's; how strongly is estimated from how much the groups differ beyond chance, so that
   sparse groups stay near their parent.
4. The posterior log odds are the evidence plus the log odds of the path's rate; a document is kept from even odds.

Defined cases: null and empty texts are scored by their shape and fall to what the sample says of texts without words;
null sites and paths are groups of their own; several labels of one id count as bad if any is; rows with one id are
scored one by one; without labels there is no evidence and everything is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marigold.llm.text import column, fresh
from marigold.staging import stage

SAMPLE = 20_000
SAMPLE_FILES = 32
FEATURES = 1024
MIN_DOCUMENTS = 5
MIN_Z = 5.0
SOFT_WEIGHT = 0.2
PREFIXES = (4, 5, 6, 7)
REMEMBERED = 300_000
LETTERS = re.compile(r"[^\W\d_]+")
SHAPES = 12


def shape(text: str) -> list[float]:
    """Shares between 0 and 1, by their square roots, which tell small ones apart."""
    words, lines = text.split(), [line for line in text.split("\n") if line.strip()]
    n, size = max(1, len(words)), max(1, len(text))
    shares = (
        sum(map(text.count, "#*$%&<>{}")) / size,
        text.count("|") / n,
        text.count("!!") / n,
        sum(map(str.isupper, words)) / n,
        1 - len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(map(str.isalpha, words)) / n,
        min(1.0, size / n / 40),
        1 / n,
        float(not words),
    )
    return [*(min(1.0, s) ** 0.5 for s in shares), min(1.0, np.log1p(len(words)) / 12)]


def parts(word: str) -> list[str]:
    """A word, and its beginnings (marked) of some lengths."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) >= k)]


class Reader:
    """Feature vectors of texts for a fixed list of words and beginnings."""

    def __init__(self, vocabulary: list[str]):
        self.places = {v: i for i, v in enumerate(vocabulary)}
        self.met: dict[str, tuple[int, ...]] = {}

    def _hits(self, word: str) -> tuple[int, ...]:
        hits = self.met.get(word)
        if hits is None:
            if len(self.met) >= REMEMBERED:
                self.met.clear()
            hits = self.met[word] = tuple(self.places[p] for p in parts(word) if p in self.places)
        return hits

    def vector(self, text: str | None) -> np.ndarray:
        text = text or ""
        out = np.zeros(SHAPES + len(self.places), dtype=np.float32)
        out[:SHAPES] = shape(text)
        for word, times in Counter(LETTERS.findall(text.lower())).items():
            for hit in self._hits(word):
                out[SHAPES + hit] += times
        np.log1p(out[SHAPES:], out=out[SHAPES:])
        return out


def matrix(table: pa.Table, width: int) -> np.ndarray:
    """The vectors of a column of half-precision rows, written batch by batch into one array."""
    x, at = np.empty((len(table), width), dtype=np.float32), 0
    for chunk in table["x"].chunks:
        for raw in chunk:
            x[at] = np.frombuffer(raw.as_buffer(), dtype="<f2")
            at += 1
    return x


def standardise(x: np.ndarray, rows: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Shift and scale the columns in place; returns what was taken off and divided by."""
    mean = x.mean(axis=0, dtype=np.float64)
    squares = np.zeros(x.shape[1])
    for i in range(0, len(x), rows):
        squares += np.square(x[i : i + rows] - mean).sum(axis=0)
    scale = np.sqrt(squares / max(1, len(x))) + 1e-3
    for i in range(0, len(x), rows):
        x[i : i + rows] = (x[i : i + rows] - mean) / scale
    return mean, scale


def fit(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, y: np.ndarray, rounds: int = 400, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and offset of a logistic model, by Adam's rule on all rows, for features before they were standardised."""
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w, b = np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, rounds + 1):
        off = 1 / (1 + np.exp(-np.clip(x @ w.astype(np.float32) + b, -30, 30))) - y
        slope = np.append(x.T @ off.astype(np.float32) / len(y) + decay * w, off.mean())
        m, v = 0.9 * m + 0.1 * slope, 0.999 * v + 0.001 * slope**2
        step = 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    w = w / scale
    return w, float(b - mean @ w)


class Model:
    """What a worker needs to score texts."""

    def __init__(self, vocabulary: list[str], good: tuple[np.ndarray, float], toxic: tuple[np.ndarray, float], prior: float):
        self.vocabulary, self.good, self.toxic, self.prior = vocabulary, good, toxic, prior

    def evidence(self, vectors: np.ndarray) -> np.ndarray:
        """Log odds of good quality and not toxic, without the prior."""
        good, toxic = (1 / (1 + np.exp(-np.clip(vectors @ w + b, -30, 30))) for w, b in (self.good, self.toxic))
        p = np.clip(good * (1 - toxic), 1e-9, 1 - 1e-9)
        return np.log(p / (1 - p)) - np.log(self.prior / (1 - self.prior))


def _labels(labels: DataFrame) -> DataFrame:
    """One row per id that has both labels."""
    rows = labels.filter("doc_id is not null and quality is not null and toxic is not null")
    return rows.groupBy(F.col("doc_id").alias("id")).agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, features: int = FEATURES) -> Model | None:
    """The models, from at most ``sample`` labelled rows of ``doc_id, text``; none without labels."""
    drawn = _labels(labels).orderBy(F.xxhash64("id"), "id").limit(sample)
    rows = docs.join(F.broadcast(drawn), F.col("doc_id") == F.col("id")).select("doc_id", "text", "quality", "toxic")  # at most ``sample`` rows
    rows = stage(rows.orderBy(F.xxhash64("doc_id"), F.xxhash64("text")).limit(sample).drop("doc_id").repartition(SAMPLE_FILES), "sample")

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, quality, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                for part in {p for w in set(LETTERS.findall((text or "").lower())) for p in parts(w)}:
                    cell = counts.setdefault(part, [0, 0, 0])
                    cell[0] += 1
                    cell[1] += int(quality == 0)
                    cell[2] += int(toxic == 1)
            columns = list(zip(*counts.values())) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], names=["part", "n", "bad", "toxic"])

    totals = rows.agg(F.count("*"), F.sum(F.expr("int(quality = 0)")), F.sum(F.expr("int(toxic = 1)"))).first()
    if not totals[0]:
        return None
    counts = rows.mapInArrow(met, "part string, n long, bad long, toxic long").groupBy("part").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.sum("toxic").alias("toxic"))

    def z(name: str, total: int) -> Column:
        expected = F.col("n") * (max(1, total) / totals[0])
        return (F.col(name) - expected) / F.sqrt(expected)

    best = counts.filter(F.col("n") >= MIN_DOCUMENTS).withColumn("z", F.greatest(z("bad", totals[1]), z("toxic", totals[2])))
    vocabulary = [r["part"] for r in best.filter(F.col("z") >= MIN_Z).orderBy(F.desc("z"), "part").limit(features).collect()]

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(vocabulary)
        for batch in batches:
            raw = [reader.vector(t).astype("<f2").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), batch.column(1).cast(pa.int64()), batch.column(2).cast(pa.int64())], names=["x", "quality", "toxic"])

    # At most ``sample`` rows of half-precision vectors, held once in single precision and standardised in place.
    table = rows.mapInArrow(vectors, "x binary, quality long, toxic long").toArrow()
    quality, toxic = table["quality"].to_numpy(), table["toxic"].to_numpy()
    x = matrix(table, SHAPES + len(vocabulary))
    del table
    prior = float(np.clip(((quality == 1) & (toxic == 0)).mean(), 1e-3, 1 - 1e-3))
    mean, scale = standardise(x)
    return Model(vocabulary, fit(x, mean, scale, (quality == 1).astype(float)), fit(x, mean, scale, (toxic == 1).astype(float)), prior)


def _shrunk(groups: DataFrame, parent: Column) -> DataFrame:
    """Adds ``rate``: the group's share of good, shrunk to ``parent``.

    The strength (in documents) is that of the beta distribution with the variance that groups show beyond binomial chance.
    """
    weight, gap = F.col("n"), F.col("good") / F.col("n") - parent
    sums = groups.withColumn("parent", parent).agg(
        F.sum(weight * gap * gap).alias("between"), F.sum(F.col("parent") * (1 - F.col("parent"))).alias("chance"), F.sum("n").alias("n"),
        F.avg(F.col("parent") * (1 - F.col("parent"))).alias("spread"),
    ).first()
    if not sums["n"]:
        strength = 1.0
    else:
        beyond = max(0.0, (sums["between"] - sums["chance"]) / max(1e-9, sums["n"]))
        strength = min(1e6, max(1.0, sums["spread"] / beyond - 1)) if beyond > 0 else 1e6
    return groups.withColumn("rate", (F.col("good") + strength * parent) / (F.col("n") + strength))


def score(df: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", doc_id: str = "doc_id", site: str = "source", path: str = "lang") -> DataFrame:
    """The columns in ``keep`` with ``evidence, site_rate, path_rate, score, kept`` for every row."""
    (packed,) = fresh(df, "packed")
    docs = df.select(column(df, doc_id).alias("doc_id"), column(df, text).alias("text"))
    model = train(docs, labels)
    rows = df.select(
        F.struct(*[column(df, c) for c in keep]).alias(packed),
        column(df, doc_id).alias("doc_id"),
        F.coalesce(column(df, site).cast("string"), F.lit("\0")).alias("site"),
        F.coalesce(column(df, path).cast("string"), F.lit("\0")).alias("path"),
        column(df, text).alias("text"),
    )

    @F.pandas_udf("double")
    def evidence(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        reader = Reader(model.vocabulary)
        for chunk in texts:
            found = [model.evidence(np.stack([reader.vector(t) for t in chunk[i : i + 256]])) for i in range(0, len(chunk), 256)]
            yield pd.Series(np.concatenate(found) if found else np.zeros(0))

    seen = rows.withColumn("evidence", evidence("text") if model else F.lit(0.0)).drop("text")
    seen = stage(seen, "evidence")
    prior = model.prior if model else 0.5
    chance = 1 / (1 + F.exp(-(F.col("evidence") + float(np.log(prior / (1 - prior))))))
    known = seen.join(_labels(labels), F.col("doc_id") == F.col("id"), "left")
    weight = F.when(F.col("id").isNotNull(), F.lit(1.0)).otherwise(F.lit(SOFT_WEIGHT if model else 0.0))
    is_good = F.when(F.col("id").isNotNull(), ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("double")).otherwise(chance)
    paths = stage(known.groupBy("site", "path").agg(F.sum(weight).alias("n"), F.sum(weight * is_good).alias("good")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = (total["good"] + prior) / (total["n"] + 1) if total["n"] else prior

    usable = "n > 0"
    sites = _shrunk(paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).filter(usable), F.lit(overall))
    sites = stage(sites.select("site", F.col("rate").alias("site_rate")), "sites")
    lower = _shrunk(paths.filter(usable).join(sites, "site"), F.col("site_rate"))
    rates = stage(lower.select("site", "path", "site_rate", F.col("rate").alias("path_rate")), "rates")

    out = seen.join(rates, ["site", "path"], "left")
    site_rate, path_rate = F.coalesce("site_rate", F.lit(overall)), F.coalesce("path_rate", F.lit(overall))
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), path_rate))
    posterior = 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded)))))
    return out.select(
        *[F.col(packed).getField(c).alias(c) for c in keep],
        "evidence",
        site_rate.alias("site_rate"),
        path_rate.alias("path_rate"),
        posterior.alias("score"),
        (posterior >= 0.5).alias("kept") if model else F.lit(True).alias("kept"),
    )
