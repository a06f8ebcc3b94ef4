"""Removal of lines that many sites share.

For each line (trimmed, by a hash of 128 bits) a HyperLogLog sketch of its sites is merged by the aggregation, which
starts in the scan's own tasks: a line on a third of all documents is one row per task. Sketches decide where they are
five standard errors away from the threshold. Lines nearer to it get an exact distinct count. A line on
enough sites is boilerplate: only its first occurrence stays (least document, least place).

Lines of few words are left alone: on their own they say too little to be told from prose. Defined cases: null and
empty texts have no lines; a null site is a site; lines without words are never removed; rows with one id and text are
alike and keep or lose lines together; a null id is larger than any other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marigold.llm import minhash
from marigold.llm.text import column, fresh, has_word
from marigold.staging import stage

MIN_SITES = 5
MIN_WORDS = 3
STANDARD_ERROR = 0.1
LAST = (1 << 63) - 1
KEY = ["h1", "h2"]


def _lines(body: Column) -> Column:
    return F.split(body, "\n", -1)


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """``k1, k2, place, site, h1, h2, chars`` for every line that may be judged."""
    enough = r"(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]+){%d}[^\x20\x09-\x0D]" % (min_words - 1)
    rows = docs.filter("text is not null").select("k1", "k2", "site", F.posexplode(_lines(F.col("text"))).alias("place", "line"))
    rows = rows.filter(F.col("line").rlike(enough)).withColumn("line", F.btrim("line", F.lit(" \t\r\x0b\f")))
    return rows.select("k1", "k2", "place", "site", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.length("line").alias("chars"))


def _shared(docs: DataFrame, min_sites: int, min_words: int) -> DataFrame:
    """``k1, k2, place`` of every occurrence of boilerplate but the first, and ``first``, which says where that is."""
    lines = _occurrences(docs, min_words)
    sketches = lines.groupBy(*KEY).agg(F.count("*").alias("n"), F.approx_count_distinct("site", STANDARD_ERROR).alias("sites"))
    margin = 5 * STANDARD_ERROR * min_sites
    likely = sketches.filter((F.col("n") >= min_sites) & (F.col("sites") >= min_sites - margin))
    sure = likely.select(*KEY, (F.col("sites") > min_sites + margin).alias("sure"))
    # Of the occurrences of such lines, one narrow row each is kept for the three uses below.
    found = stage(lines.join(stage(sure, "lines"), KEY), "occurrences")
    exact = found.filter("not sure").groupBy(*KEY).agg(F.countDistinct("site").alias("sites")).filter(F.col("sites") >= min_sites)
    boilerplate = exact.select(*KEY).unionByName(found.filter("sure").select(*KEY).distinct())
    place = F.struct("k1", "k2", "place")
    # Written down, so that its join with the occurrences stands alone and a hot line can be split.
    first = stage(found.groupBy(*KEY).agg(F.min(place).alias("first")).join(boilerplate, KEY), "first-places")
    return found.join(first, KEY).filter(place != F.col("first")).select("k1", "k2", "place", "chars", "first")


def _torn(docs: DataFrame, gone: DataFrame, percent: int) -> DataFrame:
    """``k1, k2`` of documents that are copies of one they lost their lines to.

    Of the documents that lost more than ``100 - percent`` of a hundred characters, those whose whole text is as similar as
    ``percent`` to that of the document where most of their lost lines first stand. What is left of them would look
    like a document of its own. Only such suspects' texts are compared, each with that one other.
    """
    sizes = docs.filter("text is not null").select("k1", "k2", F.length("text").alias("chars")).distinct()
    lost = F.aggregate("gone", F.lit(0), lambda total, line: total + line["chars"])
    suspects = gone.join(sizes, ["k1", "k2"]).filter(100 * lost > (100 - percent) * F.col("chars"))
    suspects = stage(suspects.select("k1", "k2", F.col("mainly.k1").alias("o1"), F.col("mainly.k2").alias("o2")), "suspects")
    twins, pairs = suspects.filter("k2 = o2"), suspects.filter("k2 <> o2")
    wanted = pairs.select("k1", "k2").union(pairs.select("o1", "o2")).distinct()
    texts = docs.join(wanted, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text"))
    texts = stage(texts, "suspect-texts")
    others = texts.select(F.col("k1").alias("o1"), F.col("k2").alias("o2"), F.col("text").alias("other"))
    alike = minhash.alike(pairs.join(texts, ["k1", "k2"]).join(others, ["o1", "o2"]), ("k1", "k2"), percent=percent)
    return twins.select("k1", "k2").union(alike).distinct()


def clean(df: DataFrame, text: str = "text", site: str = "source", doc_id: str = "doc_id", min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, drop_emptied: bool = False, drop_torn: int | None = None) -> DataFrame:
    """``df`` with the text without boilerplate, and two new columns ``n_lines, n_removed`` (renamed if they clash).

    ``drop_emptied`` leaves out documents that had words and have none left. ``drop_torn`` is a similarity in percent: it
    leaves out documents that lost most of their lines to a document so similar to what they were (see ``_torn``).
    """
    body = column(df, text)
    k1, k2 = F.coalesce(column(df, doc_id).cast("long"), F.lit(LAST)), F.xxhash64(body)
    docs = df.select(k1.alias("k1"), k2.alias("k2"), F.coalesce(column(df, site).cast("string"), F.lit("\0")).alias("site"), body.alias("text"))
    shared = _shared(docs, min_sites, min_words)
    if drop_torn is None:
        gone = shared.groupBy("k1", "k2").agg(F.collect_set("place").alias("gone"))
    else:
        line = F.struct("place", "chars")
        gone = shared.groupBy("k1", "k2").agg(F.collect_set(line).alias("gone"), F.mode(F.struct("first.k1", "first.k2"), True).alias("mainly"))
        gone = stage(gone, "gone")
        torn = stage(_torn(docs, gone, drop_torn), "torn").withColumn("torn", F.lit(True))
        gone = gone.join(torn, ["k1", "k2"], "left").select("k1", "k2", F.col("gone.place").alias("gone"), "torn")

    (whole,) = fresh(df, "whole")
    rows = df.select(F.struct(*[column(df, c) for c in df.columns]).alias(whole), k1.alias("k1"), k2.alias("k2")).join(gone, ["k1", "k2"], "left")
    old = F.col(whole).getField(text)
    left = F.array_join(F.filter(_lines(old), lambda _, i: ~F.array_contains(F.col("gone"), i)), "\n")
    new = F.when(F.col("gone").isNull(), old).otherwise(left)
    n_lines = F.coalesce(F.size(_lines(old)), F.lit(0))
    n_lines = F.when(F.length(old) > 0, n_lines).otherwise(F.lit(0)).cast("long")
    counts = [n_lines, F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")]
    names = fresh(df, "n_lines", "n_removed")
    kept = [(new if c == text else F.col(whole).getField(c)).alias(c) for c in df.columns]
    if drop_torn is not None:
        rows = rows.filter("torn is null")
    out = rows.select(*kept, *[value.alias(name) for value, name in zip(counts, names)])
    if drop_emptied:
        out = out.filter((column(out, names[1]) == 0) | F.coalesce(has_word(column(out, text)), F.lit(False)))
    return out
