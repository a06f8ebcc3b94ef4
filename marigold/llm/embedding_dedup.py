"""Near-duplicate vectors: spherical k-means cells, blocked cosine products within them, one representative kept.

Centroids are fitted to a bounded sample and only decide where vectors meet, never whether they link. A vector lives
in the cell of its nearest centroid. A link spans an angle of at most ``acos(threshold)``, so a vector can only
link into another cell if it lies within that angle of the plane halfway between the two centroids; it visits just
those cells (of lower number, so that each pair meets once). No link is lost, whatever the centroids are; the better
the vectors cluster, the fewer the visits.

Cells are dealt into blocks of a bounded number of vectors, and each task multiplies two blocks. Tasks return counts
of links and a spanning forest, one row per linked vector and task, never pairs. Equal vectors are one node from the
start, so a vector with a third of all rows is compared once.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors
of different lengths do not link; rows with one ``vec_id`` are vectors of their own; a null ``vec_id`` is larger than
any other; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from marigold.llm.components import components
from marigold.llm.text import column
from marigold.staging import stage

THRESHOLD = 0.9
SAMPLE = 8192
MAX_CELLS = 2048
BLOCK = 4096


def _unit(raw: list[bytes]) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), dtype="<f8").reshape(len(raw), -1)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)  # no square runs over or under
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors by Lloyd's rounds; a cell that empties takes the vector worst served."""
    rng = np.random.default_rng(seed)
    centroids = vectors[rng.choice(len(vectors), size=min(cells, len(vectors)), replace=False)]
    for _ in range(rounds):
        scores = vectors @ centroids.T
        home, near = scores.argmax(axis=1), scores.max(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, vectors)
        sizes = np.sqrt((sums * sums).sum(axis=1))
        for empty in np.flatnonzero(sizes < 1e-12):
            worst = int(near.argmin())
            sums[empty], sizes[empty], near[worst] = vectors[worst], 1.0, 2.0
        centroids = sums / sizes[:, None]
    return centroids


def _meetings(units: np.ndarray, centroids: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each vector, and which cells of lower number it has to visit (a mask)."""
    scores = units @ centroids.T
    home = scores.argmax(axis=1)
    gaps = np.sqrt(np.maximum(2 - 2 * centroids @ centroids.T, 0))
    reach = math.sqrt(1 - threshold * threshold) * gaps[home] + 1e-9
    visits = scores[np.arange(len(units)), home][:, None] - scores <= reach
    visits &= np.arange(len(centroids))[None, :] < home[:, None]
    return home, visits


def _compare(a: np.ndarray, b: np.ndarray, same: bool, threshold: float) -> np.ndarray:
    """Which pairs link, as a mask; computed by rows of blocks so that products stay small."""
    links = np.empty((len(a), len(b)), dtype=bool)
    for i in range(0, len(a), 512):
        links[i : i + 512] = a[i : i + 512] @ b.T >= threshold
    if same:
        np.fill_diagonal(links, False)
    return links


def _roots(links: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """For both sides the least place (rows first) that each reaches by the links of the mask."""
    rows, columns = links.shape
    left, right = np.arange(rows), np.arange(columns) + (0 if same else rows)
    none = rows + columns
    while True:
        new_left = np.minimum(left, np.where(links, right[None, :], none).min(axis=1, initial=none))
        new_right = new_left if same else np.minimum(right, np.where(links, new_left[:, None], none).min(axis=0, initial=none))
        if (new_left == left).all() and (new_right == right).all():
            return left, right
        left, right = new_left, new_right


def links(nodes: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK, sample: int = SAMPLE, max_cells: int = MAX_CELLS) -> DataFrame:
    """``node, root, n_links`` of a staged ``node long, copies long, raw binary``: partial counts and a forest.

    ``raw`` holds little-endian doubles. The driver gets the sample, and the number of vectors in each cell.
    """
    n = nodes.count()
    drawn = [bytes(r["raw"]) for r in nodes.select("raw").orderBy(F.xxhash64("node")).limit(sample).collect()]
    width = max(map(len, drawn), key=[len(d) for d in drawn].count, default=0)
    drawn = [d for d in drawn if len(d) == width]
    if drawn:
        centroids = spherical_kmeans(_unit(drawn), min(max_cells, math.ceil(n / block)))
    else:
        centroids = np.zeros((1, 1))

    def dealt(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            lengths = frame["raw"].map(len)
            odd = frame[lengths != width]
            yield pd.DataFrame({"cell": -(lengths[lengths != width]), "guest": False, "node": odd["node"], "copies": odd["copies"], "raw": odd["raw"]})
            frame = frame[lengths == width].reset_index(drop=True)
            if len(frame):
                home, visits = _meetings(_unit(list(frame["raw"])), centroids, threshold)
                yield frame.assign(cell=home, guest=False)[["cell", "guest", "node", "copies", "raw"]]
                who, where = np.nonzero(visits)
                yield frame.iloc[who].assign(cell=where, guest=True)[["cell", "guest", "node", "copies", "raw"]]

    met = stage(nodes.mapInPandas(dealt, "cell int, guest boolean, node long, copies long, raw binary"), "cells")
    counts = {(r["cell"], r["guest"]): math.ceil(r["n"] / block) for r in met.groupBy("cell", "guest").agg(F.count("*").alias("n")).collect()}
    session = nodes.sparkSession
    plan = session.createDataFrame([(c, g, k, counts.get((c, False), 0), counts.get((c, True), 0)) for (c, g), k in counts.items()], "cell int, guest boolean, own int, homes int, guests int")
    own = F.pmod(F.xxhash64("node"), F.col("own")).cast("int")
    # Blocks of a cell are counted homes first, then guests. Task (i, j) has home block i and any block j from i on.
    block_of = own + F.when(F.col("guest"), F.col("homes")).otherwise(F.lit(0))
    rows = met.join(F.broadcast(plan), ["cell", "guest"]).withColumn("block", block_of)  # a bounded number of cells
    lower = F.transform(F.sequence(F.lit(0), F.col("block")), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    higher = F.transform(F.sequence(F.col("block"), F.col("homes") + F.col("guests") - 1), lambda j: F.struct(F.col("block").alias("i"), j.alias("j")))
    guests = F.transform(F.sequence(F.lit(0), F.col("homes") - 1), lambda i: F.struct(i.alias("i"), F.col("block").alias("j")))
    tasks = F.when(F.col("guest"), guests).otherwise(F.array_distinct(F.concat(lower, higher)))
    rows = rows.filter("homes > 0").select("cell", F.explode(tasks).alias("task"), "block", "node", "copies", "raw")
    rows = rows.select("cell", "task.i", "task.j", "block", "node", "copies", "raw")

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
        frame = frame.sort_values("node")
        a = frame[frame["block"] == i]
        b = a if i == j else frame[frame["block"] == j]
        nothing = pd.DataFrame({"node": [], "root": [], "n_links": []}).astype("int64")
        if not len(a) or not len(b):
            return nothing
        mask = _compare(_unit(list(a["raw"])), _unit(list(b["raw"])), i == j, threshold)
        rows, columns = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        if not len(rows):
            return nothing
        mask = mask[np.ix_(rows, columns)]
        left, right = _roots(mask, i == j)
        a, b = a.iloc[rows], b.iloc[columns]
        names = np.concatenate([a["node"], b["node"]])
        out = pd.DataFrame({"node": a["node"].to_numpy(), "root": names[left], "n_links": mask @ b["copies"].to_numpy()})
        if i != j:
            more = pd.DataFrame({"node": b["node"].to_numpy(), "root": names[right], "n_links": a["copies"].to_numpy() @ mask})
            out = pd.concat([out, more])
        return out

    return rows.groupBy("cell", "i", "j").applyInPandas(meet, "node long, root long, n_links long")


def deduplicate(df: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row; ``kept`` marks one representative of each group."""
    values = column(df, vector).cast("array<double>")
    sound = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    given = df.select(F.monotonically_increasing_id().alias("row"), column(df, vec_id).alias("vec_id"), F.when(sound, values).alias("vector"))

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["raw"] = [None if v is None else np.asarray(v, dtype="<f8").tobytes() for v in frame["vector"]]
            yield frame[["row", "vec_id", "raw"]]

    kind = dict(df.dtypes)[vec_id]
    rows = stage(given.mapInPandas(pack, f"row long, vec_id {kind}, raw binary"), "vectors")
    nodes = rows.filter("raw is not null").groupBy("raw").agg(F.min("row").alias("node"), F.count("*").alias("copies"))
    nodes = stage(nodes.select("node", "copies", "raw"), "nodes")
    found = stage(links(nodes, threshold, block), "links")
    labels = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n"))

    members = rows.join(nodes, "raw", "left").join(counts, "node", "left").join(labels, "node", "left")
    members = members.withColumn("component", F.coalesce("component", "node", "row"))
    groups = members.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    n_links = F.coalesce(F.col("n"), F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))
    return members.join(groups, "component").select(
        "vec_id", n_links.cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
