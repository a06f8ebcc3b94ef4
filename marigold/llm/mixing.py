"""Mixing sources to target weights by Pareto order sampling.

Sources share a budget of words by weight, up to a cap on each. Where a source's target is more than its size,
every document is first allocated that many certain whole copies. The rest of the target is a sample without
replacement with inclusion probabilities in proportion to document size (1 where that would pass 1): documents
are ranked by their random odds divided by their inclusion odds, and the lowest ranks are taken until the words
that are left are fewer than the next document's. One more document, the one that comes nearest to the words
still missing, is taken if it brings the source nearer to its target.

Plan: one pass over the texts keeps one narrow row per document; everything else works on those. No source is
ever ordered as a whole: ranks are counted in a fixed number of bins per source (map-side), and only the one bin
in which the target is reached is put in order. What is per source is one row per source.

Defined cases: a null text has size 0, and a document of size 0 is only part of whole copies; null sources form a
source of their own, last in order; repeated rows are documents of their own and may get different numbers of
copies; an empty table gives an empty result. Random numbers depend on ``doc_id``, the text and the seed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marigold.llm.text import column, count_words, fresh
from marigold.staging import stage

BINS = 4096
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
CAP = 2.0


def _uniform(doc_id: Column, text: Column, seed: int) -> Column:
    """A number between 0 and 1, both excluded, from the document and the seed."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(facts: DataFrame, weights: tuple[int, ...], budget: float, cap: float) -> DataFrame:
    """``source, source_size, target``: the budget shared by weight, no source above ``cap`` times its size.

    In order of cap per weight, a source is capped while the level that the sources from it on could share
    lies above its own cap per weight. The windows go over one row per source.
    """
    everything = Window.partitionBy(F.lit(1))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("ratio", F.col("source").asc_nulls_last())
    before, on = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    rows = facts.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("place", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    rows = rows.withColumn("most", F.lit(cap) * F.col("source_size")).withColumn("ratio", F.col("most") / F.col("weight"))
    left = F.lit(budget) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(on)).withColumn("capped", F.col("level") > F.col("ratio"))
    first = F.min(F.when(~F.col("capped"), F.struct("ratio", F.col("source").isNull(), "source", "level"))).over(everything)
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.least(F.col("most"), F.col("weight") * first["level"]))
    return rows.select("source", "source_size", target.alias("target"))


def _inclusion(facts: DataFrame, sources: DataFrame) -> DataFrame:
    """``source, target, source_size, copies, rest, slope``: inclusion is ``min(1, slope * size)``.

    The slope makes the expected words equal to ``rest``. It is found over one row per source and size.
    """
    by_size = Window.partitionBy("source").orderBy("size")
    upto, beyond = by_size.rowsBetween(Window.unboundedPreceding, 0), by_size.rowsBetween(1, Window.unboundedFollowing)
    sources = sources.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    sources = sources.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size"))
    sizes = facts.filter("size > 0").groupBy("source", "size").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("squares", F.sum(F.col("n") * F.col("size") * F.col("size")).over(upto))
    sizes = sizes.withColumn("larger", F.coalesce(F.sum(F.col("n") * F.col("size")).over(beyond), F.lit(0)))
    joined = sizes.join(sources.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
    slope = (F.col("rest") - F.col("larger")) / F.col("squares")
    fits = joined.withColumn("slope", slope).filter(F.col("slope") * F.col("size") <= 1)
    best = fits.groupBy("name").agg(F.max_by("slope", "size").alias("slope"))
    best = best.withColumnRenamed("name", "named")
    return sources.join(best, F.col("source").eqNullSafe(F.col("named")), "left").drop("named").withColumn("slope", F.coalesce("slope", F.lit(0.0)))


def allocate(
    df: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET,
    cap: float = CAP,
    seed: int = 17,
) -> DataFrame:
    """The columns in ``keep`` with ``size, source_size, target, copies, taken`` for every row of ``df``."""
    body = column(df, text)
    (packed,) = fresh(df, "packed")
    facts = stage(
        df.select(
            F.struct(*[column(df, c) for c in keep]).alias(packed),
            column(df, source).cast("string").alias("source"),
            count_words(body).alias("size"),
            _uniform(column(df, doc_id), body, seed).alias("u"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "mix",
    )
    plan = stage(_inclusion(facts, source_targets(facts, weights, budget, cap)), "sources")
    names = plan.select(F.col("source").alias("name"), "source_size", "target", "copies", "rest", "slope")
    ranked = facts.join(names, F.col("source").eqNullSafe(F.col("name")))
    odds = F.col("slope") * F.col("size")
    rank = F.when(odds >= 1, F.lit(0.0)).when(odds > 0, (F.col("u") / (1 - F.col("u"))) / (odds / (1 - odds)))
    ranked = ranked.withColumn("rank", rank)
    drawn = ranked.filter("rank is not null").withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))

    by_bin = Window.partitionBy("name").orderBy("bin")
    bins = drawn.groupBy("name", "bin", "rest").agg(F.sum("size").alias("words"))
    bins = bins.withColumn("upto", F.sum("words").over(by_bin))
    reached = bins.filter("upto > rest").groupBy("name").agg(F.min(F.struct("bin", "upto", "words")).alias("edge"))
    reached = reached.select(F.col("name").alias("at"), F.col("edge.bin").alias("edge_bin"), (F.col("edge.upto") - F.col("edge.words")).alias("edge_before"))

    in_order = Window.partitionBy("name").orderBy("rank", "row").rowsBetween(Window.unboundedPreceding, 0)
    edge = drawn.join(reached, F.col("name").eqNullSafe(F.col("at")) & (F.col("bin") == F.col("edge_bin")))
    edge = edge.withColumn("upto", F.col("edge_before") + F.sum("size").over(in_order))
    fits = F.col("upto") <= F.col("rest")
    ends = edge.groupBy("name").agg(
        F.max(F.when(fits, F.struct("rank", "row"))).alias("last"),
        F.coalesce(F.max(F.when(fits, F.col("upto"))), F.first("edge_before")).alias("words"),
        F.first("edge_bin").alias("edge_bin"),
    )
    ends = stage(ends.withColumnRenamed("name", "at"), "ends")

    drawn = drawn.join(ends, F.col("name").eqNullSafe(F.col("at")), "left")
    lower = F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin"))
    chosen = lower | F.coalesce((F.col("bin") == F.col("edge_bin")) & (F.struct("rank", "row") <= F.col("last")), F.lit(False))
    missing = F.col("rest") - F.col("words")
    off = F.abs(F.col("size") - missing)
    extra = drawn.filter(~chosen & (off < missing)).groupBy("name").agg(F.min(F.struct(off.alias("off"), "rank", "row")).alias("extra"))
    extra = extra.select(F.col("name").alias("also"), F.col("extra.row").alias("extra_row"))

    done = ranked.withColumn("bin", F.floor(F.col("rank") / (1 + F.col("rank")) * BINS))
    ends = stage(ends.join(extra, F.col("at").eqNullSafe(F.col("also")), "left").drop("also"), "cuts")
    done = done.join(ends, F.col("name").eqNullSafe(F.col("at")), "left")
    once = F.col("rank").isNotNull() & (F.col("rest") > 0) & (chosen | F.coalesce(F.col("row") == F.col("extra_row"), F.lit(False)))
    copies = F.col("copies") + F.when(once, F.lit(1)).otherwise(F.lit(0))
    return done.select(
        *[F.col(packed).getField(c).alias(c) for c in keep],
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def mix(df: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``df`` as often as it is taken, with the columns it had."""
    (whole,) = fresh(df, "whole")
    packed = df.select(F.struct(*[column(df, c) for c in df.columns]).alias(whole), *[column(df, c) for c in ("doc_id", "text", "source")])
    rows = allocate(packed, keep=(whole,), **options).filter("copies > 0")
    rows = rows.withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select(*[F.col(whole).getField(c).alias(c) for c in df.columns])
