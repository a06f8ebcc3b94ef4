"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes the whole of what its predecessor kept. All but the last return the columns of ``documents``;
where a stage changes a text, ``n_chars`` follows it. The last returns one row per piece of a document: where it comes
from, and the sequence and place it goes to. Stages pass through Parquet in the shared folder, so that a lost executor
costs the work of one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marigold.llm import line_dedup, minhash, mixing, packing, quality_model
from marigold.staging import stage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, trained on the labels beside the documents."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return quality_model.score(docs, labels, keep=tuple(docs.columns)).filter("kept").select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that many sources share; those with nothing left go.

    Copies that stand in many sources lose their lines to their first copy. What is left of them is no longer similar
    to it, so near-dedup would take it for a document: such copies go here.
    """
    cleaned = line_dedup.clean(docs, drop_emptied=True, drop_torn=minhash.PERCENT)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return minhash.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source up to its target weight, documents as often as they are taken."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", lines),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]

# The classifier is trained and the tokenizer is a library: SQL cannot say either. Tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
