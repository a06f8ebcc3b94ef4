"""One query for each operator that accounts for a data set as a whole: its manifest, its filters, its round trip."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marigold.llm import bpe_codec, filter_audit, merkle
from marigold.llm.queries import table


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.check(merkle.build(merkle.leaves(docs, claim=merkle.tampered(docs))))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = filter_audit.patterns(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return filter_audit.audit(counts)


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.round_trip(table(spark, sf_dir, "documents"))


QUERIES = {
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_filter_audit": op12_filter_audit,
    "op13_bpe_codec": op13_bpe_codec,
}
