"""A corpus pipeline: quality, near-duplicates, decontamination, mixing, sharding. Each stage reads the one before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from areastats.llm import decontamination, mixing, quality_classifier, sharding, simhash
from areastats.llm.common import documents, materialise, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality_classifier.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return simhash.one_of_each(docs, width=3, radius=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents appear as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot; a column of the documents that has one of the new names gives way."""
    new = ["size", "text_crc32", "shard", "slot"]
    placed = sharding.histogram_sort(docs, shards=40, rows=True)
    return placed.select(*[f"row.`{c}`" for c in docs.columns if c.lower() not in new], *new)


STAGES = [
    ("quality classifier", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("sharding", shard),
]

#: The classifier's fit and the mix's draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage keeps is written and read again for the next one."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
