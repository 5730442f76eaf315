"""What several operators share: table access, words, small driver-made tables and written intermediate tables."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.session import materialise

__all__ = ["CUT", "WORD", "documents", "label_hash", "materialise", "small_frame", "table", "words_of"]

#: A word, and what lies between words, as a regular expression.
WORD = r"[^\x20\x09-\x0D]+"
CUT = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def words_of(text: Column) -> Column:
    """The words of a text; none for null and empty texts."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), CUT), lambda w: w != F.lit(""))


def label_hash(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def small_frame(spark: SparkSession, rows: Iterable[dict], ddl: str) -> DataFrame:
    """A table of a few driver-made rows, read on the JVM from one JSON literal.

    Callers broadcast it: its rows are splitters, bins or sources, whose number is bounded by a parameter.
    """
    text = json.dumps(list(rows))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{ddl}>>")))
