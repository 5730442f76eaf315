"""Tables in versions: new data goes to a folder of its own, and one row in the store's log then makes it the current one.

A write that dies leaves files no log row names, so the version before stays readable. The log is a small table that is only
appended to; years are versions too, so what a year holds and what it inherits is read from the log.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.sources.files import append_table

LOG = "versions"
LOG_FIELDS = "name string, year string, number long, folder string"


def read_log(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """An appended log, empty where none was written yet."""
    try:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """Every finished version: name, year, number, folder (below `root`)."""
    return read_log(spark, root, LOG, LOG_FIELDS)


def put(df: DataFrame, root: str, name: str, year: str, partition_by: list[str] | None = None) -> str:
    """Write a version of a year's table and make it current; returns its folder. Two writers at once both finish, and the
    greater folder name counts."""
    spark = df.sparkSession
    folder = f"{name}/year-{year}/{uuid.uuid4().hex}"
    df.write.partitionBy(*(partition_by or [])).parquet(f"{root.rstrip('/')}/{folder}")
    own = versions(spark, root).where((F.col("name") == name) & (F.col("year") == year))
    number = (own.agg(F.max("number")).first()[0] or 0) + 1
    append_table(spark.createDataFrame([(name, year, number, folder)], LOG_FIELDS), root, LOG)
    return folder


def contents(spark: SparkSession, root: str, year: str, carried: bool = False) -> DataFrame:
    """The current version of each table a year holds: name, year, number, folder. With `carried`, a table the year does
    not hold comes from the newest year before that does."""
    log = versions(spark, root)
    log = log.where(F.col("year") <= year if carried else F.col("year") == year)
    newest = log.groupBy("name").agg(F.max(F.struct("year", "number", "folder")).alias("v"))
    return newest.select("name", "v.*")


def get(spark: SparkSession, root: str, name: str, year: str, carried: bool = False) -> DataFrame:
    """The current version of a year's table."""
    found = contents(spark, root, year, carried).where(F.col("name") == name).first()
    if found is None:
        raise ValueError(f"no {name} in {year}")
    return spark.read.parquet(f"{root.rstrip('/')}/{found['folder']}")


def get_year(spark: SparkSession, root: str, year: str) -> dict[str, DataFrame]:
    """All tables of a year, with those carried forward from the years before."""
    found = contents(spark, root, year, carried=True).collect()
    return {r["name"]: spark.read.parquet(f"{root.rstrip('/')}/{r['folder']}") for r in found}
