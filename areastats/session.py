"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app: str = "areastats", **conf: str) -> SparkSession:
    """A session with the settings the plans rely on.

    Adaptive execution picks broadcast or shuffle joins from measured sizes and splits hot partitions (a crowded grid
    cell, a hot parcel id), so the plans carry no fixed broadcast hints on data of unknown size.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Shapes are much work per byte: keep small shuffles spread over the cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # The catalogue builds many column expressions; recording the Python call site of each costs seconds.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_fallback: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a temporary one of a local session without it."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _fallback:
        _fallback.append(tempfile.mkdtemp(prefix="areastats-"))
    return _fallback[0]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/areastats-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame once and read it back, so that lost executors do not force a recomputation of its lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/areastats-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
