"""Delimited files and tables: readers with fixed schemas, table scan, replace and append sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _normalised(df: DataFrame, spaces: bool) -> DataFrame:
    names = [c.lower().replace(" ", "_") if spaces else c.lower() for c in df.columns]
    return df.toDF(*names)


def header_of(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of a delimited file, from its first line."""
    return spark.read.option("header", True).option("sep", sep).option("quote", '"').csv(path).columns


def read_delimited(
    spark: SparkSession,
    path: str,
    types: dict[str, str] | None = None,
    sep: str = ",",
    spaces_to_underscore: bool = False,
) -> DataFrame:
    """A CSV (or, with `sep="\\t"`, TSV) with a header, lower-cased names and explicit types.

    Every column is read as text unless `types` (by normalised name) says otherwise, so codes keep leading zeros and no
    second pass over the data infers a schema.
    """
    types = types or {}
    raw = header_of(spark, path, sep)
    fields = []
    for name in raw:
        short = name.lower().replace(" ", "_") if spaces_to_underscore else name.lower()
        fields.append(T.StructField(name, T._parse_datatype_string(types.get(short, "string"))))
    df = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .csv(path)
    )
    return _normalised(df, spaces_to_underscore)


def read_air_quality(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(
        spark,
        path,
        {"latitude": "double", "longitude": "double", "primary_exceedance_count": "int"},
        spaces_to_underscore=True,
    )


def read_brownfields(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, {"latitude83": "double", "longitude83": "double"})


def read_green_buildings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, sep="\t")


def read_crashes(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(
        spark,
        path,
        {"state": "int", "st_case": "int", "latitude": "double", "longitud": "double", "persons": "int"},
    )


def read_ped_bike(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, {"state": "int", "st_case": "int"})


ASSESSOR_NUMBERS = {"yrblt": "double", "sfla": "double", "sf": "double", "rtotapr": "double"}


def read_assessor(spark: SparkSession, path: str) -> DataFrame:
    """An assessor text file; luc, adrno, zip1 and all other codes stay text, amounts and years are numbers."""
    return read_delimited(spark, path, ASSESSOR_NUMBERS)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}")


def replace_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{root.rstrip('/')}/{name}")


def append_table(df: DataFrame, root: str, name: str) -> None:
    df.write.mode("append").parquet(f"{root.rstrip('/')}/{name}")


def column_catalogue(tables: dict[str, DataFrame], schemas: dict[str, str] | None = None) -> DataFrame:
    """Rows (table_schema, table_name, column_name, ordinal_position, data_type) of the given tables' schemas."""
    schemas = schemas or {}
    rows = [
        (schemas.get(name, "public"), name, field.name, pos, field.dataType.simpleString())
        for name, df in tables.items()
        for pos, field in enumerate(df.schema.fields, 1)
    ]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, column_name string, ordinal_position int, data_type string"
    )


def without_nan(df: DataFrame) -> DataFrame:
    """NaN in floating columns becomes null, because Spark orders it above every number."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )
