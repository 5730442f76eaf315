"""Raw survey files: sequence files, geoheader (CSV and fixed width), position sheet and field lookup."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areastats.functions.numbers import missing
from areastats.functions.text import zfill

# Geoheader field names and widths in file order, from the public survey documentation.
GEOHEADER_WIDTHS = [
    ("fileid", 6), ("stusab", 2), ("sumlevel", 3), ("component", 2), ("logrecno", 7), ("us", 1), ("region", 1),
    ("division", 1), ("statece", 2), ("state", 2), ("county", 3), ("cousub", 5), ("place", 5), ("tract", 6),
    ("blkgrp", 1), ("concit", 5), ("aianhh", 4), ("aianhhfp", 5), ("aihhtli", 1), ("aitsce", 3), ("aits", 5),
    ("anrc", 5), ("cbsa", 5), ("csa", 3), ("metdiv", 5), ("macc", 1), ("memi", 1), ("necta", 5), ("cnecta", 3),
    ("nectadiv", 5), ("ua", 5), ("blank1", 5), ("cdcurr", 2), ("sldu", 3), ("sldl", 3), ("blank2", 6), ("blank3", 3),
    ("zcta5", 5), ("submcd", 5), ("sdelm", 5), ("sdsec", 5), ("sduni", 5), ("ur", 1), ("pci", 1), ("blank4", 6),
    ("blank5", 5), ("puma5", 5), ("blank6", 5), ("geoid", 40), ("name", 1000), ("bttr", 6), ("btbg", 1),
    ("blank7", 44),
]
GEOHEADER_FIELDS = [name for name, _ in GEOHEADER_WIDTHS]
OLD_GEOHEADER_FIELDS = GEOHEADER_FIELDS[:-3]


def sequence_cells(spark: SparkSession, path: str, width: int) -> DataFrame:
    """Headerless sequence files (`e…`/`m…`) as (measure, sequence, cells: array<string>).

    `path` may be a glob such as `…/[em]20165??0003000.txt`, so only the files a table needs are read.
    `width` is the sequence's number of cells, the last position in its layout; a row of another length raises.
    """
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    rows = spark.read.schema(schema).option("quote", '"').option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    file = F.col("_metadata.file_name")
    return rows.select(
        F.substring(file, 1, 1).alias("measure"),
        F.regexp_extract(file, r"([0-9]{4})000\.txt$", 1).alias("sequence"),
        F.array(*[F.col(f"c{i}") for i in range(width)]).alias("cells"),
    )


def year_cells(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all sequence files of a year in one scan, as (cells: array<string>).

    Rows are as wide as their sequence, so lines are cut at commas; only a line with a quote is cut by a pattern. The fifth
    cell names the sequence; whether a row is whole is for its layout to say.
    """
    lines = spark.read.text(path).where("value <> ''")
    cell = "(?:^|,)(?:\"(?:[^\"]|\"\")*\"|[^,\"]*)"
    quoted = F.transform(
        F.regexp_extract_all("value", F.lit(cell), F.lit(0)),
        lambda c: F.replace(F.regexp_replace(c, '^,?"?|"$', ""), F.lit('""'), F.lit('"')),
    )
    return lines.select(F.when(F.contains("value", F.lit('"')), quoted).otherwise(F.split("value", ",")).alias("cells"))


# Bytes 0x80 to 0x9f are letters and quotes in windows-1252 but control characters in ISO-8859-1, the closest charset
# Spark reads; all other bytes agree.
_SPECIAL = [b for b in range(0x80, 0xA0) if bytes([b]).decode("cp1252", "ignore")]
_LATIN = "".join(chr(b) for b in _SPECIAL)
_WINDOWS = bytes(_SPECIAL).decode("cp1252")


def _windows_text(value: Column) -> Column:
    return F.translate(value, _LATIN, _WINDOWS)


def geoheader_csv(spark: SparkSession, path: str) -> DataFrame:
    """Geoheader as CSV; a row with another number of fields raises."""
    schema = T.StructType([T.StructField(n, T.StringType()) for n in GEOHEADER_FIELDS])
    read = spark.read.schema(schema).option("encoding", "ISO-8859-1").option("quote", '"')
    raw = read.option("mode", "FAILFAST").option("columnPruning", False).csv(path)
    return raw.select(*[missing(_windows_text(F.col(n))).alias(n) for n in GEOHEADER_FIELDS])


def geoheader_fixed(spark: SparkSession, path: str, old: bool = True) -> DataFrame:
    """Fixed-width geoheader; that of the years before 2011 (`old`) lacks the last three fields and has short names."""
    lines = spark.read.schema("value string").option("header", False).option("encoding", "ISO-8859-1").option("sep", "\u0001").option("quote", "").csv(path)
    columns, start = [], 1
    for name, width in GEOHEADER_WIDTHS[: len(OLD_GEOHEADER_FIELDS if old else GEOHEADER_FIELDS)]:
        columns.append(missing(F.rtrim(F.substring(_windows_text(F.col("value")), start, width))).alias(name))
        start += width
    return lines.select(*columns)


def field_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Field lookup file as (pos, table_id, line_no, description); `pos` keeps the file order within a file."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(9)])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("quote", '"').csv(path)
    return raw.select(
        F.monotonically_increasing_id().alias("pos"),
        F.col("c1").alias("table_id"),
        F.col("c3").alias("line_no"),
        F.col("c7").alias("description"),
    )


def position_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Position sheet exported to CSV as (pos, table_id, sequence, positions)."""
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(6)])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("quote", '"').csv(path)
    sequence = F.regexp_replace("c3", r"\.0+$", "")
    return raw.select(
        F.monotonically_increasing_id().alias("pos"),
        F.col("c0").alias("table_id"),
        zfill(sequence, 4).alias("sequence"),
        F.col("c4").alias("positions"),
    )
