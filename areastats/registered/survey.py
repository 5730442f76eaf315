"""Survey assembly on records derived from orders: one record per order, coded the way the raw files are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions.numbers import missing
from areastats.operators import survey as sv
from areastats.registered.base import query, table
from areastats.session import new_path, shared_dir
from areastats.sources.survey_files import GEOHEADER_FIELDS, GEOHEADER_WIDTHS, geoheader_csv, geoheader_fixed, sequence_cells, year_cells


def _records(spark: SparkSession, sf_dir: str, sequence: str) -> DataFrame:
    """Cells of one sequence: file type, state, iteration, sequence, record number, then three values per order.

    Sequence 0001 holds price, key and a gap marked `.`; 0002 holds status counts with blanks.
    """
    orders = table(spark, sf_dir, "orders")
    keys = [
        "'ACSSF'",
        "if(o_orderkey % 2 = 0, '2016e5', '2016m5')",
        "if(o_orderkey % 3 = 0, 'tn', 'ms')",
        "'000'",
        f"'{sequence}'",
        "lpad(cast(o_orderkey as string), 7, '0')",
    ]
    values = {
        "0001": [
            "cast(cast(o_totalprice as decimal(18,2)) as string)",
            "if(o_orderstatus = 'P', '.', cast(o_custkey as string))",
            "if(o_orderstatus = 'F', '', cast(o_orderkey as string))",
        ],
        "0002": ["if(o_orderstatus = 'O', '1', '0')", "cast(year(o_orderdate) as string)"],
    }[sequence]
    return orders.selectExpr(f"array({', '.join(keys + values)}) as cells")


def _header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One geoheader row per order, with the identifiers of several summary levels and quoted names."""
    level = "case o_custkey % 5 when 0 then '050' when 1 then '160' when 2 then '140' when 3 then '860' else '310' end"
    return (
        table(spark, sf_dir, "orders")
        .withColumn("sumlevel", F.expr(level))
        .selectExpr(
            "concat(sumlevel, '0000US', lpad(cast(o_orderkey as string), 7, '0')) as geoid",
            "concat('Area ', o_orderkey, if(o_orderkey % 7 = 0, ' D\\'Arc', '')) as name",
            "if(o_orderkey % 3 = 0, 'TN', 'MS') as stusab",
            "sumlevel",
            "lpad(cast(o_orderkey as string), 7, '0') as logrecno",
        )
    )


_LEVEL = "CASE o_custkey % 5 WHEN 0 THEN '050' WHEN 1 THEN '160' WHEN 2 THEN '140' WHEN 3 THEN '860' ELSE '310' END"
_KEYS = """CASE WHEN o_orderkey % 2 = 0 THEN '2016e5' ELSE '2016m5' END AS fileid, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS geoid"""
_V1 = "round(o_totalprice, 2) AS t001, CASE WHEN o_orderstatus <> 'P' THEN o_custkey::DOUBLE END AS t002, CASE WHEN o_orderstatus <> 'F' THEN o_orderkey::DOUBLE END AS t003"
_V2 = "CASE WHEN o_orderstatus = 'O' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS t004, year(o_orderdate)::DOUBLE AS t005"
_FIELDS = [(f"t00{i}", f"Line {i}") for i in range(1, 6)]


@query(
    f"SELECT CASE WHEN o_orderkey % 2 = 0 THEN '2016e5' ELSE '2016m5' END AS fileid, lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS logrecno, {_V1} FROM orders"
)
def survey_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sv.split_sequence(_records(spark, sf_dir, "0001"), 6, 9)
    return rows.select("fileid", "logrecno", *[F.col("vals")[i].alias(f"t00{i + 1}") for i in range(3)])


@query(
    f"SELECT lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS logrecno, {_V1}, {_V2} FROM orders"
)
def survey_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = sv.split_sequence(_records(spark, sf_dir, "0001"), 6, 9)
    second = sv.split_sequence(_records(spark, sf_dir, "0002"), 6, 8)
    rows = sv.stitch([first, second])
    return rows.select("logrecno", *[F.col("vals")[i].alias(f"t00{i + 1}") for i in range(5)])


@query(
    f"""SELECT {_KEYS}, {_LEVEL} AS sumlevel, CASE WHEN o_orderkey % 3 = 0 THEN 'TN' ELSE 'MS' END AS stusab,
  'Area ' || o_orderkey || CASE WHEN o_orderkey % 7 = 0 THEN ' D''Arc' ELSE '' END AS name, {_V1}, {_V2} FROM orders"""
)
def survey_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sequences stitched, joined to the geoheader, geoid shortened."""
    sequences = {s: _records(spark, sf_dir, s) for s in ("0001", "0002")}
    header = sv.geoheader(_header(spark, sf_dir))
    return sv.assemble(sequences, [("0001", 6, 9), ("0002", 6, 8)], header, _FIELDS)


@query(
    f"""WITH z AS (SELECT {_KEYS}, {_LEVEL} AS sumlevel, o_custkey, {_V1} FROM orders)
  SELECT fileid, geoid, sumlevel, t001 FROM z WHERE fileid[5] = 'e' AND (sumlevel IN ('050', '160', '140')
    OR (sumlevel = '310' AND geoid = '0000004')
    OR (sumlevel = '860' AND geoid IN (SELECT lpad(CAST(l_orderkey AS VARCHAR), 7, '0') FROM lineitem WHERE l_returnflag = 'R')))"""
)
def survey_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = sv.split_sequence(_records(spark, sf_dir, "0001"), 6, 9)
    built = sv.build_table(records, sv.geoheader(_header(spark, sf_dir)), _FIELDS[:3])
    zips = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .select(F.lpad(F.col("l_orderkey").cast("string"), 7, "0").alias("zip"))
    )
    return sv.extract_year(built, zips, "0000004").select("fileid", "geoid", "sumlevel", "t001")


@query(
    """WITH f AS (SELECT lower(p_brand) AS t, p_size, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE lower(p_brand) || lpad(CAST(p_size AS VARCHAR), 3, '0') END fld,
    p_partkey FROM part WHERE p_partkey % 7 <> 0)
  SELECT t AS table_id, count(DISTINCT fld)::BIGINT AS n_fields, arg_min(fld, p_partkey) AS first_field FROM f
  WHERE fld IS NOT NULL GROUP BY 1"""
)
def survey_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields per table from a lookup; blank and fractional line numbers are headings."""
    lookup = table(spark, sf_dir, "part").selectExpr(
        "p_partkey as pos",
        "p_brand as table_id",
        "case when p_partkey % 7 = 0 then '0.5' when p_partkey % 10 = 0 then ' ' else cast(p_size as string) end as line_no",
        "concat('Line ', p_size) as description",
    )
    fields = sv.table_fields(lookup)
    return fields.select(
        "table_id", F.size("fields").cast("long").alias("n_fields"), F.col("fields")[0]["field"].alias("first_field")
    )


@query(
    """SELECT DISTINCT lower(p_brand) AS table_id, lpad(CAST(p_size AS VARCHAR), 4, '0') AS sequence,
  (p_partkey % 20 + 6)::INTEGER AS "start", (p_partkey % 20 + 10)::INTEGER AS "end" FROM part"""
)
def survey_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    sheet = table(spark, sf_dir, "part").selectExpr(
        "p_partkey as pos",
        "p_brand as table_id",
        "cast(p_size as string) as sequence",
        "concat(p_partkey % 20 + 7, '-', p_partkey % 20 + 10) as positions",
    )
    return sv.layout_index(sheet).select("table_id", "sequence", "start", "end")


@query(
    f"""SELECT lpad(CAST(o_orderkey AS VARCHAR), 7, '0') AS logrecno, {_V1} FROM orders"""
)
def survey_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records written as headerless files and read back by position."""
    root = f"{shared_dir(spark).rstrip('/')}/areastats-sequences-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    cells = _records(spark, sf_dir, "0001").select(*[F.col("cells")[i].alias(f"c{i}") for i in range(9)])
    cells.write.mode("overwrite").option("emptyValue", "").csv(root)
    read = sequence_cells(spark, root, 9)
    rows = sv.split_sequence(read.select("cells"), 6, 9)
    return rows.select("logrecno", *[F.col("vals")[i].alias(f"t00{i + 1}") for i in range(3)])


@query(
    """SELECT DISTINCT CASE WHEN c_custkey % 4 = 0 THEN '04000US' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') ELSE '14000US' || c_custkey END AS geoid,
  CASE WHEN c_custkey % 4 = 0 THEN NULL WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END AS name FROM customer"""
)
def geoheader_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geoheader rows with missing-value markers, one kept per geoid; written to a file and read back."""
    root = f"{shared_dir(spark).rstrip('/')}/areastats-geoheader-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    geoid = (
        "case when c_custkey % 4 = 0 then concat('04000US', lpad(cast(c_nationkey as string), 2, '0'))"
        " else concat('14000US', c_custkey) end"
    )
    name = "case when c_custkey % 4 = 0 then '.' when c_mktsegment = 'BUILDING' then '' else c_mktsegment end"
    cells = [
        geoid if f == "geoid" else name if f == "name" else "'.'" if f == "bttr" else "'x'" for f in GEOHEADER_FIELDS
    ]
    raw = table(spark, sf_dir, "customer").selectExpr(*[f"{c} as {f}" for c, f in zip(cells, GEOHEADER_FIELDS)])
    raw.write.mode("overwrite").option("encoding", "ISO-8859-1").option("emptyValue", "").csv(root)
    header = sv.geoheader(geoheader_csv(spark, root))
    return header.select("geoid", missing(F.col("name")).alias("name"))


_SHEET = [
    (1, "T00001", "0001", "7-9"), (2, "T00002", "0001", "8-9"), (3, "T00002", "0002", "7-7"), (4, "C27010", "0002", "7-8"),
    (5, "T00003", "0002", "7-8"),
]
_YEAR = f"""{_KEYS}, {_LEVEL} AS sumlevel, CASE WHEN o_orderkey % 3 = 0 THEN 'TN' ELSE 'MS' END AS stusab,
  'Area ' || o_orderkey || CASE WHEN o_orderkey % 7 = 0 THEN ' D''Arc' ELSE '' END AS name"""


@query(
    f"""WITH v AS (SELECT {_YEAR}, {_V1}, {_V2} FROM orders)
  SELECT 't00001' AS table_id, fileid, geoid, sumlevel, stusab, name, t001 AS v1, t002 AS v2, t003 AS v3 FROM v
  UNION ALL SELECT 't00002', fileid, geoid, sumlevel, stusab, name, t002, t003, t004 FROM v
  UNION ALL SELECT 't00003', fileid, geoid, sumlevel, stusab, name, t004, t005, NULL FROM v"""
)
def survey_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year's folder of sequence files to all its tables, written in one job and read back table by table."""
    raw, built = new_path(spark, "year-files"), new_path(spark, "year-tables")
    for sequence, width in (("0001", 9), ("0002", 8)):
        cells = _records(spark, sf_dir, sequence).select(*[F.col("cells")[i].alias(f"c{i}") for i in range(width)])
        cells.write.option("emptyValue", "").csv(f"{raw}/{sequence}")
    sheet = spark.createDataFrame(_SHEET, "pos long, table_id string, sequence string, positions string")
    records = sv.year_records(year_cells(spark, f"{raw}/*"), sv.layout_index(sheet), sv.geoheader(_header(spark, sf_dir)))
    sv.write_year(records, built)
    out = None
    for table_id, n in (("t00001", 3), ("t00002", 3), ("t00003", 2)):
        one = sv.year_table(spark, built, table_id, [(f"v{i}", f"Line {i}") for i in range(1, n + 1)])
        one = one.select(F.lit(table_id).alias("table_id"), *one.columns)
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


@query(
    """SELECT '14000US' || c_custkey AS geoid, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Café ' || c_name END AS name,
  lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS logrecno, CASE WHEN c_custkey % 2 = 0 THEN 'x' END AS btbg FROM customer"""
)
def geoheader_fixed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geoheader rows of the longer fixed-width layout, written to a file and read back by position."""
    root = new_path(spark, "geoheader-fixed")
    cells = {
        "geoid": "concat('14000US', c_custkey)", "name": "if(c_custkey % 4 = 0, '.', concat('Café ', c_name))",
        "logrecno": "lpad(cast(c_custkey as string), 7, '0')", "btbg": "if(c_custkey % 2 = 0, 'x', '')", "blank7": "'.'",
    }
    parts = [f"rpad({cells.get(field, repr('.'))}, {width}, ' ')" for field, width in GEOHEADER_WIDTHS]
    lines = table(spark, sf_dir, "customer").selectExpr(f"concat({', '.join(parts)}) as value")
    lines.write.option("encoding", "ISO-8859-1").option("quote", "").option("ignoreTrailingWhiteSpace", False).csv(root)
    return geoheader_fixed(spark, root, old=False).select("geoid", "name", "logrecno", "btbg")
