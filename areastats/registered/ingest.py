"""Cleaning of layers, on rows derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions.projection import CONE, ECC, RADIUS, RHO_0, point_text, to_state_plane
from areastats.functions.text import roll_years
from areastats.operators import clean
from areastats.registered.base import query, table
from areastats.session import shared_dir
from areastats.sources.files import read_brownfields, read_green_buildings


def _lonlat(key: str) -> tuple[str, str]:
    return f"(-91 + ({key} % 2000) / 1000D)", f"(34 + ({key} % 1777) / 1000D)"


_PHI = "radians({lat})"
_T = (
    f"tan(pi() / 4 - {_PHI} / 2) / pow((1 - {ECC!r}::DOUBLE * sin({_PHI})) / (1 + {ECC!r}::DOUBLE * sin({_PHI})), {ECC / 2!r}::DOUBLE)"
)
_RHO = f"({RADIUS!r}::DOUBLE * pow({_T}, {CONE!r}::DOUBLE))"
_THETA = f"({CONE!r}::DOUBLE * radians({{lon}} + 86.0))"
_FEET = "(3937.0::DOUBLE / 1200.0)"


def _projected(lon: str, lat: str, digits: int = 3) -> str:
    """SQL of the projection."""
    x = f"round((600000 + {_RHO} * sin({_THETA})) * {_FEET}, {digits})".format(lon=lon, lat=lat)
    y = f"round(({RHO_0!r}::DOUBLE - {_RHO} * cos({_THETA})) * {_FEET}, {digits})".format(lon=lon, lat=lat)
    return f"{x} AS x, {y} AS y"


def _sql_lonlat(key: str) -> tuple[str, str]:
    return f"(-91 + ({key} % 2000)::DOUBLE / 1000)", f"(34 + ({key} % 1777)::DOUBLE / 1000)"


def _rounded(df: DataFrame, digits: int = 3) -> DataFrame:
    return df.withColumns({"x": F.round("x", digits), "y": F.round("y", digits)})


@query(f"SELECT c_custkey, {_projected(*_sql_lonlat('c_custkey'))} FROM customer")
def project_lcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    lon, lat = _lonlat("c_custkey")
    x, y = to_state_plane(F.expr(lon), F.expr(lat))
    return _rounded(table(spark, sf_dir, "customer").select("c_custkey", x.alias("x"), y.alias("y")))


@query(
    """SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 OR c_custkey % 7 = 0 THEN NULL ELSE
  'SRID=2274;POINT(' || c_custkey || '.5 ' || c_nationkey || '.5)' END AS point FROM customer"""
)
def make_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey",
        "if(c_custkey % 10 = 0, double('NaN'), c_custkey + 0.5D) as x",
        "if(c_custkey % 7 = 0, null, c_nationkey + 0.5D) as y",
    )
    return rows.select("c_custkey", point_text(F.col("x"), F.col("y")).alias("point"))


@query(
    f"""SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS state_code, lpad(CAST(c_custkey % 200 AS VARCHAR), 3, '0') AS county_code,
  {_projected(*_sql_lonlat('c_custkey'))} FROM customer
  WHERE lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 200 AS VARCHAR), 3, '0') IN ('05035', '17117', '20020', '00004', '12199', '03003')"""
)
def code_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Air-quality cleaning: padded codes, county filter, projection, coordinates replaced."""
    lon, lat = _lonlat("c_custkey")
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "c_nationkey as state_code", "c_custkey % 200 as county_code", f"{lon} as longitude", f"{lat} as latitude"
    )
    return _rounded(clean.air_quality(raw, ["05035", "17117", "20020", "00004", "12199", "03003"]))


@query(
    f"""SELECT c_custkey, c_mktsegment AS state_code, c_name AS county_name, {_projected(*_sql_lonlat('c_custkey'))} FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'FURNITURE') AND right(c_name, 1) IN ('1', '4')"""
)
def membership_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brownfield cleaning: state and county lists, county compared without case."""
    lon, lat = _lonlat("c_custkey")
    customer = table(spark, sf_dir, "customer")
    raw = customer.selectExpr(
        "c_custkey",
        "c_mktsegment as state_code",
        "c_name",
        "if(right(c_name, 1) in ('1', '4'), 'ShElby', 'Elsewhere') as county_name",
        f"{lon} as longitude83",
        f"{lat} as latitude83",
    )
    kept = clean.brownfields(raw, ["BUILDING", "FURNITURE"], ["shelby", "tipton"])
    return _rounded(kept).select("c_custkey", "state_code", F.col("c_name").alias("county_name"), "x", "y")


@query(
    f"""SELECT o_orderkey AS st_case, (o_orderkey % 60)::INTEGER AS state, o_orderstatus AS status, {_projected(*_sql_lonlat('o_orderkey'))} FROM orders
  WHERE o_orderkey % 60 IN (5, 28, 47) AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')"""
)
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crash cleaning: orders of three states that occur in the other file."""
    lon, lat = _lonlat("o_orderkey")
    accidents = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as st_case", "cast(o_orderkey % 60 as int) as state", "o_orderstatus as status", f"{lon} as longitud", f"{lat} as latitude"
    )
    involved = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").selectExpr(
        "l_orderkey as st_case", "cast(l_orderkey % 60 as int) as state"
    )
    return _rounded(clean.crashes(accidents, involved))


@query(
    """SELECT c_custkey AS id, c_mktsegment AS state, c_name AS city FROM customer
  WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey <> 3
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)"""
)
def anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New public projects: list filters, an equality filter, and no id that is loaded already."""
    raw = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as id", "c_mktsegment as state", "'Memphis' as city", "c_name", "if(c_nationkey = 3, 'Yes', 'No') as isconfidential"
    )
    loaded = table(spark, sf_dir, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("id"))
    out = clean.new_green_buildings(raw, loaded, ["BUILDING", "MACHINERY"])
    return out.select("id", "state", F.col("c_name").alias("city"))


@query(
    """SELECT c_custkey AS id, c_name AS name, s_acctbal AS x, s_nationkey::DOUBLE AS y FROM customer JOIN supplier ON s_suppkey = c_custkey"""
)
def attach_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    found = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as resultid", "s_acctbal as lon", "double(s_nationkey) as lat", "s_nationkey"
    )
    matched, unmatched = found.where("s_nationkey < 12"), found.where("s_nationkey >= 12")
    return clean.attach_locations(rows, matched.drop("s_nationkey"), unmatched.drop("s_nationkey"))


@query(
    """WITH y AS (SELECT o_orderkey, year(o_orderdate) y, o_orderkey % 3 g FROM orders)
  SELECT o_orderkey, CASE g WHEN 0 THEN 'Survey, ' || (y + 2) || '-' || (y + 2) WHEN 1 THEN 'File ' || (y + 1)
    ELSE 'No year here' END AS rolled,
  CASE g WHEN 0 THEN 'Survey, ' || (y + 1) || '-' || (y + 2) WHEN 1 THEN 'File ' || (y + 1) ELSE 'No year here' END AS at_once FROM y"""
)
def year_roll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consecutive years move twice when they are replaced in turn, once when all move together."""
    text = F.expr(
        "case o_orderkey % 3 when 0 then concat('Survey, ', year(o_orderdate), '-', year(o_orderdate) + 1)"
        " when 1 then concat('File ', year(o_orderdate)) else 'No year here' end"
    )
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("t"))
    return rows.select(
        "o_orderkey", roll_years(F.col("t")).alias("rolled"), roll_years(F.col("t"), True).alias("at_once")
    )


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_name as description",
        "concat('S', p_partkey, if(p_partkey % 3 = 0, '16', '15')) as descid",
        "concat(p_type, ' 2016') as source",
        "p_brand as title",
        "cast(p_size % 10 + 1 as string) as categoryid",
    )


_ROLLED = "WHERE p_partkey % 3 = 0 AND p_type IN ('ECONOMY', 'PROMO')"


@query(
    f"""SELECT p_name AS description, 'S' || p_partkey || '17' AS descid, p_type || ' 2017' AS source, p_brand AS title,
  CAST(p_size % 10 + 1 AS VARCHAR) AS categoryid FROM part {_ROLLED}"""
)
def roll_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.roll_sources(_sources(spark, sf_dir), listed=["ECONOMY 2016", "PROMO 2016"])


@query(
    f"""SELECT 'per ' || p_size || ' in 2018' AS units, 'f' || p_partkey AS field, 'S' || p_partkey || '17' AS citation, p_name AS field_desc
  FROM part {_ROLLED}"""
)
def roll_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = table(spark, sf_dir, "part").selectExpr(
        "concat('per ', p_size, ' in 2017') as units",
        "concat('f', p_partkey) as field",
        "concat('S', p_partkey, '16') as citation",
        "p_name as field_desc",
    )
    return clean.roll_dictionary(dictionary, _sources(spark, sf_dir), listed=["ECONOMY 2016", "PROMO 2016"])


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS id, c_acctbal AS latitude83, c_name || ', \"x\"' AS county_name FROM customer")
def csv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quoted CSV written and read back with a fixed schema: codes keep their zeros, numbers are numbers."""
    root = f"{shared_dir(spark).rstrip('/')}/areastats-csv-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    rows = table(spark, sf_dir, "customer").selectExpr(
        "lpad(cast(c_custkey as string), 6, '0') as ID", "c_acctbal as LATITUDE83", "concat(c_name, ', \"x\"') as County_Name"
    )
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(root)
    return read_brownfields(spark, root)


@query("SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS city, CASE WHEN s_nationkey = 3 THEN 'Yes' ELSE 'No' END AS isconfidential FROM supplier")
def tsv_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = f"{shared_dir(spark).rstrip('/')}/areastats-tsv-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    rows = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as Id", "s_name as City", "if(s_nationkey = 3, 'Yes', 'No') as IsConfidential"
    )
    rows.write.mode("overwrite").option("header", True).option("sep", "\t").csv(root)
    return read_green_buildings(spark, root)
