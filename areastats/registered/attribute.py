"""Key joins, ratios and aggregates without geometry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions.numbers import numeric, pct, pct_zero, recode, year_gap
from areastats.operators import families as fam
from areastats.plans.indicators import pending, summary_base
from areastats.registered.base import areas, code, nation_areas, query, table


def _status_by_nation(spark: SparkSession, sf_dir: str, where: str = "true") -> DataFrame:
    """Order counts per nation; the orders are counted per customer before they meet the customers."""
    per_customer = (
        table(spark, sf_dir, "orders")
        .where(where)
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", code("c_nationkey").alias("geoid"))
    joined = customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey"), "left")
    return joined.groupBy("geoid").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("f"), F.lit(0)).alias("f")
    )


_STATUS = """SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geoid10, count(o_orderkey) n,
  count(CASE WHEN o_orderstatus = 'F' THEN 1 END) f
  FROM customer LEFT JOIN (SELECT * FROM orders WHERE {where}) o ON o_custkey = c_custkey GROUP BY 1"""


@query(
    """SELECT 'nation' AS geography, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geoid10, n_name AS name10,
  4 * (n_nationkey + 1)::DOUBLE AS sqmiland, round(2589988.0 * 4 * (n_nationkey + 1) / 4046.86, 4)::DOUBLE AS acreland
  FROM nation UNION ALL
  SELECT 'region', 'R' || r_regionkey, r_name, 100 * (r_regionkey + 1)::DOUBLE,
  round(2589988.0 * 100 * (r_regionkey + 1) / 4046.86, 4)::DOUBLE FROM region"""
)
def base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_base(areas(spark, sf_dir)).withColumn("acreland", F.round("acreland", 4))


@query(
    """WITH v AS (SELECT c_nationkey, sum(c_acctbal::DECIMAL(18,2)) s FROM customer
  WHERE c_mktsegment = 'BUILDING' GROUP BY 1)
  SELECT n_name AS name10, s::DOUBLE AS value FROM nation LEFT JOIN v ON c_nationkey = n_nationkey"""
)
def attr_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = (
        table(spark, sf_dir, "customer")
        .where("c_mktsegment = 'BUILDING'")
        .groupBy(code("c_nationkey").alias("geoid"))
        .agg(F.sum(F.col("c_acctbal").cast("decimal(18,2)")).alias("value"))
    )
    joined = fam.attach(nation_areas(spark, sf_dir), values, "geoid", ["value"])
    return joined.select("name10", numeric(F.col("value")).cast("double").alias("value"))


_RARE = "o_totalprice > 499000"


@query(
    f"""WITH s AS ({_STATUS.format(where=_RARE)})
  SELECT geoid10, round(100.0::DOUBLE * f / nullif(n, 0), 2)::DOUBLE AS pct_f FROM s"""
)
def pct_null_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _status_by_nation(spark, sf_dir, _RARE)
    return counts.select(
        F.col("geoid").alias("geoid10"), numeric(pct(F.col("f"), F.col("n"))).cast("double").alias("pct_f")
    )


@query(
    f"""WITH s AS ({_STATUS.format(where=_RARE)})
  SELECT geoid10, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round(100.0::DOUBLE * f / n, 2)::DOUBLE END AS pct_f FROM s"""
)
def pct_zero_safe(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _status_by_nation(spark, sf_dir, _RARE)
    return counts.select(
        F.col("geoid").alias("geoid10"), numeric(pct_zero(F.col("f"), F.col("n"))).cast("double").alias("pct_f")
    )


@query(
    """SELECT c_nationkey AS nation, round(1998 - avg(year(o_orderdate)), 4)::DOUBLE AS age
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"""
)
def ref_year_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(F.sum(F.year("o_orderdate")).alias("s"), F.count("o_orderdate").alias("n"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    mean = F.try_divide(F.sum("s"), F.sum("n"))
    return (
        years.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("nation"))
        .agg(F.round(year_gap(1998, mean), 4).alias("age"))
    )


@query(
    """SELECT l_linestatus, round(100.0 * count(CASE WHEN l_returnflag = 'R' THEN 1 END) / count(l_returnflag), 2)::DOUBLE
  AS pct_returned FROM lineitem GROUP BY 1"""
)
def cond_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    share = fam.share_where(flag == "R", flag)
    out = table(spark, sf_dir, "lineitem").groupBy("l_linestatus").agg(share.alias("pct_returned"))
    return out.withColumn("pct_returned", F.round("pct_returned", 2))


@query(
    """SELECT c_nationkey AS nation, round(100 * sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal::DECIMAL(18,2) END)
  ::DOUBLE / nullif(sum(c_acctbal::DECIMAL(18,2))::DOUBLE, 0), 2) AS building_share FROM customer GROUP BY 1"""
)
def weighted_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    amount = F.col("c_acctbal").cast("decimal(18,2)")
    part = F.when(F.col("c_mktsegment") == "BUILDING", amount)
    out = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("nation"))
    return out.agg(F.round(fam.weighted_share(part, amount), 2).alias("building_share"))


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "SELECT year(o_orderdate)::INTEGER AS year, "
    + ", ".join(
        f"round(100 * sum(CASE WHEN c_mktsegment = '{s}' THEN o_totalprice::DECIMAL(18,2) ELSE 0 END)::DOUBLE"
        f" / sum(o_totalprice::DECIMAL(18,2))::DOUBLE, 2) AS pct_{s.lower()}"
        for s in _SEGMENTS
    )
    + " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"
)
def sector_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    per = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    shares = [
        F.round(
            fam.weighted_share(
                F.when(F.col("c_mktsegment") == s, F.col("amount")).otherwise(F.lit(0)), F.col("amount")
            ),
            2,
        ).alias(f"pct_{s.lower()}")
        for s in _SEGMENTS
    ]
    return per.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("year").agg(*shares)


@query(
    """WITH m AS (SELECT lower('nation_' || c_nationkey) AS nm, min(c_acctbal) AS low FROM customer GROUP BY 1)
  SELECT lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geoid10, low FROM nation JOIN m ON lower(n_name) = nm"""
)
def name_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("Nation_"), "c_nationkey").alias("municipali"), F.col("c_acctbal").alias("low")
    )
    return fam.name_match(nation_areas(spark, sf_dir), named, "municipali", ["low"]).select("geoid10", "low")


@query(
    """WITH a AS (SELECT c_nationkey k, year(o_orderdate) y, sum(o_totalprice::DECIMAL(18,2))::DOUBLE s
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) IN (1997, 1998) GROUP BY 1, 2),
  p AS (SELECT k, sum(CASE WHEN y = 1998 THEN s END) n, round(sum(CASE WHEN y = 1997 THEN s END) * (236.736::DOUBLE / 188.9::DOUBLE), 2) o
  FROM a GROUP BY 1)
  SELECT lpad(CAST(k AS VARCHAR), 2, '0') AS geoid10, round(100 * (n - o) / nullif(o, 0), 2) AS pct_change
  FROM p WHERE n IS NOT NULL AND o IS NOT NULL"""
)
def real_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", F.lit("nation").alias("geography"), code("c_nationkey").alias("geoid10")
    )
    per = (
        table(spark, sf_dir, "orders")
        .where("o_orderdate >= timestamp'1997-01-01' and o_orderdate < timestamp'1999-01-01'")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("geography", "geoid10", "year")
        .agg(F.sum("amount").cast("double").alias("amount"))
    )
    now = per.where("year = 1998").select("geography", "geoid10", F.col("amount").alias("now"))
    then = per.where("year = 1997").select("geography", "geoid10", F.col("amount").alias("then"))
    out = fam.change_share(now, then, "now", "then", 236.736 / 188.9, "pct_change")
    return out.select("geoid10", F.round("pct_change", 2).alias("pct_change"))


@query(
    """SELECT o_orderkey, CASE p WHEN 0 THEN 0 WHEN 1 THEN 200 WHEN 2 THEN 400 WHEN 3 THEN 600 WHEN 4 THEN 800
  WHEN 5 THEN 1000 END AS band FROM (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) + 1 p FROM orders)"""
)
def recode_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.substring("o_orderpriority", 1, 1).cast("int") + 1
    band = recode(level, {0: 0, 1: 200, 2: 400, 3: 600, 4: 800, 5: 1000})
    return table(spark, sf_dir, "orders").select("o_orderkey", band.alias("band"))


_RATES = {"a_f": ("A", "F"), "a_o": ("A", "O"), "n_f": ("N", "F"), "n_o": ("N", "O"), "r_f": ("R", "F"), "r_o": ("R", "O")}


@query(
    "WITH a AS (SELECT l_suppkey, l_returnflag f, l_linestatus s, avg(l_quantity) q FROM lineitem GROUP BY ALL) "
    "SELECT l_suppkey AS supplier, "
    + ", ".join(f"round(max(CASE WHEN f = '{a}' AND s = '{b}' THEN q END), 4) AS {n}" for n, (a, b) in _RATES.items())
    + " FROM a GROUP BY 1"
)
def pivot_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("supplier"), "l_returnflag", "l_linestatus")
        .agg(F.avg("l_quantity").alias("avg_mo"))
    )
    out = fam.pivot_rates(rates, "supplier", "l_returnflag", "l_linestatus", "avg_mo", _RATES)
    return out.select("supplier", *[F.round(n, 4).alias(n) for n in _RATES])


@query(
    """WITH c AS (SELECT c_nationkey k, sum(c_acctbal::DECIMAL(18,2))::DOUBLE a FROM customer GROUP BY 1),
  s AS (SELECT s_nationkey k, sum(s_acctbal::DECIMAL(18,2))::DOUBLE b FROM supplier GROUP BY 1)
  SELECT lpad(CAST(k AS VARCHAR), 2, '0') AS geoid10, round(100 * b / nullif(a + b, 0), 2) AS pct_comm FROM c JOIN s USING (k)"""
)
def two_layer_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    def summed(name: str, prefix: str, out: str) -> DataFrame:
        amount = F.col(f"{prefix}_acctbal").cast("decimal(18,2)")
        keys = [F.lit("nation").alias("geography"), code(f"{prefix}_nationkey").alias("geoid10")]
        return table(spark, sf_dir, name).groupBy(*keys).agg(F.sum(amount).cast("double").alias(out))

    out = fam.composition_share(
        summed("supplier", "s", "sf"), summed("customer", "c", "sfla"), "sf", "sfla", "pct_comm"
    )
    return out.select("geoid10", F.round("pct_comm", 2).alias("pct_comm"))


@query(
    """WITH b AS (SELECT min(o_totalprice) lo, max(o_totalprice) hi FROM orders)
  SELECT o_orderkey, round(100 * (o_totalprice - lo) / hi - lo, 4) AS scaled FROM orders, b"""
)
def minmax_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    out = fam.scale_over_layer(orders, F.col("o_totalprice"), "scaled")
    return out.select("o_orderkey", F.round("scaled", 4).alias("scaled"))


@query(
    """SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
  arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM orders GROUP BY 1"""
)
def distinct_on(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return fam.distinct_on(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@query(
    """SELECT geography, geoid10, CASE WHEN (geography = 'cen_county_2010' AND geoid10 = '47157')
  OR (geography = 'cen_place_2010' AND geoid10 IN ('4701740','4748000','4716420','4749060','4740350','4728960','4703440'))
  OR (geography = 'cen_tract_2010' AND left(geoid10, 5) = '47157')
  OR (geography = 'cen_msa_2013' AND geoid10 = '32820') THEN 1 ELSE 0 END AS covered
  FROM (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'cen_county_2010' WHEN 1 THEN 'cen_place_2010' WHEN 2 THEN 'cen_tract_2010'
    ELSE 'cen_msa_2013' END geography,
    CASE o_orderkey % 4 WHEN 0 THEN CAST(47000 + o_orderkey % 1000 // 4 AS VARCHAR) WHEN 1 THEN CAST(4701740 + o_orderkey % 7 AS VARCHAR)
    WHEN 2 THEN CAST(47100 + o_orderkey % 100 AS VARCHAR) || '000100' ELSE CAST(32800 + o_orderkey % 50 AS VARCHAR) END geoid10
  FROM orders)"""
)
def coverage_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = table(spark, sf_dir, "orders").selectExpr(
        "case o_orderkey % 4 when 0 then 'cen_county_2010' when 1 then 'cen_place_2010' when 2 then 'cen_tract_2010'"
        " else 'cen_msa_2013' end as geography",
        "case o_orderkey % 4 when 0 then cast(47000 + (o_orderkey % 1000) div 4 as string)"
        " when 1 then cast(4701740 + o_orderkey % 7 as string)"
        " when 2 then concat(cast(47100 + o_orderkey % 100 as string), '000100')"
        " else cast(32800 + o_orderkey % 50 as string) end as geoid10",
    )
    return made.select("geography", "geoid10", F.when(fam.covered(), 1).otherwise(0).alias("covered"))


@query(
    """SELECT DISTINCT event_type AS indicator, user_id AS geography FROM events
  EXCEPT SELECT event_type, user_id FROM events WHERE value > 60"""
)
def resume_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    pair = [F.col("event_type").alias("indicator"), F.col("user_id").alias("geography")]
    wanted = events.select(*pair).distinct()
    return pending(wanted, events.where("value > 60").select(*pair))
