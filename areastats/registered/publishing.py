"""Change, legend, exports and metadata on summary tables derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.plans.change import change_table
from areastats.plans.legend import legend_breaks
from areastats.plans.metadata import data_dictionary, source_report
from areastats.plans.publish import export_csv, json_documents, json_fragments, new_rows, publish, updated_documents
from areastats.registered.base import query, table
from areastats.session import new_path, shared_dir
from areastats.sources.files import append_table, column_catalogue, read_table, replace_table
from areastats.sources.versions import get_year, put


def _customer_year(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """One row per customer with orders in a year: total, count and largest order."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    return (
        table(spark, sf_dir, "orders")
        .where(f"o_orderdate >= timestamp'{year}-01-01' and o_orderdate < timestamp'{year + 1}-01-01'")
        .groupBy(F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("geoid10"))
        .agg(
            F.sum(amount).cast("double").alias("total"),
            F.count(F.lit(1)).cast("double").alias("n"),
            F.max(amount).cast("double").alias(f"top{year}"),
        )
        .withColumn("sqmiland", F.lit(1.0))
    )


_YEAR = """SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS geoid10, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS total,
  count(*)::DOUBLE AS n FROM orders WHERE year(o_orderdate) = {} GROUP BY 1"""


@query(
    f"""WITH a AS ({_YEAR.format(1997)}), b AS ({_YEAR.format(1998)})
  SELECT b.geoid10, NULL::DOUBLE AS sqmiland, round((b.total - a.total) / b.total * 100, 2) AS total, round((b.n - a.n) / b.n * 100, 2) AS n,
  NULL::DOUBLE AS top1998 FROM b LEFT JOIN a USING (geoid10)"""
)
def change_by_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percent change relative to the newer year; columns of only one year stay null."""
    return change_table(_customer_year(spark, sf_dir, 1997), _customer_year(spark, sf_dir, 1998))


@query(
    f"""WITH a AS ({_YEAR.format(1997)}), b AS ({_YEAR.format(1998)})
  SELECT 'counts' AS name, geoid10, n AS value FROM a UNION ALL SELECT 'totals', geoid10, total FROM b"""
)
def carried_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year's tables with what it inherits: totals were replaced in 1998, counts stop in 1997."""
    root = new_path(spark, "years")
    for year in (1996, 1997):
        found = _customer_year(spark, sf_dir, year)
        put(found.select("geoid10", F.col("total").alias("value")), root, "totals", str(year))
        put(found.select("geoid10", F.col("n").alias("value")), root, "counts", str(year))
    newest = _customer_year(spark, sf_dir, 1998)
    put(newest.select("geoid10", F.col("n").alias("value")), root, "totals", "1998")
    put(newest.select("geoid10", F.col("total").alias("value")), root, "totals", "1998")
    tables = get_year(spark, root, "1998")
    return tables["counts"].select(F.lit("counts").alias("name"), "*").unionByName(
        tables["totals"].select(F.lit("totals").alias("name"), "*")
    )


def _legend_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per region table, one row per customer of its nations; the balance is null for some, with gaps of every kind."""
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        F.concat(F.lit("summary_cen_r"), "n_regionkey").alias("table_name"),
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("geoid10"),
        F.when(F.col("c_custkey") % 7 >= 2, F.col("c_acctbal")).alias("balance"),
        (F.col("c_custkey") % 101).cast("double").alias("grade"),
        F.col("c_mktsegment").alias("segment"),
    )


_LEGEND = """WITH s AS (SELECT 'summary_cen_r' || n_regionkey AS table_name, c_custkey, CASE WHEN c_custkey % 7 >= 2 THEN c_acctbal END balance,
    (c_custkey % 101)::DOUBLE grade FROM customer JOIN nation ON c_nationkey = n_nationkey),
  l AS (SELECT table_name, c_custkey, 'balance' AS column_name, balance AS v FROM s UNION ALL SELECT table_name, c_custkey, 'grade', grade FROM s),
  m AS (SELECT table_name, column_name, median(v) md, min(v) low FROM l GROUP BY ALL),
  p AS (SELECT l.*, row_number() OVER (PARTITION BY table_name, column_name ORDER BY c_custkey) rn FROM l),
  f AS (SELECT table_name, column_name, rn, CASE WHEN rn = 1 AND v IS NULL THEN md ELSE v END v FROM p JOIN m USING (table_name, column_name)),
  g AS (SELECT *, last_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER w ar, last_value(v IGNORE NULLS) OVER w av,
    first_value(CASE WHEN v IS NOT NULL THEN rn END IGNORE NULLS) OVER x br, first_value(v IGNORE NULLS) OVER x bv FROM f
    WINDOW w AS (PARTITION BY table_name, column_name ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    x AS (PARTITION BY table_name, column_name ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
  h AS (SELECT table_name, column_name, coalesce(v, CASE WHEN br IS NULL THEN av ELSE av + (bv - av) * (rn - ar) / (br - ar) END) v FROM g)
"""


@query(
    _LEGEND
    + """SELECT table_name, column_name, round_even(any_value(low), 2) AS min, """
    + ", ".join(f"round_even(quantile_cont(v, {q}), 2) AS q{i}" for i, q in enumerate((0.2, 0.4, 0.6, 0.8, 1.0), 1))
    + """ FROM h JOIN m USING (table_name, column_name) GROUP BY 1, 2
  UNION ALL SELECT DISTINCT table_name, 'segment', 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE FROM s"""
)
def legend_breaks_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quintiles after filling gaps in area order, two decimals half-even as published."""
    return legend_breaks(_legend_source(spark, sf_dir))


@query(
    """SELECT n_regionkey AS region, '[' || string_agg('{"geoid10":"' || geoid10 || '","name10":"' || n_name || '","customers":' ||
  coalesce(CAST(n AS VARCHAR), 'null') || '}', ',' ORDER BY geoid10) || ']' AS csv FROM
  (SELECT n_regionkey, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geoid10, n_name, nullif(count(c_custkey), 0) n FROM nation
   LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9000 GROUP BY ALL) GROUP BY 1"""
)
def json_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON array of row objects per table, null fields kept."""
    rich = (
        table(spark, sf_dir, "customer").where("c_acctbal > 9000").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("customers"))
    )
    nation = table(spark, sf_dir, "nation")
    rows = nation.join(rich, F.col("c_nationkey") == F.col("n_nationkey"), "left").selectExpr(
        "n_regionkey as region", "lpad(cast(n_nationkey as string), 2, '0') as geoid10", "n_name as name10", "customers"
    )
    return json_documents(rows, ["geoid10"], ["region"])


@query(
    """WITH r AS (SELECT n_nationkey AS nation, row_number() OVER (PARTITION BY n_nationkey ORDER BY o_orderkey) - 1 AS pos,
    count(*) OVER (PARTITION BY n_nationkey) AS n, '{"geoid10":' || o_orderkey || ',"status":"' || o_orderstatus || '"}' AS j
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
  SELECT nation, CAST(pos // 100 AS BIGINT) AS fragment, (CASE WHEN pos // 100 = 0 THEN '[' ELSE ',' END) || string_agg(j, ',' ORDER BY pos)
    || (CASE WHEN pos // 100 = (any_value(n) - 1) // 100 THEN ']' ELSE '' END) AS text FROM r GROUP BY nation, pos // 100"""
)
def json_in_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders of each nation as one JSON array, a hundred objects a row."""
    customer = table(spark, sf_dir, "customer").selectExpr("c_custkey as o_custkey", "c_nationkey as nation")
    rows = table(spark, sf_dir, "orders").join(customer, "o_custkey")
    return json_fragments(rows.selectExpr("nation", "o_orderkey as geoid10", "o_orderstatus as status"), ["geoid10"], ["nation"], 100)


def _nation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .groupBy(F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("geoid10"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    """WITH s AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS geoid10, count(*) n FROM customer GROUP BY 1)
  SELECT 0::BIGINT AS geographyid, '[' || string_agg('{"geoid10":"' || geoid10 || '","n":' || n || '}', ',' ORDER BY geoid10) || ']' AS csv FROM s
  UNION ALL SELECT 2::BIGINT, '[' || string_agg('{"geoid10":"' || geoid10 || '","n":0.0}', ',' ORDER BY geoid10) || ']' FROM s
  UNION ALL SELECT n_nationkey::BIGINT, 'old' FROM nation WHERE n_nationkey NOT IN (0, 2)"""
)
def publish_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a summary and its change table put in place of the stored ones."""
    nation = table(spark, sf_dir, "nation")
    geographies = nation.selectExpr(
        "cast(n_nationkey as bigint) as id",
        "if(n_nationkey = 2, 'chng', '2018') as year",
        "if(n_nationkey in (0, 2), 'tract', n_name) as geotype",
    )
    compiled = nation.selectExpr("cast(n_nationkey as bigint) as geographyid", "'old' as csv")
    summary = _nation_summary(spark, sf_dir)
    tables = {"summary_cen_tract_2010": summary, "summary_cen_tract_2010_chng": change_table(summary, summary)}
    return updated_documents(compiled, publish(tables, geographies, "2018"))


@query(
    """SELECT c_custkey AS geographyid, c_name AS label FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)
  UNION ALL SELECT o_custkey, 'published' FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 300000)"""
)
def promote_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows appended to the stored table, which is then read back."""
    root = f"{shared_dir(spark).rstrip('/')}/areastats-promote-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    published = table(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("id")).distinct()
    replace_table(published.select(F.col("id").alias("geographyid"), F.lit("published").alias("label")), root, "geographylabels")
    staging = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("geographyid"), F.col("c_name").alias("label"))
    append_table(new_rows(staging, "geographyid", published), root, "geographylabels")
    return read_table(spark, root, "geographylabels")


@query(
    """SELECT CAST(row_number() OVER (ORDER BY geoid10) - 1 AS VARCHAR) AS "index", geoid10, CAST(n AS VARCHAR) AS n FROM
  (SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS geoid10, count(*) AS n FROM orders GROUP BY 1)"""
)
def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary exported as CSV with row numbers, read back as text."""
    root = f"{shared_dir(spark).rstrip('/')}/areastats-export-{spark.sparkContext.applicationId}/{sf_dir.strip('/').replace('/', '-')}"
    summary = (
        table(spark, sf_dir, "orders")
        .groupBy(F.lpad(F.col("o_custkey").cast("string"), 12, "0").alias("geoid10"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    name = export_csv({"summary_cen_tract_2010": summary}, root, "2018")[0]
    return spark.read.option("header", True).csv(f"{root}/{name}.csv")


@query(
    """WITH f AS (SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'b' || lpad(CAST(p_size AS VARCHAR), 5, '0') || lpad(CAST(p_partkey % 5 AS VARCHAR), 3, '0')
      WHEN 1 THEN 'layer_' || p_size ELSE 'other_' || p_partkey END field, p_size, p_partkey % 5 ln FROM part),
  d AS (SELECT DISTINCT field, p_size, CASE WHEN p_partkey % 3 = 0 THEN ln END ln, p_partkey % 3 g FROM f)
  SELECT CASE g WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN 'percent' ELSE '' END WHEN 1 THEN 'miles' ELSE 'NA' END AS units, field,
  CASE g WHEN 0 THEN CASE WHEN p_size % 2 = 0 THEN 'ACS16' ELSE '' END WHEN 1 THEN 'LYR16' ELSE 'NA' END AS citation,
  CASE g WHEN 0 THEN 'Table ' || p_size || ':' || CASE WHEN ln < 3 THEN 'Line ' || ln ELSE '' END WHEN 1 THEN 'Layer ' || p_size ELSE 'NA' END AS field_desc FROM d"""
)
def data_dictionary_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    survey = "concat('b', lpad(cast(p_size as string), 5, '0'))"
    line = f"concat({survey}, lpad(cast(p_partkey % 5 as string), 3, '0'))"
    fields = part.selectExpr(
        f"case p_partkey % 3 when 0 then {line} when 1 then concat('layer_', p_size) else concat('other_', p_partkey) end as field"
    ).distinct()
    table_titles = part.selectExpr(f"upper({survey}) as id", "concat('Table ', p_size) as title")
    line_titles = part.where("p_partkey % 5 < 3").selectExpr(f"upper({line}) as field", "concat('Line ', p_partkey % 5) as title")
    layers = part.selectExpr(
        "concat('layer_', p_size) as field", "concat('Layer ', p_size) as description", "'miles' as units", "'LYR16' as citation"
    ).unionByName(
        part.where("p_size % 2 = 0").selectExpr(
            f"{survey} as field", "'unused' as description", "'percent' as units", "'ACS16' as citation"
        )
    )
    return data_dictionary(fields, table_titles, line_titles, layers)


_CATEGORY = " ".join(
    f"WHEN {i} THEN '{n}'"
    for i, n in enumerate(
        [
            "Demographics", "Community Development", "Housing", "Transportation", "Environment", "Economy & Jobs",
            "Education", "Arts & Community", "Community Engagement", "Health & Safety",
        ],
        1,
    )
)


@query(
    f"""WITH d AS (SELECT p_partkey, 'o_' || CASE p_partkey % 6 WHEN 0 THEN 'orderkey' WHEN 1 THEN 'custkey' WHEN 2 THEN 'orderstatus' WHEN 3 THEN 'totalprice'
      WHEN 4 THEN 'orderdate' ELSE 'missing' END field, p_size % 11 c, p_name, p_brand, p_partkey % 4 s FROM part WHERE p_partkey % 10 <> 9)
  SELECT DISTINCT p_name AS field_desc, CASE c {_CATEGORY} END AS category, p_brand AS title,
  CASE s WHEN 0 THEN 'x U.S. Green Building Council' WHEN 1 THEN 'The U.S. Environmental Protection Agency, 2016'
    WHEN 2 THEN '2016 Shelby County Assessor''s Certified Roll' ELSE 'UxSx Green Building Council' END AS source,
  CASE s WHEN 0 THEN 'Winter' WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' ELSE 'None' END AS update_period,
  CASE WHEN field = 'o_custkey' THEN 'county, tract' ELSE 'tract' END AS geography,
  CASE WHEN field IN ('o_orderkey', 'o_totalprice') THEN 'Yes' ELSE 'No' END AS change FROM d WHERE field <> 'o_missing'"""
)
def metadata_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources, categories and seasons of the columns of two summary tables."""
    orders = table(spark, sf_dir, "orders")
    columns = column_catalogue(
        {
            "summary_cen_tract_2010": orders,
            "summary_cen_county_2010": orders.select("o_custkey"),
            "parcels_cen_zip_2010": orders,
        }
    )
    part = table(spark, sf_dir, "part")
    dictionary = part.selectExpr(
        "concat('o_', case p_partkey % 6 when 0 then 'orderkey' when 1 then 'custkey' when 2 then 'orderstatus'"
        " when 3 then 'totalprice' when 4 then 'orderdate' else 'missing' end) as field",
        "if(p_partkey % 10 = 9, null, p_name) as field_desc",
        "concat('S', p_partkey) as citation",
        "'n' as units",
    )
    sources = part.selectExpr(
        "concat('S', p_partkey) as descid",
        "case p_partkey % 4 when 0 then 'x U.S. Green Building Council' when 1 then 'The U.S. Environmental Protection Agency, 2016'"
        " when 2 then '2016 Shelby County Assessor\\'s Certified Roll' else 'UxSx Green Building Council' end as source",
        "p_brand as title",
        "cast(p_size % 11 as string) as categoryid",
    )
    changed = dictionary.where("field in ('o_orderkey', 'o_totalprice')").select("field")
    return source_report(columns, dictionary, sources, changed)
