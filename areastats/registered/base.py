"""Registration and the mapping of driver tables to areas and layers.

Areas are nations (a 5 x 5 board of squares of 100,000 ft) and regions (the squares of their nations as parts).
Customers and suppliers are points from their keys; the half foot keeps them off the borders. Where pairs of points are
sought, `sheet` moves every block of keys to its own stretch of the plane, so that the density stays the same and the
work grows with the tables, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions.geometry import rings_from_vertices
from areastats.functions.text import zfill

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

SIDE = 100000.0
CELL = 25000.0


def query(sql: str | None = None):
    """Register a function `(spark, sf_dir) -> DataFrame` under its name, with its SQL."""

    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def square_rings(x: str, y: str, size: str) -> str:
    """SQL for one closed square ring."""
    corners = [(x, y), (f"{x} + {size}", y), (f"{x} + {size}", f"{y} + {size}"), (x, f"{y} + {size}")]
    pts = ", ".join(f"named_struct('x', double({a}), 'y', double({b}))" for a, b in corners)
    return f"array(named_struct('part', 0, 'hole', false, 'pts', array({pts})))"


def nation_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return nation.selectExpr(
        "'nation' as geography",
        "lpad(cast(n_nationkey as string), 2, '0') as geoid10",
        "n_name as name10",
        "2589988D * 4 * (n_nationkey + 1) as aland10",
        f"{square_rings('(n_nationkey % 5) * 100000', '(n_nationkey div 5) * 100000', '100000')} as rings",
    )


def region_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions from vertex rows: one part per nation."""
    corners = [(0, 0), (1, 0), (1, 1), (0, 1)]
    listed = ", ".join(f"named_struct('seq', {i}, 'dx', {a}, 'dy', {b})" for i, (a, b) in enumerate(corners))
    nation = table(spark, sf_dir, "nation")
    vertex = nation.selectExpr("n_nationkey", "n_regionkey", f"inline(array({listed}))").selectExpr(
        "n_regionkey",
        "n_nationkey as part",
        "0 as ring",
        "seq",
        "double((n_nationkey % 5 + dx) * 100000) as x",
        "double((n_nationkey div 5 + dy) * 100000) as y",
    )
    shapes = rings_from_vertices(vertex, ["n_regionkey"])
    region = table(spark, sf_dir, "region")
    return region.join(shapes, region["r_regionkey"] == shapes["n_regionkey"]).selectExpr(
        "'region' as geography",
        "concat('R', r_regionkey) as geoid10",
        "r_name as name10",
        "2589988D * 100 * (r_regionkey + 1) as aland10",
        "rings",
    )


def areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nation_areas(spark, sf_dir).unionByName(region_areas(spark, sf_dir))


def customer_points(spark: SparkSession, sf_dir: str, sheet: bool = False) -> DataFrame:
    shift = " + 500000 * (c_custkey div 15000)" if sheet else ""
    return table(spark, sf_dir, "customer").withColumns(
        {
            "feature_id": F.col("c_custkey"),
            "x": F.expr(f"(c_custkey * 7919) % 500000 + 0.5D{shift}"),
            "y": F.expr("(c_custkey * 104729) % 500000 + 0.5D"),
        }
    )


def supplier_points(spark: SparkSession, sf_dir: str, sheet: bool = False) -> DataFrame:
    shift = " + 500000 * (s_suppkey div 1000)" if sheet else ""
    return table(spark, sf_dir, "supplier").withColumns(
        {
            "feature_id": F.col("s_suppkey"),
            "x": F.expr(f"(s_suppkey * 15485863) % 500000 + 0.5D{shift}"),
            "y": F.expr("(s_suppkey * 32452843) % 500000 + 0.5D"),
        }
    )


def supplier_diamonds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds of 20,000 ft and more around suppliers, with a hole of half the radius."""
    at = supplier_points(spark, sf_dir, sheet=True).withColumn("r", F.expr("20000D + 100 * (s_suppkey % 50)"))

    def ring(r: str) -> str:
        corners = [("x", f"y - {r}"), (f"x + {r}", "y"), ("x", f"y + {r}"), (f"x - {r}", "y")]
        return "array(" + ", ".join(f"named_struct('x', {a}, 'y', {b})" for a, b in corners) + ")"

    rings = (
        f"array(named_struct('part', 0, 'hole', false, 'pts', {ring('r')}),"
        f" named_struct('part', 0, 'hole', true, 'pts', {ring('r / 2')}))"
    )
    return at.selectExpr("s_suppkey", "'diamond' as geography", "cast(s_suppkey as string) as geoid10", f"{rings} as rings")


def code(column: str):
    """Area code of a nation key."""
    return zfill(F.col(column), 2)


# SQL shared by the checks.
NATION_CTE = """nat AS (SELECT n_nationkey k, n_regionkey rk, n_name, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS geoid10,
  ((n_nationkey % 5) * 100000)::DOUBLE x0, ((n_nationkey // 5) * 100000)::DOUBLE y0 FROM nation)"""
AREA_CTE = (
    NATION_CTE
    + """, area AS (SELECT 'nation' geography, geoid10, x0, y0, (4 * (k + 1))::DOUBLE sqmi FROM nat
  UNION ALL SELECT 'region', 'R' || rk, x0, y0, (100 * (rk + 1))::DOUBLE FROM nat)"""
)
CUSTOMER_CTE = """cust AS (SELECT *, ((c_custkey * 7919) % 500000)::DOUBLE + 0.5 AS x,
  ((c_custkey * 104729) % 500000)::DOUBLE + 0.5 AS y FROM customer)"""
CUSTOMER_SHEET_CTE = """cust AS (SELECT *, ((c_custkey * 7919) % 500000 + 500000 * (c_custkey // 15000))::DOUBLE + 0.5 AS x,
  ((c_custkey * 104729) % 500000)::DOUBLE + 0.5 AS y FROM customer)"""
SUPPLIER_CTE = """supp AS (SELECT *, ((s_suppkey * 15485863) % 500000)::DOUBLE + 0.5 AS x,
  ((s_suppkey * 32452843) % 500000)::DOUBLE + 0.5 AS y FROM supplier)"""
SUPPLIER_SHEET_CTE = """supp AS (SELECT *, ((s_suppkey * 15485863) % 500000 + 500000 * (s_suppkey // 1000))::DOUBLE + 0.5 AS x,
  ((s_suppkey * 32452843) % 500000)::DOUBLE + 0.5 AS y, 20000 + 100 * (s_suppkey % 50) AS r FROM supplier)"""
IN_AREA = "x > x0 AND x < x0 + 100000 AND y > y0 AND y < y0 + 100000"
