"""Spatial joins and the indicator families built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.operators import families as fam
from areastats.operators import spatial as sp
from areastats.operators.clean import clip_points
from areastats.plans.catalogue import Parameters, catalogue
from areastats.plans.indicators import RUN_FIELDS, RUN_LOG, Inputs, Layer, SourceFrames, combine, run
from areastats.registered.base import (
    AREA_CTE,
    CELL,
    CUSTOMER_CTE,
    CUSTOMER_SHEET_CTE,
    IN_AREA,
    NATION_CTE,
    SUPPLIER_CTE,
    SUPPLIER_SHEET_CTE,
    areas,
    customer_points,
    nation_areas,
    query,
    region_areas,
    square_rings,
    supplier_diamonds,
    supplier_points,
    table,
)
from areastats.session import materialise, new_path
from areastats.sources.versions import read_log


@query(f"WITH {AREA_CTE}, {CUSTOMER_CTE} SELECT geography, geoid10, count(*) AS n FROM cust JOIN area ON {IN_AREA} GROUP BY ALL")
def spatial_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = customer_points(spark, sf_dir).select("feature_id", "x", "y")
    tiles = sp.area_tiles(areas(spark, sf_dir), CELL)
    return fam.per_area(points, g.POINT_DIM, tiles, CELL, [F.count(F.lit(1)).alias("n")])


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE} SELECT geography, geoid10,
  round(sum(c_acctbal::DECIMAL(18,2))::DOUBLE / min(sqmi), 2) AS density FROM cust JOIN area ON {IN_AREA} GROUP BY ALL"""
)
def spatial_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = customer_points(spark, sf_dir).select("feature_id", "c_acctbal", "x", "y")
    shapes = areas(spark, sf_dir)
    total = F.sum(F.col("c_acctbal").cast("decimal(18,2)")).cast("double")
    sums = fam.per_area(points, g.POINT_DIM, sp.area_tiles(shapes, CELL), CELL, [total.alias("s")])
    size = shapes.select("geography", "geoid10", (F.col("aland10") / 2589988.0).alias("sqmi"))
    joined = sums.join(size, sp.AREA_KEYS)
    return joined.select(*sp.AREA_KEYS, F.round(F.col("s") / F.col("sqmi"), 2).alias("density"))


@query(
    f"""WITH {CUSTOMER_SHEET_CTE}, {SUPPLIER_SHEET_CTE}
  SELECT s_suppkey, count(*) AS n FROM supp s JOIN cust c ON abs(c.x - s.x) + abs(c.y - s.y) < r
  AND abs(c.x - s.x) + abs(c.y - s.y) > r / 2.0 GROUP BY 1"""
)
def within_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in polygons with a hole; the borders count neither way."""
    shapes = supplier_diamonds(spark, sf_dir)
    tiles = sp.tile(shapes.drop("s_suppkey"), g.POLYGON_DIM, 10000.0)
    points = customer_points(spark, sf_dir, sheet=True).select("x", "y")
    found = sp.within(points, tiles, 10000.0, many=True).groupBy("geoid10").agg(F.count(F.lit(1)).alias("n"))
    return found.select(F.col("geoid10").cast("long").alias("s_suppkey"), "n")


@query(
    f"""WITH {SUPPLIER_SHEET_CTE} SELECT s_suppkey, round(x, 4) AS x, round(y, 4) AS y FROM supp"""
)
def polygon_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = supplier_diamonds(spark, sf_dir).select("s_suppkey", "rings")
    return g.with_centroid(shapes, g.POLYGON_DIM).select("s_suppkey", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


def _supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line from each customer over its first supplier (by key) to that supplier's foot on the x axis of the board."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.min("l_suppkey").alias("supp"))
    first = (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("o_custkey").agg(F.min("supp").alias("supp"))
    )
    start = customer_points(spark, sf_dir).select("c_custkey", "x", "y")
    end = supplier_points(spark, sf_dir).select(
        F.col("s_suppkey").alias("supp"), F.col("x").alias("sx"), F.col("y").alias("sy")
    )
    joined = start.join(first, F.col("c_custkey") == F.col("o_custkey")).join(end, "supp")
    path = (
        "array(named_struct('part', 0, 'hole', false, 'pts', array(named_struct('x', x, 'y', y),"
        " named_struct('x', sx, 'y', sy), named_struct('x', sx, 'y', 0.5D))))"
    )
    return joined.selectExpr("c_custkey as feature_id", f"{path} as rings")


_LINES = f"""{CUSTOMER_CTE}, {SUPPLIER_CTE},
  f AS (SELECT o_custkey, min(l_suppkey) s FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1),
  seg AS (SELECT c_custkey id, c.x ax, c.y ay, s.x bx, s.y AS yy FROM cust c JOIN f ON o_custkey = c_custkey JOIN supp s ON s_suppkey = f.s
    UNION ALL SELECT c_custkey, s.x, s.y, s.x, 0.5::DOUBLE FROM cust c JOIN f ON o_custkey = c_custkey JOIN supp s ON s_suppkey = f.s)"""


@query(
    f"""WITH {_LINES}, w AS (SELECT *, sqrt((bx - ax) ** 2 + (yy - ay) ** 2) l FROM seg)
  SELECT id, round(CASE WHEN sum(l) = 0 THEN min(ax) ELSE sum(l * (ax + bx) / 2) / sum(l) END, 3) AS x,
  round(CASE WHEN sum(l) = 0 THEN min(ay) ELSE sum(l * (ay + yy) / 2) / sum(l) END, 3) AS y FROM w GROUP BY 1"""
)
def line_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = g.with_centroid(_supplier_lines(spark, sf_dir), g.LINE_DIM)
    return placed.select(F.col("feature_id").alias("id"), F.round("x", 3).alias("x"), F.round("y", 3).alias("y"))


_CLIP = f"""{AREA_CTE}, {_LINES},
  t AS (SELECT geography, geoid10, sqmi, id, sqrt((bx - ax) ** 2 + (yy - ay) ** 2) l,
    CASE WHEN bx = ax THEN 0.0::DOUBLE ELSE least((x0 - ax) / (bx - ax), (x0 + 100000 - ax) / (bx - ax)) END tx0,
    CASE WHEN bx = ax THEN 1.0::DOUBLE ELSE greatest((x0 - ax) / (bx - ax), (x0 + 100000 - ax) / (bx - ax)) END tx1,
    CASE WHEN yy = ay THEN 0.0::DOUBLE ELSE least((y0 - ay) / (yy - ay), (y0 + 100000 - ay) / (yy - ay)) END ty0,
    CASE WHEN yy = ay THEN 1.0::DOUBLE ELSE greatest((y0 - ay) / (yy - ay), (y0 + 100000 - ay) / (yy - ay)) END ty1
    FROM seg JOIN area ON (bx <> ax OR (ax > x0 AND ax < x0 + 100000)) AND (yy <> ay OR (ay > y0 AND ay < y0 + 100000))),
  c AS (SELECT geography, geoid10, sqmi, id, l * (least(1, tx1, ty1) - greatest(0, tx0, ty0)) part FROM t
    WHERE l > 0 AND least(1, tx1, ty1) > greatest(0, tx0, ty0))"""


@query(
    f"""WITH {_CLIP} SELECT geography, geoid10, count(DISTINCT id) AS lines, round(sum(part) / 5280 / min(sqmi), 3) AS per_sqmi
  FROM c GROUP BY ALL"""
)
def clip_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of lines within areas per square mile, without a buffer."""
    shapes = areas(spark, sf_dir)
    clipped = sp.clipped_length(_supplier_lines(spark, sf_dir), shapes.select(*sp.AREA_KEYS, "rings"), 30000.0, 0.0)
    sums = clipped.groupBy(*sp.AREA_KEYS).agg(F.count(F.lit(1)).alias("lines"), F.sum("length").alias("length"))
    size = shapes.select("geography", "geoid10", (F.col("aland10") / 2589988.0).alias("sqmi"))
    per = F.round(F.col("length") / 5280 / F.col("sqmi"), 3)
    return sums.join(size, sp.AREA_KEYS).select(*sp.AREA_KEYS, "lines", per.alias("per_sqmi"))


#: Stretches of the two segments of a line in an area, with the ends that the area leaves of them.
_STRETCHES = f"""{AREA_CTE}, {_LINES},
  t AS (SELECT geography, geoid10, id, ax, ay, bx, yy, sqrt((bx - ax) ** 2 + (yy - ay) ** 2) l,
    CASE WHEN bx = ax THEN 0.0::DOUBLE ELSE least((x0 - ax) / (bx - ax), (x0 + 100000 - ax) / (bx - ax)) END tx0,
    CASE WHEN bx = ax THEN 1.0::DOUBLE ELSE greatest((x0 - ax) / (bx - ax), (x0 + 100000 - ax) / (bx - ax)) END tx1,
    CASE WHEN yy = ay THEN 0.0::DOUBLE ELSE least((y0 - ay) / (yy - ay), (y0 + 100000 - ay) / (yy - ay)) END ty0,
    CASE WHEN yy = ay THEN 1.0::DOUBLE ELSE greatest((y0 - ay) / (yy - ay), (y0 + 100000 - ay) / (yy - ay)) END ty1
    FROM seg JOIN area ON (bx <> ax OR (ax > x0 AND ax < x0 + 100000)) AND (yy <> ay OR (ay > y0 AND ay < y0 + 100000))),
  s AS (SELECT *, greatest(0, tx0, ty0) a, least(1, tx1, ty1) b FROM t WHERE l > 0 AND least(1, tx1, ty1) > greatest(0, tx0, ty0))"""


@query(
    f"""WITH {_STRETCHES} SELECT geography, geoid10, id, round(sum(l * (b - a)), 2) AS length,
  round(min(least(ax + a * (bx - ax), ax + b * (bx - ax))), 2) AS x_min, round(max(greatest(ax + a * (bx - ax), ax + b * (bx - ax))), 2) AS x_max,
  round(min(least(ay + a * (yy - ay), ay + b * (yy - ay))), 2) AS y_min, round(max(greatest(ay + a * (yy - ay), ay + b * (yy - ay))), 2) AS y_max
  FROM s GROUP BY ALL"""
)
def clip_line_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines cut to areas: length and extent of the geometry that is left."""
    cut = sp.clip_lines(_supplier_lines(spark, sf_dir), areas(spark, sf_dir).select(*sp.AREA_KEYS, "rings"), 30000.0)
    sizes = f"transform({g.pieces(g.LINE_DIM)}, e -> sqrt((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1)))"
    spots = "flatten(transform(rings, r -> r.pts))"
    ends = [f"round(array_{m}(transform({spots}, v -> v.{c})), 2) as {c}_{m}" for c in "xy" for m in ("min", "max")]
    return cut.selectExpr(*sp.AREA_KEYS, "feature_id as id", f"round(aggregate({sizes}, 0D, (a, v) -> a + v), 2) as length", *ends)


@query(
    f"""WITH {NATION_CTE}, {SUPPLIER_SHEET_CTE} SELECT s_suppkey, geoid10 FROM supp JOIN nat
  ON greatest(x0 - x, x - x0 - 100000, 0) + greatest(y0 - y, y - y0 - 100000, 0) <= r"""
)
def intersects_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = supplier_diamonds(spark, sf_dir).select("s_suppkey", "rings")
    nations = nation_areas(spark, sf_dir).select("geoid10", "rings")
    return sp.near_pairs(shapes, g.POLYGON_DIM, nations, g.POLYGON_DIM, CELL)


@query(
    f"""WITH {NATION_CTE}, p AS (SELECT DISTINCT (c_custkey % 501 * 1000)::DOUBLE x, (c_custkey % 499 * 1000)::DOUBLE y FROM customer)
  SELECT x, y, geoid10 FROM p JOIN nat ON x >= x0 AND x <= x0 + 100000 AND y >= y0 AND y <= y0 + 100000"""
)
def intersects_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points on a lattice, many of them on borders and corners, where every touching square counts."""
    points = (
        table(spark, sf_dir, "customer")
        .selectExpr("double(c_custkey % 501 * 1000) as x", "double(c_custkey % 499 * 1000) as y")
        .distinct()
    )
    tiles = sp.area_tiles(nation_areas(spark, sf_dir), CELL)
    return sp.within(points, tiles, CELL, boundary=True).select("x", "y", "geoid10")


@query(
    f"""WITH {CUSTOMER_SHEET_CTE}, {SUPPLIER_SHEET_CTE}
  SELECT c_custkey, greatest(count(s_suppkey), 1) AS pairs FROM cust c LEFT JOIN supp s
  ON sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2) <= 20000 GROUP BY 1"""
)
def within_distance_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = customer_points(spark, sf_dir, sheet=True).select("feature_id", "x", "y")
    others = supplier_points(spark, sf_dir, sheet=True).select("feature_id", "x", "y")
    counted = fam.pairs_within(units, others, g.POINT_DIM, 20000.0, 20000.0)
    return counted.select(F.col("feature_id").alias("c_custkey"), F.col("pairs").cast("long").alias("pairs"))


_DENSE = """o AS (SELECT ((o_orderkey * 7919) % 5003) / 2.0::DOUBLE x, ((o_orderkey * 104729) % 4999) / 2.0::DOUBLE y FROM orders)"""


@query(
    f"""WITH {_DENSE}, s AS (SELECT s_suppkey, ((s_suppkey * 7907) % 5003) / 2.0::DOUBLE x, ((s_suppkey * 6857) % 4999) / 2.0::DOUBLE y FROM supplier)
  SELECT s_suppkey, greatest(count(o.x), 1) AS pairs FROM s LEFT JOIN o ON (o.x - s.x) ** 2 + (o.y - s.y) ** 2 <= 1440000 GROUP BY 1"""
)
def pairs_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders on half a square mile around the suppliers: most pairs are within reach, few are ever compared."""
    orders = table(spark, sf_dir, "orders").selectExpr("(o_orderkey * 7919) % 5003 / 2D as x", "(o_orderkey * 104729) % 4999 / 2D as y")
    units = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "(s_suppkey * 7907) % 5003 / 2D as x", "(s_suppkey * 6857) % 4999 / 2D as y")
    return fam.pairs_within(units, orders, g.POINT_DIM, 1200.0, 1200.0).select("s_suppkey", F.col("pairs").cast("long").alias("pairs"))


@query(
    f"""WITH {_DENSE}, p AS (SELECT x, y, count(*) n FROM o GROUP BY 1, 2),
  q AS (SELECT ((c_custkey * 7919) % 4001)::DOUBLE a, ((c_custkey * 104729) % 3989)::DOUBLE b, 10 + c_custkey % 300 AS w FROM customer)
  SELECT x, y, greatest(count(a), 1) AS pairs, min(n) AS copies FROM p LEFT JOIN q
    ON greatest(a - x, x - a - w, 0) ** 2 + greatest(b - y, y - b - w, 0) ** 2 <= 640000 GROUP BY 1, 2"""
)
def pairs_dense_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares around crowded places, as parks around housing."""
    orders = table(spark, sf_dir, "orders").selectExpr("(o_orderkey * 7919) % 5003 / 2D as x", "(o_orderkey * 104729) % 4999 / 2D as y")
    squares = table(spark, sf_dir, "customer").selectExpr(
        f"{square_rings('(c_custkey * 7919) % 4001', '(c_custkey * 104729) % 3989', '10 + c_custkey % 300')} as rings"
    )
    counted = fam.pairs_within(orders, squares, g.POLYGON_DIM, 200.0, 800.0)
    return counted.groupBy("x", "y").agg(F.max("pairs").cast("long").alias("pairs"), F.count(F.lit(1)).alias("copies"))


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE}, {SUPPLIER_CTE},
  p AS (SELECT c_custkey, c.x, c.y, greatest(count(s_suppkey), 1) n FROM cust c LEFT JOIN supp s
    ON sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2) <= 9000 GROUP BY ALL)
  SELECT geography, geoid10, sum(n)::BIGINT AS pairs FROM p JOIN area ON {IN_AREA} GROUP BY ALL"""
)
def pair_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = customer_points(spark, sf_dir).select("feature_id", "x", "y")
    others = supplier_points(spark, sf_dir).select("feature_id", "x", "y")
    tiles = sp.area_tiles(areas(spark, sf_dir), CELL)
    return fam.pair_count(units, others, g.POINT_DIM, tiles, CELL, 9000.0)


@query(
    f"""WITH {NATION_CTE}, {SUPPLIER_CTE}
  SELECT geoid10, round(min(sqrt((x - x0 - 50000) ** 2 + (y - y0 - 50000) ** 2)) / 5280, 4) AS miles FROM nat, supp GROUP BY 1"""
)
def nearest_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = supplier_points(spark, sf_dir).select("x", "y")
    miles = fam.nearest_to_areas(nation_areas(spark, sf_dir), [(features, g.POINT_DIM)], 50000.0)
    return miles.select("geoid10", F.round("miles", 4).alias("miles"))


@query(
    f"""WITH {NATION_CTE}, {SUPPLIER_CTE},
  d AS (SELECT rk, geoid10, min(sqrt((x - x0 - 50000) ** 2 + (y - y0 - 50000) ** 2)) d FROM nat, supp GROUP BY ALL)
  SELECT 'R' || rk AS geoid10, round(sum(d) / count(geoid10) / 5280, 4) AS miles FROM d GROUP BY 1"""
)
def nearest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean nearest distance of the nations whose centroid lies in the region."""
    nations = nation_areas(spark, sf_dir)
    features = supplier_points(spark, sf_dir).select("x", "y")
    miles = fam.nearest_to_areas(nations, [(features, g.POINT_DIM)], 50000.0)
    tiles = sp.area_tiles(region_areas(spark, sf_dir), CELL)
    rolled = fam.roll_up(nations, miles, "miles", tiles, CELL)
    return rolled.select("geoid10", F.round("miles", 4).alias("miles"))


@query(
    f"""WITH {CUSTOMER_SHEET_CTE}, {SUPPLIER_SHEET_CTE}
  SELECT c_custkey, round(min(sqrt((c.x - s.x) ** 2 + (c.y - s.y) ** 2)), 3) AS dist FROM cust c, supp s GROUP BY 1"""
)
def nearest_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer with the distance to its nearest supplier."""
    points = customer_points(spark, sf_dir, sheet=True).select("c_custkey", "x", "y")
    features = supplier_points(spark, sf_dir, sheet=True).select("x", "y")
    dist = sp.nearest_distance(points, [(features, g.POINT_DIM)], 25000.0)
    return dist.select("c_custkey", F.round("dist", 3).alias("dist"))


@query(
    """WITH p AS (SELECT o_orderkey k, ((o_orderkey * 7919) % 1009) / 8.0::DOUBLE + (o_orderkey % 2) * 4e6 AS x, ((o_orderkey * 104729) % 997) / 8.0::DOUBLE AS y FROM orders),
  f AS (SELECT ((c_custkey * 7919) % 1009) / 8.0::DOUBLE + (c_custkey % 2) * 4e6 AS a, ((c_custkey * 6857) % 997) / 8.0::DOUBLE + (c_custkey % 2) * 3e5 AS b FROM customer)
  SELECT k AS o_orderkey, round(min(sqrt((x - a) ** 2 + (y - b) ** 2)), 3) AS dist FROM p, f GROUP BY 1"""
)
def nearest_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders in two crowds: one among its features, the other far from its own."""
    points = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "(o_orderkey * 7919) % 1009 / 8D + (o_orderkey % 2) * 4000000D as x", "(o_orderkey * 104729) % 997 / 8D as y"
    )
    features = table(spark, sf_dir, "customer").selectExpr(
        "(c_custkey * 7919) % 1009 / 8D + (c_custkey % 2) * 4000000D as x", "(c_custkey * 6857) % 997 / 8D + (c_custkey % 2) * 300000D as y"
    )
    dist = sp.nearest_distance(points, [(features, g.POINT_DIM)], 1000.0)
    return dist.select("o_orderkey", F.round("dist", 3).alias("dist"))


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE}, big AS (SELECT DISTINCT o_custkey FROM orders WHERE o_totalprice > 400000),
  p AS (SELECT c_custkey, x, y, CASE WHEN o_custkey IS NULL THEN 0 ELSE 1 END f FROM cust LEFT JOIN big ON o_custkey = c_custkey),
  near AS (SELECT DISTINCT geography, geoid10, c_custkey, f FROM p JOIN area
    ON sqrt(greatest(x0 - x, x - x0 - 100000, 0) ** 2 + greatest(y0 - y, y - y0 - 100000, 0) ** 2) <= 1000)
  SELECT geography, geoid10, sum(f)::BIGINT AS flag_yes, sum(1 - f)::BIGINT AS flag_no,
  round(100.0::DOUBLE * sum(f) / count(*), 2)::DOUBLE AS flag_pct FROM near GROUP BY ALL"""
)
def flag_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    big = table(spark, sf_dir, "orders").where("o_totalprice > 400000").select("o_custkey")
    points = customer_points(spark, sf_dir).select("feature_id", "c_custkey", "x", "y")
    flagged = fam.sidewalk_flags(points, big, "c_custkey", "o_custkey")
    share = fam.flag_share(flagged, g.POINT_DIM, areas(spark, sf_dir), CELL, 1000.0)
    return share.select(*sp.AREA_KEYS, "flag_yes", "flag_no", F.round("flag_pct", 2).alias("flag_pct"))


@query(
    f"""WITH {AREA_CTE}, {SUPPLIER_CTE} SELECT geography, geoid10, arg_min(s_acctbal, s_suppkey) AS value
  FROM supp JOIN area ON {IN_AREA} GROUP BY ALL"""
)
def pick_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = supplier_points(spark, sf_dir).select("feature_id", "s_acctbal", "x", "y")
    one = fam.pick_one(F.col("s_acctbal"), F.col("feature_id")).alias("value")
    return fam.per_area(points, g.POINT_DIM, sp.area_tiles(areas(spark, sf_dir), CELL), CELL, [one])


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE}, o AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2)) tot FROM orders GROUP BY 1)
  SELECT geography, geoid10, round(sum(tot)::DOUBLE / min(sqmi), 2) AS per_sqmi FROM cust JOIN o ON o_custkey = c_custkey
  JOIN area ON {IN_AREA} GROUP BY ALL"""
)
def preagg_spatial(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("stop_id"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount")
    )
    stops = customer_points(spark, sf_dir).select(F.col("feature_id").alias("stop_id"), "x", "y")
    summed = fam.summed_per_key(stops, orders, "stop_id", "amount", "tot")
    shapes = areas(spark, sf_dir)
    sums = fam.per_area(summed, g.POINT_DIM, sp.area_tiles(shapes, CELL), CELL, [F.sum("tot").cast("double").alias("s")])
    size = shapes.select("geography", "geoid10", (F.col("aland10") / 2589988.0).alias("sqmi"))
    return sums.join(size, sp.AREA_KEYS).select(*sp.AREA_KEYS, F.round(F.col("s") / F.col("sqmi"), 2).alias("per_sqmi"))


@query(
    f"""WITH {AREA_CTE}, {SUPPLIER_SHEET_CTE} SELECT s_suppkey FROM supp JOIN area ON {IN_AREA} AND geoid10 = 'R1'"""
)
def zips_in_metro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons whose centroid lies in one region."""
    shapes = supplier_diamonds(spark, sf_dir)
    tiles = sp.area_tiles(region_areas(spark, sf_dir), CELL)
    return sp.zips_within(shapes, tiles, CELL, "R1").select(F.col("zip").cast("long").alias("s_suppkey"))


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE} SELECT c_custkey, x, y FROM cust JOIN area ON {IN_AREA} AND geoid10 = 'R2'"""
)
def clip_to_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = region_areas(spark, sf_dir).where("geoid10 = 'R2'")
    points = customer_points(spark, sf_dir).select("c_custkey", "x", "y")
    return clip_points(points, sp.area_tiles(region, CELL), CELL)


def _survey_like(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Survey tables of one row per nation, counted from orders and customers.

    Five tables come from one aggregate, which is written once so that the orders are scanned once.
    """
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *[F.count_if(F.col("o_orderstatus") == s).alias(s) for s in "FOP"],
            *[F.count_if(F.substring("o_orderpriority", 1, 1) == str(i)).alias(f"p{i}") for i in range(1, 6)],
        )
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    columns = ["n", "F", "O", "P", *[f"p{i}" for i in range(1, 6)]]
    per = (
        customer.join(orders, F.col("c_custkey") == F.col("o_custkey"))
        .groupBy("c_nationkey")
        .agg(*[F.sum(c).cast("double").alias(c) for c in columns], F.count(F.lit(1)).cast("double").alias("people"))
        .selectExpr("lpad(cast(c_nationkey as string), 2, '0') as geoid", "'140' as sumlevel", "*")
    )
    per = materialise(per)

    def lines(names: dict[str, str]) -> DataFrame:
        return per.selectExpr("geoid", "sumlevel", *[f"`{v}` as {k}" for k, v in names.items()])

    return {
        "b01003": lines({"b01003001": "n"}),
        "b25001": lines({"b25001001": "people"}),
        "b25003": lines({"b25003001": "n", "b25003002": "F", "b25003003": "O"}),
        "b03003": lines({"b03003003": "P"}),
        "b02001": lines(
            {"b02001001": "n", **{f"b0200100{i + 1}": f"p{i}" for i in range(1, 6)}, "b02001007": "F", "b02001008": "O"}
        ),
    }


@query(
    f"""WITH {NATION_CTE}, {CUSTOMER_CTE}, {SUPPLIER_CTE},
  q AS (SELECT c_nationkey k, count(*)::DOUBLE n, count(DISTINCT c_custkey)::DOUBLE people,
    sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::DOUBLE f, sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END)::DOUBLE o,
    sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::DOUBLE p, sum(CASE WHEN left(o_orderpriority, 1) = '1' THEN 1 ELSE 0 END)::DOUBLE p1
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
  a AS (SELECT geoid10, count(*) n, sum(c_acctbal::DECIMAL(18,2))::DOUBLE units,
    sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END) electric FROM cust JOIN nat ON {IN_AREA} GROUP BY 1),
  d AS (SELECT geoid10, min(sqrt((x - x0 - 50000) ** 2 + (y - y0 - 50000) ** 2)) / 5280 d FROM nat, supp GROUP BY 1)
  SELECT nat.geoid10, n_name AS name10, 4 * (nat.k + 1)::DOUBLE AS sqmiland, q.n AS totpop, q.people AS hu,
  round(100 * p1 / q.n, 2) AS pct_wh, round(q.people / (4 * (nat.k + 1)), 2) AS hsng_density, round(100 * f / q.n, 2) AS pct_own,
  round(100 * o / q.n, 2) AS pct_rent, round(100 * p / q.n, 2) AS pct_hisp, a.n::DOUBLE AS foreclose,
  round(100 * units / q.people, 2) AS pct_afford, electric::DOUBLE AS elec_chg_station, round(d, 2) AS hosp_dist
  FROM nat LEFT JOIN q ON q.k = nat.k LEFT JOIN a USING (geoid10) LEFT JOIN d USING (geoid10)"""
)
def indicator_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue end to end: survey tables, point layers and a nearest layer to one wide row per area."""
    customers = customer_points(spark, sf_dir)
    layers = {
        "regis_foreclosures": customers.select("feature_id", "x", "y"),
        "hud_affordable_housing": customers.selectExpr(
            "feature_id", "cast(c_acctbal as decimal(18,2)) as total_units", "x", "y"
        ),
        "alternative_fuel_stations": customers.selectExpr(
            "feature_id", "if(c_mktsegment = 'BUILDING', 'Electric', 'CNG') as fuel", "x", "y"
        ),
        "hospitals": supplier_points(spark, sf_dir).select("feature_id", "x", "y"),
    }
    tracts = nation_areas(spark, sf_dir).withColumn("geography", F.lit("cen_tract_2010"))
    inputs = Inputs(
        areas=tracts,
        survey=_survey_like(spark, sf_dir),
        layers={name: Layer(df, g.POINT_DIM) for name, df in layers.items()},
    )
    params = Parameters(cell=CELL, fine_cell=CELL)
    wanted = (
        "tot_pop", "housing_units", "pct_race", "housing_density", "pct_own", "pct_rent", "hisp_pop", "foreclosure",
        "pct_afford_housing", "elec_station", "hospitals",
    )
    sources = SourceFrames(inputs, params, [i for i in catalogue(params) if i.name in wanted])
    summary = combine(tracts, sources.frames(), sources.indicators)
    shown = [
        "totpop", "hu", "pct_wh", "hsng_density", "pct_own", "pct_rent", "pct_hisp", "foreclose", "pct_afford",
        "elec_chg_station", "hosp_dist",
    ]
    return summary.select("geoid10", "name10", "sqmiland", *[F.col(c).cast("double").alias(c) for c in shown])


@query(
    f"""WITH {AREA_CTE}, {CUSTOMER_CTE} SELECT CASE geography WHEN 'nation' THEN 'cen_tract_2010' ELSE 'cen_county_2010' END AS geography,
  geoid10, count(c_custkey)::DOUBLE AS foreclose,
  sum(CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END)::DOUBLE AS elec_chg_station, 1 AS times
  FROM cust JOIN area ON {IN_AREA} GROUP BY ALL"""
)
def resume_by_geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year's run of one geography that goes on with the other; `times` counts how often the pair was computed."""
    nation, region = nation_areas(spark, sf_dir), region_areas(spark, sf_dir)
    shapes = nation.withColumn("geography", F.lit("cen_tract_2010")).unionByName(
        region.withColumn("geography", F.lit("cen_county_2010"))
    )
    customers = customer_points(spark, sf_dir)
    stations = customers.selectExpr("feature_id", "if(c_mktsegment = 'BUILDING', 'Electric', 'CNG') as fuel", "x", "y")
    layers = {"regis_foreclosures": customers.select("feature_id", "x", "y"), "alternative_fuel_stations": stations}
    inputs = Inputs(areas=shapes, layers={name: Layer(df, g.POINT_DIM) for name, df in layers.items()})
    params, root = Parameters(cell=CELL, fine_cell=CELL), new_path(spark, "run")
    run(inputs, root, "2018", params, geographies=["cen_county_2010"])
    summary = run(inputs, root, "2018", params, rerun=True)
    log = read_log(spark, f"{root}/year=2018", RUN_LOG, RUN_FIELDS).where("indicator = 'foreclosure'")
    times = log.groupBy("geography").agg(F.count(F.lit(1)).cast("int").alias("times"))
    shown = [F.col(c).cast("double").alias(c) for c in ("foreclose", "elec_chg_station")]
    return summary.join(times, "geography").where("foreclose is not null").select(*sp.AREA_KEYS, *shown, "times")
