import math
import random

import pytest
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.functions.projection import project_rings, to_state_plane
from areastats.operators.clean import clip_lines
from areastats.operators import families as fam
from areastats.operators import spatial as sp
from areastats.operators.tiles import tile

CELLS = [1.0, 3.0, 100.0]


def square(x, y, s):
    return [(x, y), (x + s, y), (x + s, y + s), (x, y + s)]


@pytest.fixture(scope="module")
def shapes(spark):
    rows = [
        ("county", "A", [(0, False, square(0.0, 0.0, 10.0)), (0, True, square(4.0, 4.0, 2.0))]),
        ("county", "B", [(0, False, square(10.0, 0.0, 10.0))]),
        ("tract", "D", [(0, False, [(5.0, 0.0), (10.0, 5.0), (5.0, 10.0), (0.0, 5.0)])]),
        ("tract", "M", [(0, False, square(30.0, 0.0, 2.0)), (1, False, square(-8.0, -8.0, 3.0))]),
    ]
    return spark.createDataFrame(rows, f"geography string, geoid10 string, rings {g.RINGS_TYPE}").cache()


@pytest.fixture(scope="module")
def lattice(spark):
    return spark.sql("select id, id % 41 * 0.5D as x, (id div 41) * 0.5D as y from range(1681)").cache()


def place(i):
    return i % 41 * 0.5, i // 41 * 0.5


def inside(k, x, y, edge):
    lt = (lambda a, b: a <= b) if edge else (lambda a, b: a < b)
    hole = (4 < x < 6 and 4 < y < 6) if edge else (4 <= x <= 6 and 4 <= y <= 6)
    return {
        "A": lt(0, x) and lt(x, 10) and lt(0, y) and lt(y, 10) and not hole,
        "B": lt(10, x) and lt(x, 20) and lt(0, y) and lt(y, 10),
        "D": lt(abs(x - 5) + abs(y - 5), 5),
        "M": False,
    }[k]


@pytest.mark.parametrize("cell", CELLS)
@pytest.mark.parametrize("edge", [False, True])
def test_within_and_boundary(shapes, lattice, cell, edge):
    found = sp.within(lattice, sp.area_tiles(shapes, cell), cell, boundary=edge)
    got = {(r.id, r.geoid10) for r in found.collect()}
    assert got == {(i, k) for i in range(1681) for k in "ABDM" if inside(k, *place(i), edge)}
    assert found.count() == len(got)


def test_centroids(spark, shapes):
    got = {r.geoid10: (r.x, r.y) for r in g.with_centroid(shapes, 2).collect()}
    # M: two squares of area 4 at (31, 1) and area 9 at (-6.5, -6.5).
    want_m = ((4 * 31 + 9 * -6.5) / 13, (4 * 1 + 9 * -6.5) / 13)
    assert got["A"] == pytest.approx((5, 5)) and got["D"] == pytest.approx((5, 5)) and got["M"] == pytest.approx(want_m)
    off_hole = [(0, False, square(0.0, 0.0, 4.0)[::-1]), (0, True, square(0.0, 0.0, 2.0))]
    flat = [(0, False, [(0.0, 0.0), (4.0, 0.0), (0.0, 0.0)])]
    dot = [(0, False, [(3.0, 7.0), (3.0, 7.0)])]
    df = spark.createDataFrame([("hole", off_hole), ("flat", flat), ("dot", dot)], f"k string, rings {g.RINGS_TYPE}")
    got = {r.k: (r.x, r.y) for r in g.with_centroid(df, 2).collect()}
    assert got["hole"] == pytest.approx(((16 * 2 - 4 * 1) / 12,) * 2)
    assert got["flat"] == pytest.approx((2, 0)) and got["dot"] == pytest.approx((3, 7))


def test_centroid_keeps_precision_far_from_origin(spark):
    rings = [(0, False, square(1.0e6 + 0.25, 2.0e6 + 0.25, 0.5))]
    df = spark.createDataFrame([(rings,)], f"rings {g.RINGS_TYPE}")
    assert [*g.with_centroid(df, 2).first()] == pytest.approx([1000000.5, 2000000.5], abs=1e-9)


def gap(k, x, y):
    if k == "A" and 4 < x < 6 and 4 < y < 6:
        return min(x - 4, 6 - x, y - 4, 6 - y)
    x0 = {"A": 0, "B": 10}[k]
    return math.hypot(max(0, x0 - x, x - x0 - 10), max(0, -y, y - 10))


@pytest.mark.parametrize("cell", CELLS)
def test_points_within_distance(shapes, lattice, cell):
    found = sp.near_pairs(lattice, 0, shapes.where("geoid10 in ('A', 'B')"), 2, cell, 1.0)
    got = {(r.id, r.geoid10) for r in found.collect()}
    assert got == {(i, k) for i in range(1681) for k in "AB" if gap(k, *place(i)) <= 1}


@pytest.mark.parametrize("cell", [2.0, 50.0])
@pytest.mark.parametrize("reach", [0.0, 0.75])
def test_polygon_pairs(spark, cell, reach):
    rnd = random.Random(3)
    boxes = [(float(rnd.randint(0, 30)), float(rnd.randint(0, 30)), float(rnd.randint(1, 9))) for _ in range(40)]
    rows = [(i, [(0, False, square(*b))]) for i, b in enumerate(boxes)]
    left = spark.createDataFrame(rows[:20], f"l int, rings {g.RINGS_TYPE}")
    right = spark.createDataFrame(rows[20:], f"r int, rings {g.RINGS_TYPE}")
    got = {(p.l, p.r) for p in sp.near_pairs(left, 2, right, 2, cell, reach).collect()}

    def apart(a, b):
        dx = max(a[0] - b[0] - b[2], b[0] - a[0] - a[2], 0)
        dy = max(a[1] - b[1] - b[2], b[1] - a[1] - a[2], 0)
        return math.hypot(dx, dy)

    assert got == {(i, j) for i in range(20) for j in range(20, 40) if apart(boxes[i], boxes[j]) <= reach}


def test_polygon_inside_hole_does_not_intersect(spark, shapes):
    small = spark.createDataFrame([(1, [(0, False, square(4.5, 4.5, 1.0))])], f"f int, rings {g.RINGS_TYPE}")
    got = {r.geoid10 for r in sp.near_pairs(small, 2, shapes, 2, 3.0).collect()}
    assert got == {"D"}


LINES = [
    (1, [(0, False, [(-5.0, 2.0), (15.0, 2.0)])]),
    (2, [(0, False, [(10.0, -5.0), (10.0, 25.0)])]),
    (3, [(0, False, [(-3.0, 5.0), (5.0, 5.0), (5.0, 30.0)])]),
    (4, [(0, False, [(20.3, 1.0), (20.3, 9.0)])]),
]


@pytest.mark.parametrize("cell", CELLS)
def test_clipped_length(spark, shapes, cell):
    lines = spark.createDataFrame(LINES, f"lid int, rings {g.RINGS_TYPE}")
    plain = {(r.lid, r.geoid10): r.length for r in sp.clipped_length(lines, shapes, cell, 0.0).collect()}
    assert plain == pytest.approx(
        {(1, "A"): 10, (1, "B"): 5, (1, "D"): 4, (2, "A"): 10, (2, "B"): 10, (3, "A"): 8, (3, "D"): 10}
    )
    wide = {(r.lid, r.geoid10): r.length for r in sp.clipped_length(lines, shapes, cell, 0.5).collect()}
    # A shared border counts on both sides; line 4 lies within the buffer of B but does not meet it.
    assert wide[(2, "A")] == pytest.approx(11) and wide[(2, "B")] == pytest.approx(11)
    assert wide[(1, "B")] == pytest.approx(5.5) and wide[(3, "A")] == pytest.approx(10) and (4, "B") not in wide


@pytest.mark.parametrize("cell", CELLS)
def test_clipped_geometry(spark, shapes, cell):
    def line(*parts):
        return [(n, False, pts) for n, pts in enumerate(parts)]

    rows = [
        (1, line([(-5.0, 5.0), (15.0, 5.0)])),  # through A's hole into B
        (2, line([(1.0, 1.0), (2.0, 1.0), (2.0, 3.0)], [(7.0, 8.0), (9.0, 8.0)])),  # inside A, two parts
        (3, line([(-3.0, 20.0), (40.0, 20.0)])),  # beside all
        (4, line([(8.0, 9.0), (12.0, 9.0), (12.0, 1.0), (8.0, 1.0)])),  # leaves A and comes back
        (5, line([(3.0, 3.0), (3.0, 3.0)])),
        (6, None),
    ]
    lines = spark.createDataFrame(rows, f"feature_id int, rings {g.RINGS_TYPE}")
    got = {
        (r.feature_id, r.geoid10): [[(round(v.x, 9), round(v.y, 9)) for v in p.pts] for p in r.rings]
        for r in sp.clip_lines(lines, shapes, cell).collect()
    }
    want = {
        (1, "A"): [[(0, 5), (4, 5)], [(6, 5), (10, 5)]],
        (1, "B"): [[(10, 5), (15, 5)]],
        (1, "D"): [[(0, 5), (10, 5)]],
        (2, "A"): [[(1, 1), (2, 1), (2, 3)], [(7, 8), (9, 8)]],
        (4, "A"): [[(8, 9), (10, 9)], [(10, 1), (8, 1)]],
        (4, "B"): [[(10, 9), (12, 9), (12, 1), (10, 1)]],
    }
    assert {k: v for k, v in got.items() if k[1] != "D" or k[0] == 1} == want


@pytest.mark.parametrize("cell", CELLS)
def test_clipped_geometry_has_the_clipped_length(spark, shapes, cell):
    rnd = random.Random(3)
    rows = []
    for i in range(40):
        pts = [(rnd.uniform(-10, 35), rnd.uniform(-10, 12)) for _ in range(rnd.randint(2, 6))]
        rows.append((i, [(0, False, pts)]))
    lines = spark.createDataFrame(rows, f"feature_id int, rings {g.RINGS_TYPE}")
    want = {(r.feature_id, r.geoid10): r.length for r in sp.clipped_length(lines, shapes, cell, 0.0).collect()}
    got = {}
    for r in sp.clip_lines(lines, shapes, cell).collect():
        got[r.feature_id, r.geoid10] = sum(math.dist(a, b) for p in r.rings for a, b in zip(p.pts, p.pts[1:]))
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-9) for k in want)


def test_projected_vertices_are_projected_points(spark):
    pts = [(-90.05, 35.15), (-89.9, 35.2), (-89.8, 35.0)]
    df = spark.createDataFrame([(1, [(0, False, pts), (0, True, pts[:2])])], f"id int, rings {g.RINGS_TYPE}")
    got = df.select(project_rings(F.col("rings")).alias("rings")).first().rings
    spots = spark.createDataFrame(pts, "lon double, lat double")
    want = [tuple(r) for r in spots.select(*to_state_plane(F.col("lon"), F.col("lat"))).collect()]
    assert [tuple(v) for v in got[0].pts] == want and [tuple(v) for v in got[1].pts] == want[:2]
    assert [r.hole for r in got] == [False, True]


def test_partition_lengths_add_up(spark):
    rnd = random.Random(5)
    cells = [("g", f"{i}-{j}", [(0, False, square(i * 10.0, j * 10.0, 10.0))]) for i in range(4) for j in range(4)]
    areas = spark.createDataFrame(cells, f"geography string, geoid10 string, rings {g.RINGS_TYPE}")
    paths = [[(rnd.uniform(0, 40), rnd.uniform(0, 40)) for _ in range(4)] for _ in range(25)]
    lines = spark.createDataFrame([(i, [(0, False, p)]) for i, p in enumerate(paths)], f"lid int, rings {g.RINGS_TYPE}")
    got = {r.lid: r.s for r in sp.clipped_length(lines, areas, 7.0, 0.0).groupBy("lid").agg(F.sum("length").alias("s")).collect()}
    want = {i: sum(math.dist(a, b) for a, b in zip(p, p[1:])) for i, p in enumerate(paths)}
    assert got == pytest.approx(want)


@pytest.mark.parametrize("cell", [0.5, 40.0])
def test_nearest_distance(shapes, lattice, cell):
    dist = sp.nearest_distance(lattice, [(shapes.where("geoid10 = 'B'"), 2)], cell)
    got = {r.id: r.dist for r in dist.collect()}
    assert got == pytest.approx({i: gap("B", *place(i)) for i in range(1681)})


def test_nearest_by_layer_with_lonely_and_empty_layers(spark):
    rnd = random.Random(9)
    spots = {"near": [(rnd.uniform(0, 99), rnd.uniform(0, 99)) for _ in range(30)], "far": [(90000.0, -40000.0)]}
    rows = [(k, x, y) for k, v in spots.items() for x, y in v] + [("empty", None, None)]
    features = spark.createDataFrame(rows, "layer string, x double, y double")
    at = [(rnd.uniform(0, 99), rnd.uniform(0, 99)) for _ in range(20)]
    points = spark.createDataFrame([(i, k, x, y) for i, (x, y) in enumerate(at) for k in ("near", "far", "empty")], "i int, layer string, x double, y double")
    got = {(r.i, r.layer): r.dist for r in sp.nearest_distance(points, [(features, 0)], 5.0, ["layer"]).collect()}
    assert len(got) == 60 and all(got[(i, "empty")] is None for i in range(20))
    for i, p in enumerate(at):
        for k in ("near", "far"):
            assert got[(i, k)] == pytest.approx(min(math.dist(p, s) for s in spots[k]))


def test_input_order_does_not_matter(spark, shapes, lattice):
    tiles = sp.area_tiles(shapes, 3.0)
    one = fam.pick_one(F.col("id") * 10, F.col("id")).alias("v")
    runs = [
        sorted(map(tuple, fam.per_area(df, 0, tiles, 3.0, [one]).collect()))
        for df in (lattice, lattice.repartition(7, "y"), lattice.orderBy(F.desc("id")))
    ]
    assert runs[0] == runs[1] == runs[2]


def test_rings_from_vertices(spark):
    rows = [("f", part, ring, seq, x, y) for part, ring, s in [(0, 0, square(0.0, 0.0, 4.0)), (0, 1, square(1.0, 1.0, 1.0))] for seq, (x, y) in enumerate(s)]
    random.Random(1).shuffle(rows)
    vertex = spark.createDataFrame(rows, "k string, part int, ring int, seq int, x double, y double")
    got = g.rings_from_vertices(vertex, ["k"]).first().rings
    assert [(r.part, r.hole, [tuple(p) for p in r.pts]) for r in got] == [
        (0, False, square(0.0, 0.0, 4.0)),
        (0, True, square(1.0, 1.0, 1.0)),
    ]


def test_crowded_cell_is_split(spark):
    """Two thirds of the points in one cell: adaptive execution splits that partition, and the counts stay whole."""
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        cells = [("g", f"{i}-{j}", [(0, False, square(i * 10.0, j * 10.0, 10.0))]) for i in range(9) for j in range(9)]
        areas = spark.createDataFrame(cells, f"geography string, geoid10 string, rings {g.RINGS_TYPE}")
        points = spark.range(60000, numPartitions=8).selectExpr(
            "id", "if(id % 3 > 0, 5D + id % 100 / 50D, (id * 7919) % 9000 / 100D + 0.005D) as x",
            "if(id % 3 > 0, 5D, (id * 104729) % 9000 / 100D + 0.005D) as y",
        )
        found = sp.within(points, sp.area_tiles(areas, 10.0), 10.0).groupBy("geoid10").agg(F.count("*").alias("n"))
        got = {r.geoid10: r.n for r in found.collect()}
        assert sum(got.values()) == 60000 and got["0-0"] >= 40000
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_tiles_cover_each_shape_once_per_cell(shapes):
    tiles = tile(shapes, 2, 3.0)
    assert tiles.count() == tiles.select("geography", "geoid10", "cx", "cy").distinct().count()


def test_nearest_ends_without_usable_places(spark):
    nan = float("nan")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, nan, 0.0), (3, None, 1.0)], "i int, x double, y double")
    features = spark.createDataFrame([(5.0, 0.0), (nan, 0.0)], "x double, y double")
    got = {r.i: r.dist for r in sp.nearest_distance(points, [(features, 0)], 1.0).collect()}
    assert got == {1: 5.0, 2: None, 3: None}
    only = spark.createDataFrame([(nan, nan)], "x double, y double")
    assert {r.dist for r in sp.nearest_distance(points, [(only, 0)], 1.0).collect()} == {None}


def test_clipped_layer_keeps_its_attributes(spark, shapes):
    rows = [(1, "road", [(0, False, [(-5.0, 2.0), (5.0, 2.0)])]), (2, "far", [(0, False, [(90.0, 90.0), (91.0, 90.0)])])]
    lines = spark.createDataFrame(rows, f"feature_id int, name string, rings {g.RINGS_TYPE}")
    found = clip_lines(lines, shapes.where("geoid10 = 'A'"), 3.0).collect()
    assert [(r.feature_id, r.name, [tuple(v) for v in r.rings[0].pts]) for r in found] == [(1, "road", [(0.0, 2.0), (5.0, 2.0)])]


def test_layers_of_any_size_are_dealt_and_not_broadcast(spark):
    """A small file of polygons makes many tiles: they are made in many tasks, and `many` keeps them out of the driver."""
    ring = "array(named_struct('part', 0, 'hole', false, 'pts', array(named_struct('x', id * 1D, 'y', 0D), named_struct('x', id + 9D, 'y', 0D), named_struct('x', id + 9D, 'y', 9D))))"
    shapes = spark.range(20).coalesce(1).selectExpr("'g' as geography", "string(id) as geoid10", f"{ring} as rings")
    tiles = sp.area_tiles(shapes, 2.0)
    assert tiles.rdd.getNumPartitions() > 1
    points = spark.range(20).selectExpr("id + 5.5D as x", "1.25D as y")
    few, many = (sp.within(points, tiles, 2.0, many=m) for m in (False, True))
    assert "Broadcast" not in many._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) != []
