"""The search over two quadtrees against plain Python, and how much of it is compared."""

import math
import random

import pytest
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.operators import nearest
from areastats.operators.spatial import nearest_distance


def gap(p, e):
    (x, y), (x1, y1, x2, y2) = p, e
    dx, dy = x2 - x1, y2 - y1
    t = max(0, min(1, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy))) if dx or dy else 0
    return math.hypot(x - x1 - t * dx, y - y1 - t * dy)


@pytest.mark.parametrize("few", [0, 10, 8192])
def test_mixed_layers_equal_plain_python(spark, few, monkeypatch):
    """Points, lines and polygons in two layers, long pieces, crowds, copies, and a far cluster."""
    monkeypatch.setattr(nearest, "FEW", few)
    monkeypatch.setattr(nearest, "DEEPEST", 4)
    rnd = random.Random(4)
    spots = [(i, rnd.choice("ab"), rnd.gauss(0, 10), rnd.gauss(0, 10)) for i in range(150)] + [(900, "a", 1e6, 1e6), (901, "b", 1e6, 1e6), (902, "c", 0.0, 0.0)]
    dots = [(rnd.choice("ab"), rnd.gauss(5, 3), rnd.gauss(5, 3)) for _ in range(40)] * 2 + [("a", 1e6 + 3, 1e6 + 4)]
    lines = [("b", [(rnd.uniform(-50, 50), rnd.uniform(-50, 50)) for _ in range(rnd.choice([2, 5]))]) for _ in range(8)]
    boxes = [("a", rnd.uniform(-30, 30), rnd.uniform(-30, 30), rnd.uniform(1, 9)) for _ in range(6)]
    shape = f"layer string, rings {g.RINGS_TYPE}"
    corner = [("a", [(0, False, [(x, y), (x + a, y), (x + a, y + a), (x, y + a)])]) for _, x, y, a in boxes]
    layers = [
        (spark.createDataFrame(dots, "layer string, x double, y double"), 0),
        (spark.createDataFrame([(k, [(0, False, pts)]) for k, pts in lines], shape), 1),
        (spark.createDataFrame(corner, shape), 2),
    ]
    pieces = {k: [(x, y, x, y) for d, x, y in dots if d == k] for k in "abc"}
    for k, pts in lines:
        pieces[k] += [(*p, *q) for p, q in zip(pts, pts[1:])]
    for k, x, y, a in boxes:
        pts = [(x, y), (x + a, y), (x + a, y + a), (x, y + a), (x, y)]
        pieces[k] += [(*p, *q) for p, q in zip(pts, pts[1:])]
    got = {r.id: r.dist for r in nearest_distance(spark.createDataFrame(spots, "id int, layer string, x double, y double"), layers, 7.0, ["layer"]).collect()}
    assert len(got) == len(spots)
    for i, k, x, y in spots:
        inside = k == "a" and any(a <= x <= a + s and b <= y <= b + s for _, a, b, s in boxes)
        want = 0 if inside else min((gap((x, y), e) for e in pieces[k]), default=None)
        assert got[i] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9))


def crowd(spark, n, x, size, seed):
    draw = "pmod(xxhash64(id, {0}), 1000003) / 1000003D * {1}"
    return spark.range(n).selectExpr(f"{x} + {draw.format(seed, size)} as x", f"{draw.format(seed + 1, size)} as y")


@pytest.mark.parametrize("away", [0.0, 1e6])
def test_crowds_are_not_paired(spark, away, monkeypatch):
    """4,000 places and 4,000 features, in one crowd or in two far ones: few of the 16 million pairs are compared."""
    monkeypatch.setattr(nearest, "FEW", 64)
    places, dots = crowd(spark, 4_000, 0.0, 1_000.0, 1), crowd(spark, 4_000, away, 1_000.0, 3)
    pieces = dots.selectExpr("x as x1", "y as y1", "x as x2", "y as y2")
    at, above, total = nearest._extent(places, pieces), None, 0
    for depth in range(nearest.DEEPEST + 1):
        pairs = nearest.cell_pairs(places, pieces, [], at, depth, above)
        total += pairs.where("few").agg(F.coalesce(F.sum(F.expr("pm * im")), F.lit(0))).first()[0]
        above = pairs.where("not few")
        if above.isEmpty():
            break
    assert 0 < total < 4_000 * 4_000 / 20
    found = nearest.nearest_pieces(places.distinct(), pieces.distinct(), [])
    check = places.alias("p").limit(20).crossJoin(dots.withColumnsRenamed({"x": "a", "y": "b"}))
    want = check.groupBy("x", "y").agg(F.min(F.expr("pow(x - a, 2) + pow(y - b, 2)")).alias("want"))
    assert want.join(found, ["x", "y"]).where("abs(sq - want) > 1e-6").count() == 0
    assert found.count() == places.distinct().count()


def test_far_pieces_in_a_row_are_told_apart(spark):
    """Features in one row far from a crowd: a cell of places keeps those opposite, not the row, and nothing is broadcast."""
    places = spark.range(1_600).selectExpr("id % 40 / 8D as x", "id div 40 / 8D as y")
    dots = spark.range(2_000).selectExpr("id % 1000 / 64D as x1", "3e5 + id div 1000 as y1", "id % 1000 / 64D as x2", "3e5 + id div 1000 as y2")
    at, above = (0.0, 0.0, 3.1e5), None
    for depth in range(10):
        pairs = nearest.cell_pairs(places, dots, [], at, depth, above)
        above = pairs.where("true")
    row = pairs.groupBy("pcx", "pcy").agg(F.sum("im").alias("n"))
    assert row.agg(F.max("n")).first()[0] < 400
    plan = nearest.nearest_pieces(places, dots, [])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
