"""Counting within reach against plain Python, and how many points are compared for it."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.operators import counting


def counted(spark, spots, others, dim, cell, reach):
    left = spark.createDataFrame(spots, "x double, y double")
    shape = "x double, y double" if dim == g.POINT_DIM else f"rings {g.RINGS_TYPE}"
    right = spark.createDataFrame(others, f"weight long, {shape}")
    rows = counting.counts_within(left, right, dim, cell, reach).collect()
    assert len({(r.x, r.y) for r in rows}) == len(rows)
    return {(r.x, r.y): r.n for r in rows}


def plain(spots, others, reach):
    want = {}
    for x, y in set(spots):
        n = sum(w for w, a, b in others if (x - a) ** 2 + (y - b) ** 2 <= reach * reach)
        if n:
            want[x, y] = n
    return want


@pytest.mark.parametrize("reach", [0.0, 1.0, 7.5, 400.0])
@pytest.mark.parametrize("few", [0, 4, 64])
def test_points_equal_plain_python(spark, reach, few, monkeypatch):
    """Lattice points with many distances of exactly the reach, copies, a far cluster and negative places."""
    monkeypatch.setattr(counting, "FEW", few)
    monkeypatch.setattr(counting, "DEEPEST", 5)
    rnd = random.Random(1)
    spots = [(rnd.randint(-12, 12) / 2, rnd.randint(-12, 12) / 2) for _ in range(150)] + [(300.25, -100.5), (1e7, 1e7)]
    others = [(rnd.randint(1, 3), rnd.randint(-12, 12) / 2, rnd.randint(-12, 12) / 2) for _ in range(150)] + [(5, 300.25, -100.5)] * 2
    assert counted(spark, spots, others, g.POINT_DIM, 3.0, reach) == plain(spots, others, reach)


def test_unusable_places_and_empty_sides(spark):
    nan, inf = math.nan, math.inf
    spots = [(0.0, 0.0), (nan, 0.0), (inf, 1.0), (None, 2.0)]
    assert counted(spark, spots, [(1, 0.5, 0.0), (1, nan, 0.0), (1, None, 0.0)], 0, 1.0, 1.0) == {(0.0, 0.0): 1}
    assert counted(spark, [], [(1, 0.5, 0.0)], 0, 1.0, 1.0) == {}
    assert counted(spark, spots[:1], [], 0, 1.0, 1.0) == {}
    assert counted(spark, spots[:1], [], 2, 1.0, 1.0) == {}


def box(x, y, a):
    return [(0, False, [(x, y), (x + a, y), (x + a, y + a), (x, y + a)])]


@pytest.mark.parametrize("cell", [1.0, 4.0, 50.0])
@pytest.mark.parametrize("reach", [0.0, 3.0])
def test_shapes_equal_plain_python(spark, cell, reach):
    rnd = random.Random(2)
    spots = [(rnd.randint(-40, 80) / 4, rnd.randint(-40, 80) / 4) for _ in range(300)]
    boxes = [(rnd.randint(0, 9), rnd.randint(0, 9), rnd.randint(1, 5)) for _ in range(30)]
    got = counted(spark, spots, [(1, box(float(x), float(y), float(a))) for x, y, a in boxes], g.POLYGON_DIM, cell, reach)
    want = {}
    for x, y in set(spots):
        n = sum(math.hypot(max(a - x, x - a - s, 0), max(b - y, y - b - s, 0)) <= reach for a, b, s in boxes)
        if n:
            want[x, y] = n
    assert got == want


def test_crowds_are_not_paired(spark, monkeypatch):
    """Two crowds of 4,000 within reach of each other are counted by cells; across the rim far fewer than n * m meet."""
    monkeypatch.setattr(counting, "FEW", 64)

    def crowd(x, size):
        return spark.range(4_000).selectExpr(f"{x} + pmod(xxhash64(id, 1), 1000003) / 1000003D * {size} as x", f"pmod(xxhash64(id, 2), 1000003) / 1000003D * {size} as y", "1L as weight")

    def compared(left, right, reach):
        above, width, total = None, reach * (1 + 1e-9), 0
        while above is None or not above.isEmpty():
            pairs = counting.cell_pairs(left, right, width, reach, above)
            total += pairs.where("state = 'few'").agg(F.coalesce(F.sum(F.expr("l_m * r_m")), F.lit(0))).first()[0]
            above, width = pairs.where("state = 'rim'"), width / 2
        return total

    assert compared(crowd(0, 10.0), crowd(50, 10.0), 100.0) == 0
    assert compared(crowd(0, 100.0), crowd(50, 100.0), 100.0) < 4_000 * 4_000 / 8


def test_pairs_are_not_shuffled(spark):
    """The only shuffles behind the comparison are by place."""
    left = spark.range(100).selectExpr("double(id) as x", "double(id) as y")
    right = left.withColumn("weight", F.lit(1).cast("long"))
    plan = counting.counts_within(left, right, g.POINT_DIM, 3.0, 3.0)._jdf.queryExecution().executedPlan().toString()
    grouped = re.findall(r"Aggregate\(keys?=\[([^\]]*)\]", plan)
    assert grouped and not any("_x#" in keys for keys in grouped)


@pytest.mark.parametrize("reach", [0.0, 3.0])
def test_split_rim_tiles_equal_plain_python(spark, reach, monkeypatch):
    """Crowded places: tiles on the rim are split several times, and nothing is broadcast."""
    monkeypatch.setattr(counting, "FEW_SPOTS", 1)
    monkeypatch.setattr(counting, "DEEPEST", 6)
    rnd = random.Random(5)
    spots = [(rnd.randint(-40, 40) / 4, rnd.randint(-40, 40) / 4) for _ in range(400)]
    squares = [(rnd.randint(1, 3), rnd.randint(-20, 16) / 2, rnd.randint(-20, 16) / 2, rnd.randint(1, 6)) for _ in range(30)]
    want = {}
    for x, y in set(spots):
        n = sum(w for w, a, b, s in squares if max(a - x, x - a - s, 0) ** 2 + max(b - y, y - b - s, 0) ** 2 <= reach * reach)
        if n:
            want[x, y] = n
    assert counted(spark, spots, [(w, box(a, b, s)) for w, a, b, s in squares], g.POLYGON_DIM, 4.0, reach) == want
    left = spark.createDataFrame(spots, "x double, y double")
    right = spark.createDataFrame([(w, box(a, b, s)) for w, a, b, s in squares], f"weight long, rings {g.RINGS_TYPE}")
    parts = counting.shape_counts(left.distinct(), right, g.POLYGON_DIM, 4.0, reach)
    assert len(parts) > 4 and not any("Broadcast" in p._jdf.queryExecution().executedPlan().toString() for p in parts)


@pytest.mark.parametrize("reach", [0.0, 1.0, 7.5, 400.0])
@pytest.mark.parametrize("many", [0, 3, 40])
def test_strips_equal_plain_python(spark, reach, many, monkeypatch):
    """Rim cells with few features are cut into strips, others split; with many distances of exactly the reach."""
    monkeypatch.setattr(counting, "FEW", 2)
    monkeypatch.setattr(counting, "MANY", many)
    monkeypatch.setattr(counting, "PLACES", 7)
    monkeypatch.setattr(counting, "AT_ONCE", 5)
    monkeypatch.setattr(counting, "DEEPEST", 5)
    rnd = random.Random(3)
    spots = [(rnd.randint(-12, 12) / 2, rnd.randint(-12, 12) / 2) for _ in range(150)] + [(300.25, -100.5), (1e7, 1e7)]
    others = [(rnd.randint(1, 3), rnd.randint(-12, 12) / 2, rnd.randint(-12, 12) / 2) for _ in range(150)] + [(5, 300.25, -100.5)] * 2
    assert counted(spark, spots, others, g.POINT_DIM, 3.0, reach) == plain(spots, others, reach)


@pytest.mark.parametrize("reach", [0.0, 0.1, 0.7, 5.0])
def test_by_strips_compares_as_two_points_are(reach):
    """Any places, with features on the rim within rounding."""
    rnd = np.random.default_rng(4)
    x, y, a, b = (rnd.random(n) + 1e6 for n in (60, 60, 900, 900))
    turn = rnd.random(300) * 7
    a[:300], b[:300] = x[:60].repeat(5) + reach * np.cos(turn), y[:60].repeat(5) + reach * np.sin(turn)
    weight = rnd.integers(1, 9, 900)
    near = (x[:, None] - a) ** 2 + (y[:, None] - b) ** 2 <= reach * reach
    n, hits = counting.by_strips(x, y, a, b, weight, reach)
    assert (n == (near * weight).sum(axis=1)).all() and (hits == near.sum(axis=1)).all()


def test_rim_cells_are_not_split_without_end(spark, monkeypatch):
    """Crowds across the rim: cells of a bounded number of features end at once, whatever the number of pairs."""
    widths, made = [], counting.cell_pairs
    monkeypatch.setattr(counting, "cell_pairs", lambda *a: widths.append(a[2]) or made(*a))
    rnd = random.Random(6)
    spots = list({(rnd.random() * 100, rnd.random() * 100) for _ in range(1_000)})
    others = [(1, rnd.random() * 100, rnd.random() * 100) for _ in range(1_000)]
    assert counted(spark, spots, others, g.POINT_DIM, 90.0, 90.0) == plain(spots, others, 90.0)
    assert len(widths) == 1
