"""Places in reach of lines and polygons by arrays of tiles against plain Python, and how much is compared for it."""

import random

import numpy as np
import pytest

from areastats.functions import geometry as g
from areastats.operators import counting, rims


def closed(points):
    return [(*p, *q) for p, q in zip(points, [*points[1:], points[0]], strict=True) if p != q]


def opened(points):
    return [(*p, *q) for p, q in zip(points, points[1:], strict=False) if p != q]


def square(x, y, a):
    return [(x, y), (x + a, y), (x + a, y + a), (x, y + a)]


def in_reach(x, y, pieces, solid, reach):
    odd = False
    for x1, y1, x2, y2 in pieces:
        dx, dy = x2 - x1, y2 - y1
        t = min(1.0, max(0.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy)))
        if (x - x1 - t * dx) ** 2 + (y - y1 - t * dy) ** 2 <= reach * reach:
            return True
        if (y1 > y) != (y2 > y):
            odd ^= x < x1 + (y - y1) * dx / dy
    return solid and odd


def by_rims(shapes, spots, solid, cell, reach):
    piece = np.array([e for pieces, _ in shapes for e in pieces], float).T.copy()
    size, weight = np.array([len(p) for p, _ in shapes]), np.array([w for _, w in shapes])
    x, y = np.array(spots, float).T.copy()
    n, rim = np.zeros(len(x), np.int64), []
    for up, whole, tiles in rims.cut(piece, size, weight, solid, cell, reach):
        at = {}
        for *key, w in zip(whole.cx.tolist(), whole.cy.tolist(), whole.weight.tolist(), strict=True):
            at[tuple(key)] = at.get(tuple(key), 0) + w
        n += [at.get(key, 0) for key in zip(*(np.floor(v / (cell * 2**up)).astype(int).tolist() for v in (x, y)), strict=True)]
        rim.append(tiles)
    cx, cy = (np.floor(v / cell).astype(np.int64) for v in (x, y))
    return (n + rims.counted(x, y, cx, cy, rims.joined(rim), cell, reach)).tolist()


@pytest.mark.parametrize("cell", [1.5, 4.0, 60.0])
@pytest.mark.parametrize("reach", [0.0, 0.5, 5.0, 40.0])
@pytest.mark.parametrize("at_once", [7, 1 << 17])
def test_shapes_equal_plain_python(cell, reach, at_once, monkeypatch):
    """Concave shapes, holes, parts, lines and copies, with places on edges, corners and exactly as far away as the reach."""
    monkeypatch.setattr(rims, "PLAIN", 1)
    monkeypatch.setattr(rims, "PAIRS", 0)
    monkeypatch.setattr(rims, "AT_ONCE", at_once)
    rnd = random.Random(7)
    number = lambda: rnd.randint(-24, 24) / 2
    spots = [(rnd.randint(-60, 60) / 4, rnd.randint(-60, 60) / 4) for _ in range(250)] + [(1e6, -3e5)]
    some = [square(number(), number(), rnd.randint(1, 6)) for _ in range(25)]
    rings = [closed(points) for points in some] + [closed([(number(), number()) for _ in range(3)]) for _ in range(10)]
    rings += [closed(square(-9, -9, 18)) + closed(square(-6, -6, 11)), closed(square(0, 0, 2)) + closed(square(9, 9, 2)), rings[0]]
    rings += [closed([(0, 0), (8, 0), (8, 8), (6, 8), (6, 2), (2, 2), (2, 8), (0, 8)])]
    lines = [opened([(number(), number()) for _ in range(rnd.randint(2, 6))]) for _ in range(30)]
    for solid, shapes in ((True, rings), (False, lines)):
        weighted = [(pieces, rnd.randint(1, 3)) for pieces in shapes if pieces]
        want = [sum(w for pieces, w in weighted if in_reach(x, y, pieces, solid, reach)) for x, y in spots]
        assert by_rims(weighted, spots, solid, cell, reach) == want


@pytest.mark.parametrize("reach", [3.0, 30.0])
def test_sectors_compare_as_two_points_are(reach):
    """Any places, and points whose rims cross their cell, many within rounding."""
    rnd = np.random.default_rng(3)
    x, y = 50 + rnd.random(200), 70 + rnd.random(200)
    turn, off = rnd.random(3_000) * 7, np.where(np.arange(3_000) % 2, 0.0, rnd.random(3_000) - 0.5)
    at = rnd.integers(0, 200, 3_000)
    a, b = x[at] + (reach + off) * np.cos(turn), y[at] + (reach + off) * np.sin(turn)
    weight = rnd.integers(1, 9, 3_000)
    n, used = rims.by_sectors(x, y, np.stack([a, b, a, b]), weight, 50.5, 70.5, 1.0, reach)
    assert len(used) == 3_000
    assert (n == (((x[:, None] - a) ** 2 + (y[:, None] - b) ** 2 <= reach * reach) * weight).sum(axis=1)).all()


def test_crowds_are_not_compared_with_their_rims(monkeypatch):
    """20,000 places in a cell that the rims of 5,000 squares cross: far fewer comparisons than places times squares."""
    asked, made = [], rims.ranges
    monkeypatch.setattr(rims, "ranges", lambda starts, sizes: asked.append(int(sizes.sum())) or made(starts, sizes))
    rnd = random.Random(9)
    squares = [(closed(square(rnd.uniform(-95, 100), rnd.uniform(-95, 100), rnd.uniform(1, 5))), 1) for _ in range(5_000)]
    spots = [(rnd.uniform(0, 10), rnd.uniform(0, 10)) for _ in range(20_000)]
    n = by_rims(squares, spots, True, 10.0, 90.0)
    assert sum(asked) < 20_000 * 5_000 / 10
    for at in range(0, 20_000, 2_000):
        assert n[at] == sum(in_reach(*spots[at], pieces, True, 90.0) for pieces, _ in squares)


@pytest.mark.parametrize("tiles", [1 << 18, 20])
def test_crowded_rim_cells_are_one_group(spark, tiles, monkeypatch):
    """Cells of hundreds of places on the rims of squares are not split by Spark; groups may share the tiles of a cell. Weights of 0
    make rows."""
    monkeypatch.setattr(counting, "TILES", tiles)
    rnd = random.Random(8)
    spots = list({(rnd.randint(0, 160) / 4, rnd.randint(0, 160) / 4) for _ in range(3_000)}) + [(1_000.0, 1_000.0)]
    squares = [(rnd.randint(1, 3), rnd.randint(-30, 60), rnd.randint(-30, 60), rnd.randint(1, 9)) for _ in range(80)] + [(0, 990, 990, 9)]
    left = spark.createDataFrame(spots, "x double, y double")
    rows = [(w, [(0, False, [(float(a), float(b)) for a, b in square(x, y, s)])]) for w, x, y, s in squares]
    right = spark.createDataFrame(rows, f"weight long, rings {g.RINGS_TYPE}")
    parts = counting.shape_counts(left, right, g.POLYGON_DIM, 20.0, 12.0)
    assert len(parts) == 2
    got = parts[0].unionByName(parts[1]).groupBy("x", "y").sum("n").collect()
    want = {}
    for x, y in spots:
        near = [w for w, a, b, s in squares if max(a - x, x - a - s, 0) ** 2 + max(b - y, y - b - s, 0) ** 2 <= 144]
        if near:
            want[x, y] = sum(near)
    assert {tuple(r)[:2]: tuple(r)[2] for r in got} == want and want[1_000.0, 1_000.0] == 0
