"""Distance from each place to its nearest feature by a search over two quadtrees at once.

Features are taken apart into straight pieces once. Places and pieces lie in cells, which are split into sixteen from width
to width; a cell knows its number of rows and the box around them. A cell of places keeps those cells of pieces whose box
may be nearer than the farthest that the best of them can be; all others are out for all its places. It also knows one
piece close to it, its guide, and drops the cells of pieces that are farther than the guide from each of its places. What
is left is split again, and pairs of cells with few rows are compared piece by piece. Crowds and far clusters thus cost no
more than their rims, however uneven the spacing, and the result is exact.

Coordinates on a lattice take few bytes in a file and many in memory, so no join here may broadcast by file size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from areastats.functions import geometry as g
from areastats.functions.geometry import num
from areastats.session import materialise

#: Pairs of cells with no more pairs of rows than this are compared.
FEW = 8192
#: A width is a quarter of the one before; after so many, what is left lies together within rounding.
SPLIT, DEEPEST = 4, 16

LOCATED = "abs(x) < double('infinity') and abs(y) < double('infinity')"


def usable(dim: int) -> str:
    """What can be found: finite coordinates, and at least one piece. NaN counts above infinity."""
    bounded = " and ".join(f"abs(e.{c}) < double('infinity')" for c in ("x1", "y1", "x2", "y2"))
    return LOCATED if dim == g.POINT_DIM else f"size({g.pieces(dim)}) > 0 and forall({g.pieces(dim)}, e -> {bounded})"


def all_pieces(layers: list[tuple[DataFrame, int]], by: list[str]) -> DataFrame:
    """(by…, x1, y1, x2, y2) of the distinct pieces of all usable features; a point is a piece without length."""
    parts = []
    for df, dim in layers:
        have = df.where(usable(dim))
        if dim == g.POINT_DIM:
            parts.append(have.selectExpr(*by, "x as x1", "y as y1", "x as x2", "y as y2"))
        else:
            parts.append(have.selectExpr(*by, f"inline({g.pieces(dim)})"))
    return reduce(DataFrame.unionByName, parts).distinct()


def _extent(places: DataFrame, pieces: DataFrame) -> tuple[float, float, float] | None:
    """Origin and width of a square that holds everything; None if a side is empty."""
    of_pieces = pieces.selectExpr("min(least(x1, x2)) x0", "max(greatest(x1, x2)) x1", "min(least(y1, y2)) y0", "max(greatest(y1, y2)) y1")
    spans = places.selectExpr("min(x) x0", "max(x) x1", "min(y) y0", "max(y) y1").union(of_pieces).collect()
    if any(s["x0"] is None for s in spans):
        return None
    x0, y0 = (min(s[c] for s in spans) for c in ("x0", "y0"))
    width = max(max(s["x1"] for s in spans) - x0, max(s["y1"] for s in spans) - y0)
    return x0, y0, (width or 1.0) * (1 + 1e-9)


def _met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join that shuffles whatever the files' sizes."""
    return left.join(right.hint("merge"), on, how)


#: The outermost pieces of a cell, each by a point of it, as (x, y); nearest to a place from one side or the other.
REPS = [
    ("min(x1)", "min_by(y1, x1)"),
    ("max(x1)", "max_by(y1, x1)"),
    ("min_by(x1, y1)", "min(y1)"),
    ("max_by(x1, y1)", "max(y1)"),
]


def _not_behind_guide() -> str:
    """Whether some place of the cell's box may be nearer to the box of pieces than to its guide.

    The difference of the squared distances is largest at a corner of the box of places, axis by axis, and only there the
    same place stands on both sides, so the width of the box does not blur far pieces.
    """
    diff, size = [], []
    for c in "xy":
        ends = [(f"abs(guide.{c} - p{c}{n})", f"greatest(0D, i{c}0 - p{c}{n}, p{c}{n} - i{c}1)") for n in (0, 1)]
        diff.append(f"greatest({', '.join(f'({a} - {b}) * ({a} + {b})' for a, b in ends)})")
        size.append(f"greatest({', '.join(f'pow({a} + {b}, 2)' for a, b in ends)})")
    return f"{' + '.join(diff)} >= -1e-14D * ({' + '.join(size)})"


def cell_pairs(places: DataFrame, pieces: DataFrame, by: list[str], at: tuple, depth: int, above: DataFrame | None) -> DataFrame:
    """The pairs of cells of one width that may hold a nearest piece, with the bound `u` and the `guide` of the cell of places.

    `above` holds the pairs of the width before that are split, None for the whole square. A cell's bound is the least
    of its own and its parent's, and its guide the closest, so pairs that were already compared still prune.
    """
    p, i = _cells(places, by, "p", at, depth), _cells(pieces, by, "i", at, depth)
    if above is None:
        one = F.lit(0)
        pairs = p.withColumn("_one", one).join(i.withColumn("_one", one), [*by, "_one"])
        pairs = pairs.withColumns({"u": F.lit(float("inf")), "guide": F.expr("cast(null as struct<x:double,y:double>)")})
    else:
        parents = {f"{s}c{c}": f"{s}{c}" for s in "pi" for c in "xy"}
        pairs = above.select(*by, "u", "guide", *[F.col(k).alias(v) for k, v in parents.items()])
        for side, cells in (("p", p), ("i", i)):
            up = {f"{side}{c}": F.expr(f"{side}c{c} div {SPLIT}") for c in "xy"}
            pairs = _met(pairs, cells.withColumns(up), [*by, *up]).drop(*up)
    far = " + ".join(f"pow(greatest(i{c}1 - p{c}0, p{c}1 - i{c}0), 2)" for c in "xy")
    gap = " + ".join(f"pow(greatest(0D, i{c}0 - p{c}1, p{c}0 - i{c}1), 2)" for c in "xy")
    cell = W.partitionBy(*by, "pcx", "pcy")
    # The closest to the middle of the box, of the pieces that stand for the cells and the guide so far.
    off = "pow(r.x - (px0 + px1) / 2, 2) + pow(r.y - (py0 + py1) / 2, 2)"
    ranked = f"array_min(transform(if(guide is null, reps, concat(reps, array(guide))), r -> struct({off} as d, r.x as x, r.y as y)))"
    pairs = pairs.withColumn("guide", F.expr(ranked))
    pairs = pairs.withColumns({"u": F.least("u", F.min(F.expr(far)).over(cell)), "guide": F.min("guide").over(cell)})
    pairs = pairs.withColumn("guide", F.expr("named_struct('x', guide.x, 'y', guide.y)"))
    pairs = pairs.where(f"{gap} <= u * {num(1 + 1e-9)} and {_not_behind_guide()}")
    few = f"pm * im <= {FEW}" if depth < DEEPEST else "true"
    return materialise(pairs.select(*by, "pcx", "pcy", "icx", "icy", "pm", "im", "u", "guide", F.expr(few).alias("few")))


def _placed(rows: DataFrame, side: str, at: tuple, depth: int) -> DataFrame:
    """Rows with their cell; a piece lies where its middle is."""
    x0, y0, width = at
    step = num(width / SPLIT**depth)
    x, y = ("x", "y") if side == "p" else ("(x1 + x2) / 2", "(y1 + y2) / 2")
    return rows.withColumns({f"{side}cx": F.expr(f"floor(({x} - {num(x0)}) / {step})"), f"{side}cy": F.expr(f"floor(({y} - {num(y0)}) / {step})")})


def _cells(rows: DataFrame, by: list[str], side: str, at: tuple, depth: int) -> DataFrame:
    low, high = ("{0}", "{0}") if side == "p" else ("least({0}1, {0}2)", "greatest({0}1, {0}2)")
    bounds = [F.expr(f"{f}({b.format(c)})").alias(f"{side}{c}{n}") for c in "xy" for n, f, b in ((0, "min", low), (1, "max", high))]
    reps = [F.array(*[F.struct(F.expr(x).alias("x"), F.expr(y).alias("y")) for x, y in REPS]).alias("reps")] if side == "i" else []
    return _placed(rows, side, at, depth).groupBy(*by, f"{side}cx", f"{side}cy").agg(F.count(F.lit(1)).alias(f"{side}m"), *bounds, *reps)


def nearest_pieces(places: DataFrame, pieces: DataFrame, by: list[str]) -> DataFrame | None:
    """(by…, x, y, sq) of the distinct `places`: the squared distance to the nearest piece; None if there is none at all.

    A width's pairs are written, so a lost executor repeats one width only. The bounds of the whole are a single row.
    """
    at = _extent(places, pieces)
    if at is None:
        return None
    found, above = [], None
    for depth in range(DEEPEST + 1):
        pairs = cell_pairs(places, pieces, by, at, depth, above)
        cells = ["pcx", "pcy", "icx", "icy"]
        met = _met(pairs.where("few").select(*by, *cells), _placed(places, "p", at, depth), [*by, "pcx", "pcy"])
        met = _met(met, _placed(pieces, "i", at, depth), [*by, "icx", "icy"])
        sq = g.point_piece_sq("x", "y", "e")
        met = met.selectExpr(*by, "x", "y", f"inline(array(named_struct('e', {g.piece('x1', 'y1', 'x2', 'y2')})))")
        found.append(met.groupBy(*by, "x", "y").agg(F.min(F.expr(sq)).alias("sq")))
        above = pairs.where("not few")
        if above.isEmpty():
            break
    return reduce(DataFrame.unionByName, found).groupBy(*by, "x", "y").agg(F.min("sq").alias("sq"))
