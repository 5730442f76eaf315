"""Planar geometry as SQL expressions over arrays.

A feature keeps its shape in one value, `rings: array<struct<part, hole, pts: array<struct<x, y>>>>`: the rings of a
polygon (first vertex need not be repeated) or the parts of a line. Points are plain `x`, `y` columns. With the shape in
the row, edges, centroids and grid cells need no shuffle.

The helpers return SQL text, which composes and nests without building thousands of column objects. Arguments are SQL
too: a column, a lambda variable or a number. `e` and `p` stand for pieces, straight lines with x1, y1, x2, y2. Divisions
are guarded, so everything is safe under ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POINT_DIM, LINE_DIM, POLYGON_DIM = 0, 1, 2

RINGS_TYPE = "array<struct<part:int,hole:boolean,pts:array<struct<x:double,y:double>>>>"
PIECES_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"
NO_PIECES = f"cast(array() as {PIECES_TYPE})"


def num(value: float) -> str:
    """A double literal."""
    return f"({float(value)!r}D)"


def piece(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"named_struct('x1', {x1}, 'y1', {y1}, 'x2', {x2}, 'y2', {y2})"


def frozen(df: DataFrame, keep: list[str], computed: dict[str, str]) -> DataFrame:
    """Project costly expressions so that later filters cannot be rewritten to evaluate them again.

    Spark pushes a filter on a computed column below the projection by repeating the expression; it does not push it
    below a generator.
    """
    fields = ", ".join(f"'{name}', {sql}" for name, sql in computed.items())
    return df.selectExpr(*keep, f"inline(array(named_struct({fields})))")


def ring_pieces(pts: str, dim: int) -> str:
    """Straight pieces of one vertex list; polygon rings are closed and zero-length pieces dropped."""
    rest = f"slice({pts}, 2, size({pts}))"
    if dim == POLYGON_DIM:
        first, second = pts, f"concat({rest}, array(get({pts}, 0)))"
    else:
        first, second = f"slice({pts}, 1, greatest(size({pts}) - 1, 0))", rest
    joined = f"zip_with({first}, {second}, (v, w) -> {piece('v.x', 'v.y', 'w.x', 'w.y')})"
    return f"filter({joined}, z -> z.x1 <> z.x2 or z.y1 <> z.y2)"


def pieces(dim: int, rings: str = "rings") -> str:
    return f"flatten(transform({rings}, ring -> {ring_pieces('ring.pts', dim)}))"


def side(e: str, px: str, py: str) -> str:
    """Positive where the point lies left of the directed piece, zero where it lies on its line."""
    return f"(({e}.x2 - {e}.x1) * ({py} - {e}.y1) - ({px} - {e}.x1) * ({e}.y2 - {e}.y1))"


def in_box(e: str, px: str, py: str) -> str:
    """Point within the closed bounding box of a piece."""
    return (
        f"({px} between least({e}.x1, {e}.x2) and greatest({e}.x1, {e}.x2)"
        f" and {py} between least({e}.y1, {e}.y2) and greatest({e}.y1, {e}.y2))"
    )


def locate(ray: str, flip: str, px: str, py: str) -> str:
    """1 inside, 0 outside, -1 on the boundary, by crossings of a ray towards larger x.

    `flip` holds crossings known beforehand. Parity over all rings covers holes and several parts alike.
    """
    s = side("k", px, py)
    return (
        f"aggregate({ray}, 0, (acc, k) -> case when acc < 0 then acc"
        f" when {s} = 0 and {in_box('k', px, py)} then -1"
        f" when (k.y1 > {py}) <> (k.y2 > {py}) and ({s} > 0) = (k.y2 > k.y1) then acc + 1"
        f" else acc end, acc -> if(acc < 0, -1, (acc + {flip}) % 2))"
    )


def point_piece_sq(px: str, py: str, e: str) -> str:
    """Squared distance from a point to a piece (which may have zero length)."""
    dx, dy = f"({e}.x2 - {e}.x1)", f"({e}.y2 - {e}.y1)"
    t = (
        f"least(1D, greatest(0D, coalesce(try_divide(({px} - {e}.x1) * {dx} + ({py} - {e}.y1) * {dy},"
        f" {dx} * {dx} + {dy} * {dy}), 0D)))"
    )
    return f"(pow({px} - {e}.x1 - {t} * {dx}, 2) + pow({py} - {e}.y1 - {t} * {dy}, 2))"


def pieces_touch(e: str, p: str) -> str:
    """Closed pieces share a point: their boxes overlap and neither lies strictly on one side of the other."""
    boxes = " and ".join(
        f"greatest({e}.{a}1, {e}.{a}2) >= least({p}.{a}1, {p}.{a}2)"
        f" and least({e}.{a}1, {e}.{a}2) <= greatest({p}.{a}1, {p}.{a}2)"
        for a in "xy"
    )
    first = f"signum({side(e, f'{p}.x1', f'{p}.y1')}) * signum({side(e, f'{p}.x2', f'{p}.y2')}) <= 0"
    second = f"signum({side(p, f'{e}.x1', f'{e}.y1')}) * signum({side(p, f'{e}.x2', f'{e}.y2')}) <= 0"
    return f"({boxes} and {first} and {second})"


def pieces_within(e: str, p: str, reach: float) -> str:
    """Two pieces at most `reach` apart."""
    touch = pieces_touch(e, p)
    if reach <= 0:
        return touch
    limit = num(reach * reach)
    ends = [(p, "1", e), (p, "2", e), (e, "1", p), (e, "2", p)]
    close = " or ".join(f"{point_piece_sq(f'{a}.x{n}', f'{a}.y{n}', b)} <= {limit}" for a, n, b in ends)
    boxes = " and ".join(
        f"greatest({e}.{a}1, {e}.{a}2) + {num(reach)} >= least({p}.{a}1, {p}.{a}2)"
        f" and least({e}.{a}1, {e}.{a}2) - {num(reach)} <= greatest({p}.{a}1, {p}.{a}2)"
        for a in "xy"
    )
    return f"({boxes} and ({touch} or {close}))"


def _weighted(items: str, v: str, x: str, y: str, w: str) -> str:
    """Sums of x, y and weight over an array."""
    start = "named_struct('sx', 0D, 'sy', 0D, 'w', 0D)"
    return (
        f"aggregate({items}, {start}, (acc, {v}) ->"
        f" named_struct('sx', acc.sx + {x}, 'sy', acc.sy + {y}, 'w', acc.w + {w}))"
    )


def with_centroid(features: DataFrame, dim: int) -> DataFrame:
    """Replace `rings` by the centroid `x`, `y`.

    Area-weighted (each ring counts with the sign of its role, so holes subtract whatever their direction), else
    length-weighted, else the mean vertex. Sums are taken around the first vertex to keep precision.
    """
    rest = [c for c in features.columns if c != "rings"]
    names = [f"`{c}`" for c in rest]
    df = features.selectExpr(*names, "rings", "get(flatten(transform(rings, r -> r.pts)), 0) as _o")

    ax, ay, bx, by = "(e.x1 - _o.x)", "(e.y1 - _o.y)", "(e.x2 - _o.x)", "(e.y2 - _o.y)"
    turn = f"({ax} * {by} - {bx} * {ay})"
    ring_sums = _weighted(
        ring_pieces("ring.pts", POLYGON_DIM), "e", f"({ax} + {bx}) * {turn} / 3", f"({ay} + {by}) * {turn} / 3", turn
    )
    rings = f"transform(rings, ring -> named_struct('role', if(ring.hole, -1D, 1D), 's', {ring_sums}))"
    sign = "q.role * signum(q.s.w)"
    area = _weighted(rings, "q", f"{sign} * q.s.sx", f"{sign} * q.s.sy", f"{sign} * q.s.w")
    size = "sqrt(pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2))"
    line = _weighted(
        pieces(dim),
        "e",
        f"{size} * ((e.x1 + e.x2) / 2 - _o.x)",
        f"{size} * ((e.y1 + e.y2) / 2 - _o.y)",
        size,
    )
    mean = _weighted("flatten(transform(rings, r -> r.pts))", "v", "v.x - _o.x", "v.y - _o.y", "1D")
    choices = ([area] if dim == POLYGON_DIM else []) + [line, mean]
    empty = "cast(null as struct<sx:double,sy:double,w:double>)"
    chosen = empty
    for sums in reversed(choices):
        chosen = f"coalesce(get(filter(array({sums}), s -> s.w <> 0), 0), {chosen})"
    df = frozen(df, names, {"_ox": "_o.x", "_oy": "_o.y", "_s": chosen})
    return df.selectExpr(*names, "_ox + try_divide(_s.sx, _s.w) as x", "_oy + try_divide(_s.sy, _s.w) as y")


def rings_from_vertices(vertex: DataFrame, keys: list[str]) -> DataFrame:
    """Vertex rows `(keys…, part, ring, seq, x, y)` to one row per feature; ring 0 of a part is the shell."""
    sorted_pts = F.array_sort(F.collect_list(F.struct("seq", "x", "y")))
    ring = vertex.groupBy(*keys, "part", "ring").agg(sorted_pts.alias("_v"))
    shape = F.array_sort(F.collect_list(F.struct("part", "ring", "_v")))
    whole = ring.groupBy(*keys).agg(shape.alias("_r"))
    text = (
        "transform(_r, r -> named_struct('part', cast(r.part as int), 'hole', r.ring > 0,"
        " 'pts', transform(r._v, v -> named_struct('x', v.x, 'y', v.y))))"
    )
    return whole.selectExpr(*[f"`{k}`" for k in keys], f"{text} as rings")
