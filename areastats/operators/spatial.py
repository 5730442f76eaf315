"""Spatial joins and measures: within, intersects, within-distance, nearest, clipped length, assignment."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.functions.geometry import num
from areastats.operators.nearest import LOCATED, all_pieces, nearest_pieces, usable
from areastats.operators.tiles import cell_sql, prefixed, tile, with_cell
from areastats.session import materialise

AREA_KEYS = ["geography", "geoid10"]


def representative_points(features: DataFrame, dim: int) -> DataFrame:
    """Features with the x, y of their centroid in place of the shape; points stay as they are."""
    return features if dim == g.POINT_DIM else g.with_centroid(features, dim)


def area_tiles(areas: DataFrame, cell: float, reach: float = 0.0) -> DataFrame:
    return tile(areas, g.POLYGON_DIM, cell, reach, AREA_KEYS)


def within(points: DataFrame, tiles: DataFrame, cell: float, boundary: bool = False, many: bool = False) -> DataFrame:
    """Each point with every polygon that contains it; the boundary belongs to it only with `boundary=True`.

    One equi-join on the cell, no aggregate: a point lies in one cell only, so pairs come out once. With `many` the polygons
    are a layer of any size, not a few areas, and their tiles are not broadcast.
    """
    spot = g.locate("ray", "flip", "x", "y")
    shapes = tiles.drop("near")
    joined = with_cell(points, cell).join(shapes.hint("merge") if many else shapes, ["cx", "cy"])
    hit = joined.where(f"inside or {spot} {'<> 0' if boundary else '= 1'}")
    return hit.drop("cx", "cy", "inside", "flip", "ray")


def assign(features: DataFrame, dim: int, tiles: DataFrame, cell: float, boundary: bool = False) -> DataFrame:
    """Feature attributes with the areas of all geographies that hold its centroid."""
    return within(representative_points(features, dim), tiles, cell, boundary).drop("x", "y")


def zips_within(zips: DataFrame, metro_tiles: DataFrame, cell: float, metro: str = "32820") -> DataFrame:
    """Codes of the ZIP areas whose centroid lies in the metro area."""
    centres = representative_points(zips.select(F.col("geoid10").alias("zip"), "rings"), g.POLYGON_DIM)
    inside = within(centres, metro_tiles.where(F.col("geoid10") == metro), cell)
    return inside.select("zip").distinct()


def _keys(tiles: DataFrame, prefix: str) -> list[str]:
    return [c for c in tiles.columns if c not in ("cx", "cy") and not c.startswith(prefix)]


def near_pairs(
    left: DataFrame, left_dim: int, right: DataFrame, right_dim: int, cell: float, reach: float = 0.0
) -> DataFrame:
    """Distinct (left keys, right keys) at most `reach` apart; `reach=0` means that they intersect.

    Columns other than the shape are the keys of a side, unique there; the two sides must not share names. The smaller side
    belongs on the right, since its tiles are widened by `reach`. A point lies in one cell and meets one tile of a feature
    there, so only pairs of longer left features can come twice and are made distinct by a shuffle.
    """
    lt = prefixed(tile(left, left_dim, cell), "l_")
    rt = prefixed(tile(right, right_dim, cell, reach), "r_")

    def starts_in(pieces: str, ray: str, flip: str) -> str:
        here = f"{cell_sql('e.x1', cell)} = cx and {cell_sql('e.y1', cell)} = cy"
        return f"exists({pieces}, e -> {here} and {g.locate(ray, flip, 'e.x1', 'e.y1')} <> 0)"

    tests = ["r_inside"]
    if left_dim == g.POLYGON_DIM:
        tests.append(f"(l_inside and {_reaches_cell('r_near', cell, reach)})")
    tests.append(f"exists(l_near, e -> exists(r_near, p -> {g.pieces_within('e', 'p', reach)}))")
    if right_dim == g.POLYGON_DIM:
        tests.append(starts_in("l_near", "r_ray", "r_flip"))
    if left_dim == g.POLYGON_DIM:
        tests.append(starts_in("r_near", "l_ray", "l_flip"))
    hits = lt.join(rt, ["cx", "cy"]).where(" or ".join(tests))
    pairs = hits.select(*_keys(lt, "l_"), *_keys(rt, "r_"))
    return pairs if left_dim == g.POINT_DIM else pairs.distinct()


def _reaches_cell(pieces: str, cell: float, reach: float) -> str:
    """Some piece comes within reach of the closed cell square."""
    x0, y0 = f"cx * {num(cell)}", f"cy * {num(cell)}"
    x1, y1 = f"(cx + 1) * {num(cell)}", f"(cy + 1) * {num(cell)}"
    corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]
    sides = ", ".join(g.piece(*a, *b) for a, b in zip(corners, corners[1:]))
    return (
        f"exists({pieces}, e -> (e.x1 between {x0} and {x1} and e.y1 between {y0} and {y1})"
        f" or exists(array({sides}), p -> {g.pieces_within('e', 'p', reach)}))"
    )


def nearest_distance(points: DataFrame, layers: list[tuple[DataFrame, int]], cell: float, by: list[str] | None = None) -> DataFrame:
    """Each point with `dist` to its nearest feature: 0 inside a polygon, null where there is no feature.

    `by` names columns that points and features share (such as the layer), so many layers are searched in one go. `cell` is
    the width of the tiles that tell which points lie in a polygon; the search itself fits its cells to the features. Copies
    at one place are searched once, on either side. The points are written once, so the places that are searched and those
    that get the answers are the same doubles. Coordinates that are null, NaN or infinite and shapes without a piece are no
    places: such points get null, such features are not found, and every other search ends.
    """
    by = by or []
    keys = [*by, "x", "y"]
    answer = [c for c in points.columns if c not in ("x", "y")]
    points = materialise(points)
    places = points.where(LOCATED).select(*keys).distinct()
    pieces = materialise(all_pieces(layers, by))
    near = nearest_pieces(places, pieces, by)
    if near is None:
        return points.select(*answer, F.lit(None).cast("double").alias("dist"))
    parts = [near.select(*keys, F.sqrt("sq").alias("dist"))]
    for df, dim in layers:
        if dim == g.POLYGON_DIM:
            tiles = tile(df.where(usable(dim)).select(*by, "rings"), dim, cell, keep=by).drop("near")
            inside = with_cell(places, cell).join(tiles, [*by, "cx", "cy"])
            inside = inside.where(f"inside or {g.locate('ray', 'flip', 'x', 'y')} <> 0")
            parts.append(inside.select(*keys, F.lit(0.0).alias("dist")))
    found = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.min("dist").alias("dist"))
    # Not by broadcast: places on a lattice are small as bytes and large in memory.
    return points.join(found.hint("merge"), keys, "left").select(*answer, "dist")


#: Direction of a piece.
DX, DY = "(e.x2 - e.x1)", "(e.y2 - e.y1)"


def _stretch_counts(buffer: float) -> str:
    """Whether the middle `s.m` of a stretch is in the area or within the buffer."""
    px, py = f"(e.x1 + s.m * {DX})", f"(e.y1 + s.m * {DY})"
    return (
        f"{g.locate('r_ray', 'r_flip', px, py)} <> 0"
        f" or exists(close, p -> {g.point_piece_sq(px, py, 'p')} <= {num(buffer * buffer)})"
    )


def _cut_parts(lines: DataFrame, areas: DataFrame, cell: float, buffer: float) -> tuple[DataFrame, list[str]]:
    """The parts of lines in the cells of areas, with the parameters `ts` at which a part may enter or leave its area
    widened by `buffer`. Lines are cut at cell borders, so every part is judged where its tile is."""
    lt = prefixed(tile(lines, g.LINE_DIM, cell), "l_")
    at = prefixed(area_tiles(areas, cell, buffer), "r_")
    keys = _keys(lt, "l_")
    dx, dy = DX, DY

    def share(axis: str, border: str) -> str:
        return f"try_divide({border} * {num(cell)} - e.{axis}1, e.{axis}2 - e.{axis}1)"

    parts = lt.selectExpr(*keys, "cx", "cy", "explode(l_near) as e")
    enter, leave = ["0D"], ["1D"]
    for axis in "xy":
        a, b = share(axis, f"c{axis}"), share(axis, f"(c{axis} + 1)")
        enter.append(f"coalesce(least({a}, {b}), 0D)")
        leave.append(f"coalesce(greatest({a}, {b}), 1D)")
    parts = parts.selectExpr(
        *keys, "cx", "cy", "e", f"greatest({', '.join(enter)}) as ta", f"least({', '.join(leave)}) as tb"
    ).where("tb > ta")
    mid_x, mid_y = f"(e.x1 + (ta + tb) / 2 * {dx})", f"(e.y1 + (ta + tb) / 2 * {dy})"
    parts = parts.where(f"{cell_sql(mid_x, cell)} = cx and {cell_sql(mid_y, cell)} = cy")
    joined = parts.join(at, ["cx", "cy"])
    close = f"if(r_inside, {g.NO_PIECES}, filter(r_near, p -> {g.pieces_within('e', 'p', buffer)}))"
    joined = g.frozen(joined, joined.columns, {"close": close})

    # Parameters where the line may enter or leave the surroundings of one piece.
    gx, gy = "(p.x2 - p.x1)", "(p.y2 - p.y1)"
    size = f"sqrt({gx} * {gx} + {gy} * {gy})"

    def meet(shift: float) -> str:
        ox = f"(p.x1 - {gy} / {size} * {num(shift)} - e.x1)" if shift else "(p.x1 - e.x1)"
        oy = f"(p.y1 + {gx} / {size} * {num(shift)} - e.y1)" if shift else "(p.y1 - e.y1)"
        return f"try_divide({ox} * {gy} - {oy} * {gx}, {dx} * {gy} - {dy} * {gx})"

    stops = [meet(0.0)]
    if buffer > 0:
        stops += [meet(buffer), meet(-buffer)]
        for n in "12":
            ox, oy = f"(e.x1 - p.x{n})", f"(e.y1 - p.y{n})"
            a, b = f"({dx} * {dx} + {dy} * {dy})", f"({dx} * {ox} + {dy} * {oy})"
            disc = f"({b} * {b} - {a} * ({ox} * {ox} + {oy} * {oy} - {num(buffer * buffer)}))"
            for sign in "+-":
                stops.append(f"if({disc} >= 0, try_divide(-{b} {sign} sqrt(greatest({disc}, 0D)), {a}), null)")
    inner = f"filter(flatten(transform(close, p -> array({', '.join(stops)}))), t -> t > ta and t < tb)"
    cuts = f"if(size(close) = 0, array(ta, tb), array_sort(array_distinct(concat(array(ta, tb), {inner}))))"
    joined = g.frozen(joined, joined.columns, {"ts": cuts})
    return joined, keys


def clipped_length(lines: DataFrame, areas: DataFrame, cell: float, buffer: float = 0.5) -> DataFrame:
    """Length of each line within each area widened by `buffer`, for the pairs that truly intersect.

    The length is the sum over the stretches between crossing points whose middle is in the area or within the buffer.
    Returns line keys, area keys and `length`.
    """
    joined, keys = _cut_parts(lines, areas, cell, buffer)
    dx, dy = DX, DY
    mid_x, mid_y = f"(e.x1 + (ta + tb) / 2 * {dx})", f"(e.y1 + (ta + tb) / 2 * {dy})"
    counts = _stretch_counts(buffer)
    spans = (
        "zip_with(slice(ts, 1, size(ts) - 1), slice(ts, 2, size(ts) - 1),"
        " (a, b) -> named_struct('m', (a + b) / 2, 'w', b - a))"
    )
    covered = f"aggregate(filter({spans}, s -> {counts}), 0D, (acc, s) -> acc + s.w)"
    joined = g.frozen(
        joined, [*keys, *AREA_KEYS, "e", "ta", "tb", "r_inside", "r_ray", "r_flip", "close"],
        {"share": f"if(r_inside, tb - ta, {covered})"},
    )
    # Without a piece nearby the part lies on one side as a whole, so its share already tells which.
    touches = "true" if buffer <= 0 else f"exists(close, p -> {g.pieces_touch('e', 'p')})"
    meets = (
        f"r_inside or if(size(close) = 0, share > 0,"
        f" {touches} or {g.locate('r_ray', 'r_flip', mid_x, mid_y)} <> 0)"
    )
    measured = joined.selectExpr(
        *keys, *AREA_KEYS, f"share * sqrt({dx} * {dx} + {dy} * {dy}) as part", f"{meets} as meets"
    )
    return (
        measured.groupBy(*keys, *AREA_KEYS)
        .agg(F.sum("part").alias("length"), F.max("meets").alias("meets"))
        .where("meets and length > 0")
        .drop("meets")
    )


def clip_lines(lines: DataFrame, areas: DataFrame, cell: float) -> DataFrame:
    """The geometry of each line (`feature_id`, `rings`) within each area: feature_id, area keys and `rings`, one part for
    each stretch that does not leave the area, with new vertices where it enters and leaves.

    Stretches on the border belong to the area, as in `clipped_length` without a buffer, whose lengths these have. Lines
    that only touch an area, lines without length and null shapes give no row; parts follow the line's direction.
    """
    each = lines.selectExpr("feature_id", f"posexplode({g.pieces(g.LINE_DIM)}) as (_i, _e)")
    ends = "array(named_struct('x', _e.x1, 'y', _e.y1), named_struct('x', _e.x2, 'y', _e.y2))"
    each = each.selectExpr("feature_id", "_i", f"array(named_struct('part', 0, 'hole', false, 'pts', {ends})) as rings")
    joined, keys = _cut_parts(each, areas, cell, 0.0)
    spans = (
        "zip_with(slice(ts, 1, size(ts) - 1), slice(ts, 2, size(ts) - 1),"
        " (a, b) -> named_struct('m', (a + b) / 2, 'a', a, 'b', b))"
    )
    whole = "array(named_struct('m', (ta + tb) / 2, 'a', ta, 'b', tb))"
    kept = f"if(r_inside, {whole}, filter({spans}, s -> {_stretch_counts(0.0)}))"
    joined = g.frozen(joined, [*keys, *AREA_KEYS, "e"], {"kept": kept})
    stretches = joined.selectExpr("feature_id", *AREA_KEYS, "_i", "e", "explode(kept) as s")

    def at(t: str) -> str:
        x = f"if({t} = 1, e.x2, e.x1 + {t} * {DX})"
        return f"named_struct('x', {x}, 'y', if({t} = 1, e.y2, e.y1 + {t} * {DY}))"

    stretch = f"named_struct('i', _i, 'a', s.a, 'b', s.b, 'p', {at('s.a')}, 'q', {at('s.b')})"
    # A line is one value in its row, and so are its stretches within an area.
    ordered = stretches.groupBy("feature_id", *AREA_KEYS).agg(F.array_sort(F.collect_list(F.expr(stretch))).alias("_s"))
    # A stretch goes on with the one before if it lies on the same piece (a cell border) or starts where that one ends.
    merged = """aggregate(_s, named_struct('i', -1, 'b', 0D, 'q', _s[0].p, 'parts', cast(array() as array<array<struct<x:double,y:double>>>)),
      (acc, s) -> named_struct('i', s.i, 'b', s.b, 'q', s.q, 'parts',
        if(size(acc.parts) > 0 and s.i = acc.i and abs(s.a - acc.b) < 1e-12,
          concat(slice(acc.parts, 1, size(acc.parts) - 1), array(concat(
            slice(element_at(acc.parts, -1), 1, size(element_at(acc.parts, -1)) - 1), array(s.q)))),
        if(size(acc.parts) > 0 and s.p = acc.q,
          concat(slice(acc.parts, 1, size(acc.parts) - 1), array(concat(element_at(acc.parts, -1), array(s.q)))),
          concat(acc.parts, array(array(s.p, s.q)))))), acc -> acc.parts)"""
    rings = f"transform({merged}, (pts, n) -> named_struct('part', n, 'hole', false, 'pts', pts)) as rings"
    return ordered.selectExpr("feature_id", *AREA_KEYS, rings)
