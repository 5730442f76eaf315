"""Grid tiles: the shuffle-free preparation behind every spatial join.

`tile` cuts each shape into square cells inside its own row. A tile is either wholly `inside` a polygon, or it carries
the few pieces needed there: `ray` (with parity `flip`) decides containment of any point of the cell, `near` holds the
pieces at most `reach` away from the cell. A spatial join is then an equi-join on the cell, and most points meet a tile
that is wholly inside and need no geometry at all.

A crowded cell is a hot join key. The feature side is the large one and adaptive execution splits its hot partitions;
the tiles of a few areas are broadcast and the features do not move at all. Spark estimates tiles by the file they come from,
which says little of their number, so a join with the tiles of a layer of any size asks for a shuffle (`within(many=True)`).
Shapes are dealt evenly over the tasks first, since a small file of them, read by one task, makes many tiles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.functions.geometry import num

PAYLOAD = ["inside", "flip", "ray", "near"]


def cell_sql(value: str, cell: float) -> str:
    return f"floor(({value}) / {num(cell)})"


def with_cell(points: DataFrame, cell: float, x: str = "x", y: str = "y") -> DataFrame:
    """Add the cell of each point; points without coordinates drop out."""
    placed = points.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return placed.withColumns({"cx": F.expr(cell_sql(x, cell)), "cy": F.expr(cell_sql(y, cell))})


def _bare(pieces: str) -> str:
    return f"transform({pieces}, e -> {g.piece('e.x1', 'e.y1', 'e.x2', 'e.y2')})"


def dealt(features: DataFrame) -> DataFrame:
    """The rows spread evenly over all cores, however few files or partitions they come from."""
    return features.repartition(4 * features.sparkSession.sparkContext.defaultParallelism)


def tile(features: DataFrame, dim: int, cell: float, reach: float = 0.0, keep: list[str] | None = None) -> DataFrame:
    """One row per feature and cell it touches, covers, or comes within `reach` of."""
    if keep is None:
        keep = [c for c in features.columns if c not in ("rings", "x", "y")]
    keys = [f"`{c}`" for c in keep]
    if dim == g.POINT_DIM:
        return _point_tiles(features, cell, reach, keys)

    r, eps = num(reach), num(cell * 1e-6)
    low, high = "least(e.y1, e.y2)", "greatest(e.y1, e.y2)"
    y0, y1 = f"(cy * {num(cell)})", f"((cy + 1) * {num(cell)})"
    x0, x1 = f"(cx * {num(cell)})", f"((cx + 1) * {num(cell)})"

    shaped = g.frozen(dealt(features), keys, {"_e": g.pieces(dim)})
    lowest = cell_sql(f"array_min(transform(_e, e -> {low})) - {r}", cell)
    highest = cell_sql(f"array_max(transform(_e, e -> {high})) + {r}", cell)
    rows = shaped.selectExpr(*keys, "_e", f"explode(sequence({lowest}, {highest})) as cy")

    def x_at(y: str) -> str:
        clamped = f"least(greatest({y}, {low}), {high})"
        return f"e.x1 + (e.x2 - e.x1) * coalesce(try_divide({clamped} - e.y1, e.y2 - e.y1), 0D)"

    # Per row of cells: the pieces within reach of it and the x range each covers there.
    in_row = f"filter(_e, e -> {low} - {r} - {eps} <= {y1} and {high} + {r} + {eps} >= {y0})"
    a, b = x_at(f"{y0} - {r}"), x_at(f"{y1} + {r}")
    spanned = (
        "transform({0}, e -> named_struct('x1', e.x1, 'y1', e.y1, 'x2', e.x2, 'y2', e.y2,"
        " 'lo', if(e.y1 = e.y2, least(e.x1, e.x2), least({1}, {2})),"
        " 'hi', if(e.y1 = e.y2, greatest(e.x1, e.x2), greatest({1}, {2}))))"
    ).format(in_row, a, b)
    bands = g.frozen(rows, [*keys, "cy"], {"_b": spanned})
    left = cell_sql(f"array_min(transform(_b, e -> e.lo)) - {r} - {eps}", cell)
    right = cell_sql(f"array_max(transform(_b, e -> e.hi)) + {r} + {eps}", cell)
    cells = bands.selectExpr(*keys, "cy", "_b", f"explode(sequence({left}, {right})) as cx")

    near = f"filter(_b, e -> e.hi + {r} + {eps} >= {x0} and e.lo - {r} - {eps} <= {x1})"
    staged = g.frozen(cells, [*keys, "cx", "cy", "_b"], {"_near": near})
    if dim == g.LINE_DIM:
        return staged.where("size(_near) > 0").selectExpr(
            *keys, "cx", "cy", "false as inside", "0 as flip", f"{g.NO_PIECES} as ray", f"{_bare('_near')} as near"
        )

    crosses_row = f"({low} - {eps} <= {y1} and {high} + {eps} >= {y0})"
    beyond = f"(e.lo > {x1} + {eps} and {low} <= {y0} - {eps} and {high} >= {y1} + {eps})"
    touched = f"exists(_near, e -> e.hi + {eps} >= {x0} and e.lo - {eps} <= {x1} and {crosses_row})"
    ray = f"filter(_b, e -> {crosses_row} and e.hi + {eps} >= {x0} and not {beyond})"
    staged = g.frozen(
        staged,
        [*keys, "cx", "cy", "_near"],
        {"_touched": touched, "flip": f"size(filter(_b, e -> {crosses_row} and {beyond})) % 2", "ray": _bare(ray)},
    )
    centre = g.locate("ray", "flip", f"((cx + 0.5D) * {num(cell)})", f"((cy + 0.5D) * {num(cell)})")
    staged = g.frozen(
        staged,
        [*keys, "cx", "cy", "_near", "_touched", "flip", "ray"],
        {"inside": f"not _touched and {centre} = 1"},
    )
    return staged.where("inside or _touched or size(_near) > 0").selectExpr(
        *keys,
        "cx",
        "cy",
        "inside",
        "if(_touched, flip, 0) as flip",
        f"if(_touched, ray, {g.NO_PIECES}) as ray",
        f"{_bare('_near')} as near",
    )


def _point_tiles(points: DataFrame, cell: float, reach: float, keys: list[str]) -> DataFrame:
    """A point as a piece of zero length, in every cell within reach."""
    base = points.where("x is not null and y is not null")
    if reach > 0:
        for axis in "xy":
            cells = f"sequence({cell_sql(f'{axis} - {num(reach)}', cell)}, {cell_sql(f'{axis} + {num(reach)}', cell)})"
            base = base.withColumn(f"c{axis}", F.explode(F.expr(cells)))
    else:
        base = with_cell(base, cell)
    return base.selectExpr(
        *keys,
        "cx",
        "cy",
        "false as inside",
        "0 as flip",
        f"{g.NO_PIECES} as ray",
        f"array({g.piece('x', 'y', 'x', 'y')}) as near",
    )


def prefixed(tiles: DataFrame, prefix: str) -> DataFrame:
    """Rename the payload so that two tile sets can meet in one join."""
    return tiles.withColumnsRenamed({c: prefix + c for c in PAYLOAD})
