"""How many features lie within reach of each place, without making the pairs.

Points are counted by pairs of grid cells. Where all of one cell is within reach of all of the other, the cell's weight is
added once for the whole cell; where nothing is, the pair ends; only a pair of cells across the rim goes on, to the pairs of
its quarters, and few enough points are compared one by one. Once the features of a cell are a bounded number, its pairs end
too: the features lie in strips, ascending in x with running weights, so a place takes what is surely within reach from two
searches in each strip and compares only the little that the strip's height leaves open. The work thus grows with the length
of the rim, not with the number of pairs, and nothing is shuffled by pair. Lines and polygons are tiled with their reach: a tile that is wholly in
reach adds its weight to its cell, and the places of a cell are counted together with its tiles on the rim (`rims`).
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from areastats.functions import geometry as g
from areastats.functions.geometry import num
from areastats.operators import rims
from areastats.operators.tiles import dealt, with_cell
from areastats.session import materialise

# Functions sent to executors travel whole, so that executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Pairs of cells with no more pairs of points than this are compared point by point.
FEW = 4096
#: Rim cells with no more places of features than this are not split but cut into strips.
MANY = 1 << 16
#: A group has about so many places to be counted, and so many are counted at once.
PLACES, AT_ONCE = 1 << 17, 1 << 12
#: Rim tiles of cells with no more places than this are counted in one group with these.
FEW_SPOTS = 1 << 16
#: Shapes with about so many pieces are tiled at once.
SHAPE_PIECES = 1 << 13
#: A group has about so many tiles at most, and about so many places and tiles if it has several cells.
TILES, FULL = 1 << 18, 1 << 16
RIM_COLUMNS = ["cx", "cy", "up", "n", "tiles", "weight", "crossed", "size", "piece"]
DTYPES = {"bigint": np.int64, "double": np.float64}
#: Cells are halved so often at most; what is left then lies on the rim within rounding and is compared.
DEEPEST = 24


def counts_within(spots: DataFrame, others: DataFrame, dim: int, cell: float, reach: float) -> DataFrame:
    """(x, y, n) of the places in `spots` (x, y) with features within `reach`; n adds up the `weight` of `others`.

    `others` has weight and x, y or rings. Places and features without finite coordinates are not counted. An empty side
    gives no rows.
    """
    spots = spots.select("x", "y").distinct()
    parts = point_counts(spots, others, cell, reach) if dim == g.POINT_DIM else shape_counts(spots, others, dim, cell, reach)
    return reduce(DataFrame.unionByName, parts).groupBy("x", "y").agg(F.sum("n").alias("n"))


def shape_counts(spots: DataFrame, others: DataFrame, dim: int, cell: float, reach: float) -> list[DataFrame]:
    """Counts by whole cells of every width and, on the rim, by groups of cells with their tiles.

    Tiles are made of many shapes at once (`rims`). Whole tiles travel as sums by cell, tiles on the rim as arrays, a row for a
    cell and a batch of shapes. A feature has one tile in a cell and a place one cell, so no pair comes twice. Rim tiles of a cell
    with too many places for a group are quartered. Each width is written, and no join is broadcast: tiles are many more than the
    rows of the file they come from.
    """
    weight = others.schema["weight"].dataType
    kind = "bigint" if isinstance(weight, IntegralType) else "double"
    finite = "abs(x) < double('infinity') and abs(y) < double('infinity')"
    spots = materialise(spots.where(finite))
    shaped = g.frozen(dealt(others), [f"cast(coalesce(weight, 0) as {kind}) as weight"], {"_e": g.pieces(dim)})
    usable = " and ".join(f"abs(e.{c}) < double('infinity')" for c in ("x1", "y1", "x2", "y2"))
    shaped = shaped.where(f"size(_e) > 0 and forall(_e, e -> {usable})")
    level, out = materialise(shaped.mapInArrow(_tiler(dim == g.POLYGON_DIM, cell, reach), _rim_schema(kind))), []
    for depth in range(DEEPEST + 1):
        placed = with_cell(spots, cell)
        sums = level.where("tiles = 0").groupBy("cx", "cy", "up").agg(F.sum("n").alias("n"))
        each = [f"explode(sequence(shiftleft({c}, up), shiftleft({c} + 1, up) - 1)) as {c}" for c in ("cx", "cy")]
        full = sums.selectExpr(each[0], "cy", "up", "n").selectExpr("cx", each[1], "n").groupBy("cx", "cy").agg(F.sum("n").alias("n"))
        out.append(placed.join(full.hint("merge"), ["cx", "cy"]).select("x", "y", "n"))
        rim = level.where("tiles > 0").drop("n", "up")
        load = rim.groupBy("cx", "cy").agg(F.sum("tiles").alias("t"))
        load = materialise(load.join(placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("m")).hint("merge"), ["cx", "cy"]))
        crowded = load.where(f"m > {FEW_SPOTS}")
        last = depth == DEEPEST or crowded.isEmpty()
        out.append(rim_counts(placed, rim, load if last else load.where(f"m <= {FEW_SPOTS}"), cell, reach, kind))
        if last:
            return out
        rest = rim.join(crowded.select("cx", "cy").hint("merge"), ["cx", "cy"])
        cell /= 2
        level = materialise(rest.mapInArrow(_quarterer(cell, reach, kind), _rim_schema(kind)))
    return out


def _rim_schema(kind: str) -> str:
    """A whole cell, 2 ** up cells wide and tall, with the weight n of its tiles, or rim tiles of a cell as bytes of `rims.Tiles`."""
    kinds = ["bigint", "bigint", "int", kind, "bigint", *["binary"] * 4]
    return ", ".join(f"{c} {k}" for c, k in zip(RIM_COLUMNS, kinds, strict=True))


def _rows(parts: list[tuple[int, rims.Tiles, rims.Tiles]]) -> Iterator[pa.RecordBatch]:
    """Rows of `_rim_schema`: weights of whole tiles summed by cell, rim tiles put together by cell."""
    rim = _by_cell(rims.joined([tiles for _, _, tiles in parts]))
    for up in sorted({up for up, _, _ in parts}):
        whole = _by_cell(rims.joined([tiles for u, tiles, _ in parts if u == up]))
        at = _heads(whole)
        if len(at):
            blank = [pa.nulls(len(at), pa.binary())] * 4
            columns = [whole.cx[at], whole.cy[at], np.full(len(at), up, np.int32), np.add.reduceat(whole.weight, at), np.zeros(len(at), np.int64), *blank]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], RIM_COLUMNS)
    heads = _heads(rim)
    stops, links = np.append(heads[1:], len(rim.cx)), np.append(0, np.cumsum(rim.size))
    for at in range(0, len(heads), 1024):
        own = [slice(a, b) for a, b in zip(heads[at : at + 1024], stops[at : at + 1024], strict=True)]
        here = heads[at : at + 1024]
        flat = [[c[i].tobytes() for i in own] for c in (rim.weight, rim.crossed, rim.size.astype(np.int32))]
        flat.append([rim.piece[:, links[i.start] : links[i.stop]].tobytes() for i in own])
        n = pa.nulls(len(own), pa.from_numpy_dtype(rim.weight.dtype))
        columns = [rim.cx[here], rim.cy[here], np.zeros(len(own), np.int32), n, stops[at : at + 1024] - here]
        yield pa.RecordBatch.from_arrays([*map(pa.array, columns), *(pa.array(c, pa.binary()) for c in flat)], RIM_COLUMNS)


def _by_cell(tiles: rims.Tiles) -> rims.Tiles:
    return tiles.take(np.lexsort((tiles.cy, tiles.cx)))


def _heads(tiles: rims.Tiles) -> np.ndarray:
    """The first tile of each cell."""
    fresh = np.append(True, (np.diff(tiles.cx) != 0) | (np.diff(tiles.cy) != 0))
    return np.flatnonzero(fresh[: len(tiles.cx)])


def _tiles(rows: pa.Table | pa.RecordBatch, kind: str) -> rims.Tiles:
    """Rim tiles of rows of `_rim_schema`."""
    cx, cy, tiles = (np.asarray(rows[c]) for c in ("cx", "cy", "tiles"))
    weight, crossed, size = (np.frombuffer(b"".join(rows[c].to_pylist()), t) for c, t in (("weight", DTYPES[kind]), ("crossed", bool), ("size", np.int32)))
    pieces = [np.empty((4, 0)), *(np.frombuffer(b).reshape(4, -1) for b in rows["piece"].to_pylist())]
    return rims.Tiles(np.zeros(len(size), np.int64), np.repeat(cx, tiles), np.repeat(cy, tiles), weight, crossed, size.astype(np.int64), np.concatenate(pieces, axis=1))


def _batches(sizes: np.ndarray, most: int) -> list[np.ndarray]:
    """Numbers of rows in stretches with about `most` together."""
    total = np.cumsum(sizes)
    cuts = np.searchsorted(total, np.arange(most, total[-1], most), "right") if len(sizes) else []
    return [own for own in np.split(np.arange(len(sizes)), np.unique(cuts)) if len(own)]


def _tiler(solid: bool, cell: float, reach: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, sizes = np.asarray(batch["weight"]), np.asarray(pc.list_value_length(batch["_e"]), dtype=np.int64)
            stops, flat = np.append(0, np.cumsum(sizes)), batch["_e"].flatten()
            piece = np.stack([np.asarray(flat.field(c)) for c in ("x1", "y1", "x2", "y2")])
            parts, held = [], 0
            for own in _batches(sizes, SHAPE_PIECES):
                of = piece[:, stops[own[0]] : stops[own[-1] + 1]]
                for part in rims.cut(of, sizes[own], weight[own], solid, cell, reach):
                    parts.append(part)
                    held += len(part[1].cx) + len(part[2].cx)
                    if held > TILES:
                        yield from _rows(parts)
                        parts, held = [], 0
            if parts:
                yield from _rows(parts)

    return make


def _quarterer(cell: float, reach: float, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in _batches(np.asarray(batch["tiles"]), rims.AT_ONCE):
                tiles = _tiles(batch.slice(own[0], len(own)), kind)
                yield from _rows([(0, *rims.judged(rims.quarters(tiles), cell, reach))])

    return make


def rim_counts(placed: DataFrame, rim: DataFrame, load: DataFrame, cell: float, reach: float, kind: str) -> DataFrame:
    """Counts of the places of cells in `load` by their rim tiles. A crowded cell is a group, or several that share its tiles; others
    go together into groups of about as many places."""
    total = load.agg(F.sum("m").alias("m"), F.sum("t").alias("t")).first()
    size = (total.m or 0) + (total.t or 0)
    lots = min(4 * placed.sparkSession.sparkContext.defaultParallelism, 1 + size // FEW) + size // FULL
    single = f"m > {FULL // 16} or t > {FULL // 16}"
    lot = f"if({single}, xxhash64(cx, cy), pmod(xxhash64(cx, cy), {lots})) as lot"
    load = load.selectExpr("cx", "cy", f"{single} as single", lot, f"int(ceil(t / {TILES})) as shares").hint("merge")
    left = placed.join(load, ["cx", "cy"]).withColumn("share", F.expr("explode(sequence(0, shares - 1))"))
    right = rim.join(load, ["cx", "cy"]).withColumn("share", F.expr("int(pmod(xxhash64(piece), shares))"))
    keys = ["single", "lot", "share"]

    def count(lhs: pa.Table, rhs: pa.Table) -> pa.Table:
        x, y, cx, cy = (np.asarray(lhs[c]) for c in ("x", "y", "cx", "cy"))
        tiles = _tiles(rhs, kind)
        n = rims.counted(x, y, cx, cy, tiles, cell, reach)
        # A place in reach of weights of 0 only has a row too.
        ones = tiles._replace(weight=np.ones_like(tiles.weight))
        met = (n if (tiles.weight > 0).all() else rims.counted(x, y, cx, cy, ones, cell, reach)) > 0
        return pa.table({"x": x[met], "y": y[met], "n": n[met]})

    places = left.selectExpr(*keys, "cx", "cy", "double(x) as x", "double(y) as y").repartition(lots, *keys)
    right = right.select(*[F.col(k).alias(f"_{k}") for k in keys], "cx", "cy", "tiles", "weight", "crossed", "size", "piece")
    tiles = right.repartition(lots, *[f"_{k}" for k in keys])
    found = places.groupBy(*keys).cogroup(tiles.groupBy(*[f"_{k}" for k in keys])).applyInArrow(count, f"x double, y double, n {kind}")
    return found.groupBy("x", "y").agg(F.sum("n").alias("n"))


def _cells(points: DataFrame, width: float, side: str) -> DataFrame:
    """Occupied cells with their number of points, weight and bounds."""
    aggs = [F.count(F.lit(1)).alias("m"), F.sum("weight").alias("w")]
    aggs += [f(c).alias(f"{c}{i}") for c in "xy" for i, f in ((0, F.min), (1, F.max))]
    cells = with_cell(points, width).groupBy("cx", "cy").agg(*aggs)
    return cells.withColumnsRenamed({c: side + c for c in cells.columns})


# Squared distances between two cells' points, with the same rounding as between two points, so that they never disagree.
_FAR = " + ".join(f"pow(greatest(r_{c}1 - l_{c}0, l_{c}1 - r_{c}0), 2)" for c in "xy")
_GAP = " + ".join(f"pow(greatest(0D, r_{c}0 - l_{c}1, l_{c}0 - r_{c}1), 2)" for c in "xy")


def cell_pairs(left: DataFrame, right: DataFrame, width: float, reach: float, above: DataFrame | None = None) -> DataFrame:
    """Pairs of occupied cells that are not wholly out of reach, with `state`: whole, few or rim.

    Neighbouring cells of the given width, or with `above` the quarters of those pairs of twice the width.
    """
    lc, rc = _cells(left, width, "l_"), _cells(right, width, "r_")
    if above is None:
        for c in "xy":
            lc = lc.withColumn(f"r_c{c}", F.explode(F.expr(f"sequence(l_c{c} - 1, l_c{c} + 1)")))
        pairs = lc.join(rc, ["r_cx", "r_cy"])
    else:
        parents = {f"{s}_c{c}": f"{s}{c}" for s in "lr" for c in "xy"}
        pairs = above.select(*[F.col(k).alias(v) for k, v in parents.items()])
        for side, cells in (("l", lc), ("r", rc)):
            up = {f"{side}{c}": F.shiftright(f"{side}_c{c}", 1) for c in "xy"}
            pairs = pairs.join(cells.withColumns(up), list(up)).drop(*up)
    state = f"case when {_FAR} <= {num(reach * reach)} then 'whole' when l_m * r_m <= {FEW} then 'few' else 'rim' end"
    return materialise(pairs.where(f"{_GAP} <= {num(reach * reach)}").withColumn("state", F.expr(state)))


def point_counts(spots: DataFrame, others: DataFrame, cell: float, reach: float) -> list[DataFrame]:
    """Counts by whole cells of every width, between points of the cells that were compared, and by strips of rim cells.

    A width's pairs are written, so a lost executor repeats one width only; widths go on while the features of some rim pair
    are too many for strips.
    """
    finite = "abs(x) < double('infinity') and abs(y) < double('infinity')"
    left = materialise(spots.where(finite).withColumn("weight", F.lit(1).cast("long")))
    right = materialise(others.where(finite).groupBy("x", "y").agg(F.sum("weight").alias("weight")))
    width = reach * (1 + 1e-9) if reach > 0 else cell
    out, above = [], None
    for depth in range(DEEPEST + 1):
        pairs = cell_pairs(left, right, width, reach, above)
        above = pairs.where(f"state = 'rim' and r_m > {MANY}")
        last = depth == DEEPEST or above.isEmpty()
        spot = with_cell(left, width).select(F.col("cx").alias("l_cx"), F.col("cy").alias("l_cy"), "x", "y")
        whole = pairs.where("state = 'whole'").groupBy("l_cx", "l_cy").agg(F.sum("r_w").alias("n"))
        out.append(spot.join(whole, ["l_cx", "l_cy"]).select("x", "y", "n"))
        near = pairs.where(f"state = 'few' or state = 'rim' and r_m > {MANY}" if last else "state = 'few'").select("l_cx", "l_cy", "r_cx", "r_cy")
        other = with_cell(right, width).selectExpr("cx as r_cx", "cy as r_cy", "x as _x", "y as _y", "weight")
        met = near.join(spot, ["l_cx", "l_cy"]).join(other, ["r_cx", "r_cy"])
        met = met.where(f"pow(x - _x, 2) + pow(y - _y, 2) <= {num(reach * reach)}")
        out.append(met.groupBy("x", "y").agg(F.sum("weight").alias("n")))
        out.append(strip_counts(pairs.where(f"state = 'rim' and r_m <= {MANY}"), spot, other, reach))
        if last:
            return out
        width /= 2
    return out


def strip_counts(pairs: DataFrame, spot: DataFrame, other: DataFrame, reach: float) -> DataFrame:
    """Counts of the places of rim pairs, a group for each cell of features, or several where very many places meet it."""
    right = ["r_cx", "r_cy"]
    shares = pairs.groupBy(*right).agg(F.expr(f"int(ceil(sum(l_m) / {PLACES}))").alias("shares"))
    places = pairs.select("l_cx", "l_cy", *right).join(spot, ["l_cx", "l_cy"]).join(shares, right)
    places = places.selectExpr(*right, "int(pmod(xxhash64(x, y), shares)) as share", "double(x) as x", "double(y) as y")
    features = other.join(shares, right).withColumn("share", F.expr("explode(sequence(0, shares - 1))"))
    features = features.selectExpr(*right, "share", "double(_x) as _x", "double(_y) as _y", "weight")

    def count(lhs: pd.DataFrame, rhs: pd.DataFrame) -> pd.DataFrame:
        x, y = lhs["x"].to_numpy(), lhs["y"].to_numpy()
        n, hits = by_strips(x, y, rhs["_x"].to_numpy(), rhs["_y"].to_numpy(), rhs["weight"].fillna(0).to_numpy(), reach)
        return pd.DataFrame({"x": x, "y": y, "n": n})[hits > 0]

    keys = [*right, "share"]
    kind = other.schema["weight"].dataType.simpleString()
    counted = places.groupBy(*keys).cogroup(features.groupBy(*keys)).applyInPandas(count, f"x double, y double, n {kind}")
    return counted.groupBy("x", "y").agg(F.sum("n").alias("n"))


def by_strips(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For places (x, y), the weight and number of the features at (a, b) within reach.

    Strips hold equally many features, about as many strips as balance searches with comparisons. What lies nearer to the rim
    than rounding can shift is compared with the rounding of two points.
    """
    n, hits = np.zeros(len(x), dtype=weight.dtype), np.zeros(len(x), dtype=np.int64)
    order = np.argsort(b, kind="stable")
    for own in np.array_split(order, max(1, int((len(a) / 16) ** 0.5))) if len(a) else []:
        own = own[np.argsort(a[own], kind="stable")]
        strip = a[own], b[own], weight[own]
        for at in range(0, len(x), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            more, met = _in_strip(x[part], y[part], *strip, reach)
            n[part] += more
            hits[part] += met
    return n, hits


def _in_strip(x: np.ndarray, y: np.ndarray, a: np.ndarray, b: np.ndarray, weight: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    low, high, square = b.min(), b.max(), reach * reach
    near = np.maximum(np.maximum(low - y, y - high), 0.0) ** 2
    far = np.maximum(np.abs(y - low), np.abs(y - high)) ** 2
    slack = (np.abs(x) + reach) * 1e-14
    outer = square * (1 + 1e-12) - near * (1 - 1e-12)
    inner = square * (1 - 1e-12) - far * (1 + 1e-12)
    meets = outer >= 0
    outer = np.sqrt(np.maximum(outer, 0.0)) * (1 + 1e-12) + slack
    inner = np.sqrt(np.maximum(inner, 0.0)) * (1 - 1e-12) - slack
    # Of each place: first in reach, first and last surely in reach, last in reach.
    first, last = np.searchsorted(a, x - outer, "left"), np.searchsorted(a, x + outer, "right")
    last = np.where(meets, last, first)
    sure = meets & (inner > 0)
    begin = np.where(sure, np.searchsorted(a, x - inner, "left"), last)
    end = np.where(sure, np.searchsorted(a, x + inner, "right"), last)
    sums = _running(weight)
    n, hits = sums[end] - sums[begin], end - begin
    starts, sizes = np.concatenate([first, end]), np.concatenate([begin - first, last - end])
    stops = np.cumsum(sizes)
    at = np.repeat(starts - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)
    who = np.repeat(np.tile(np.arange(len(x)), 2), sizes)
    within = (x[who] - a[at]) ** 2 + (y[who] - b[at]) ** 2 <= square
    for total, values in ((n, np.where(within, weight[at], weight.dtype.type(0))), (hits, within)):
        sums = _running(values)
        total += (sums[stops] - sums[stops - sizes]).reshape(2, -1).sum(axis=0).astype(total.dtype)
    return n, hits


def _running(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values."""
    values = values.astype(np.int64) if values.dtype == bool else values
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
