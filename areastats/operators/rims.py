"""Shapes grown by a reach, cut into square cells with arrays: many shapes at once instead of one expression for each tile.

A tile is a shape in a cell. It is `whole` if all of the cell is in reach; else it keeps the pieces that decide in its cell: the
pieces in reach of the cell and, while an edge of a polygon may cross it (`crossed`), those a ray to the right may meet.
Seen from a small cell a piece far away is as good as its nearest point, and of several pieces mostly one decides. Tiles with
one piece are counted for all places of a cell together: the pieces are sorted by the direction in which they lie, into sectors,
and within a sector by how far the cell's centre lies inside the rim. A place takes what is surely in reach from a search in each
sector and compares only what the width of a sector leaves open.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark import cloudpickle

# Functions sent to executors travel whole, so that executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cells are halved so often at most within a group; what is left then is compared.
LEVELS = 10
#: Tiles of cells with no more places than this, or no more pairs with them, are compared place by place.
PLAIN, PAIRS = 16, 4096
#: A cell is halved while its places are more than this times the root of its tiles.
BALANCE = 24
#: So many tiles, places by sectors or comparisons are worked on at once, about.
AT_ONCE = 1 << 17


class Tiles(NamedTuple):
    """Tiles in the order of their cells, with `size` pieces each; `code` orders cells as a quadtree does."""

    code: np.ndarray
    cx: np.ndarray
    cy: np.ndarray
    weight: np.ndarray
    crossed: np.ndarray
    size: np.ndarray
    piece: np.ndarray  # x1, y1, x2, y2 of all pieces

    def take(self, at: np.ndarray) -> Tiles:
        links = ranges((np.cumsum(self.size) - self.size)[at], self.size[at])
        return Tiles(*(column[at] for column in self[:6]), self.piece[:, links])


def joined(parts: list[Tiles]) -> Tiles:
    return Tiles(*(np.concatenate(columns, axis=-1) for columns in zip(*parts, strict=True)))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each start, one after another."""
    stops = np.cumsum(sizes)
    return np.repeat(starts - (stops - sizes), sizes) + np.arange(stops[-1] if len(stops) else 0)


def running(values: np.ndarray) -> np.ndarray:
    """Sums of the first 0, 1, 2, ... values."""
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def roots(piece: np.ndarray, size: np.ndarray, weight: np.ndarray, solid: bool, cell: float, reach: float) -> list[Tiles]:
    """Tiles of shapes in cells of `cell`, 2 * cell, 4 * cell, ... (by index): one to four for each, as wide as the shape and its reach."""
    first = np.cumsum(size) - size
    low = [np.minimum.reduceat(np.minimum(piece[i], piece[i + 2]), first) - reach for i in (0, 1)]
    high = [np.maximum.reduceat(np.maximum(piece[i], piece[i + 2]), first) + reach for i in (0, 1)]
    pad = 1e-9 * (cell + reach) + 1e-12 * np.maximum.reduce([np.abs(v) for v in low + high])
    extent = np.maximum(high[0] - low[0], high[1] - low[1]) + 2 * pad
    up = np.maximum(np.ceil(np.log2(extent / cell)), 0).astype(np.int64)
    width = cell * 2.0**up
    begin, end = ([np.floor((v + s * pad) / width).astype(np.int64) for v in side] for side, s in ((low, -1), (high, 1)))
    wide, tall = end[0] - begin[0] + 1, end[1] - begin[1] + 1
    shape = np.repeat(np.arange(len(size)), wide * tall)
    index = ranges(np.zeros(len(size), np.int64), wide * tall)
    cx, cy = begin[0][shape] + index % wide[shape], begin[1][shape] + index // wide[shape]
    every = Tiles(np.zeros(len(shape), np.int64), cx, cy, weight[shape], np.full(len(shape), solid), size[shape], piece[:, ranges(first[shape], size[shape])])
    return [every.take(np.flatnonzero(up[shape] == k)) for k in range(int(up.max()) + 1)]


def cut(piece: np.ndarray, size: np.ndarray, weight: np.ndarray, solid: bool, cell: float, reach: float) -> Iterator[tuple[int, Tiles, Tiles]]:
    """From the roots of shapes down to cells of `cell`: `up`, whole tiles in cells 2 ** up times as wide, rim tiles in cells of `cell`."""
    todo = list(enumerate(roots(piece, size, weight, solid, cell, reach)))
    while todo:
        up, tiles = todo.pop()
        for at in range(0, len(tiles.cx), AT_ONCE):
            whole, rim = judged(tiles.take(np.arange(at, min(at + AT_ONCE, len(tiles.cx)))), cell * 2.0**up, reach)
            yield up, whole, rim if up == 0 else rim.take(np.arange(0))
            if up:
                todo.append((up - 1, quarters(rim)))


def quarters(tiles: Tiles) -> Tiles:
    """Each tile four times, in cells of half the width, with all of its pieces."""
    each = tiles.take(np.repeat(np.arange(len(tiles.cx)), 4))
    which = np.tile(np.arange(4), len(tiles.cx))
    return each._replace(code=each.code * 4 + which, cx=each.cx * 2 + which % 2, cy=each.cy * 2 + which // 2)


def nearest(x: np.ndarray, y: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From the nearest place of each piece to (x, y), rounded as `geometry.point_piece_sq`; and where on its line that is, not cut to the piece."""
    x1, y1, x2, y2 = piece
    dx, dy = x2 - x1, y2 - y1
    length = dx * dx + dy * dy
    along = np.divide((x - x1) * dx + (y - y1) * dy, length, out=np.zeros(len(x)), where=length > 0)
    t = np.clip(along, 0.0, 1.0)
    return x - x1 - t * dx, y - y1 - t * dy, along


def crossings(x: np.ndarray, y: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a ray from (x, y) to the right meets the piece, and whether (x, y) lies on it, as in `geometry.locate`."""
    x1, y1, x2, y2 = piece
    side = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
    on = (side == 0) & (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2)) & (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2))
    return ((y1 > y) != (y2 > y)) & ((side > 0) == (y2 > y1)) & ~on, on


def judged(tiles: Tiles, width: float, reach: float) -> tuple[Tiles, Tiles]:
    """Whole tiles, without pieces, and tiles on the rim with the pieces that still decide. Tiles out of reach end."""
    count = len(tiles.cx)
    if not count:
        return tiles, tiles
    half, tile = width / 2, np.repeat(np.arange(count), tiles.size)
    first = np.cumsum(tiles.size) - tiles.size
    mx, my = (tiles.cx + 0.5) * width, (tiles.cy + 0.5) * width
    slack = (1e-12 * (width + reach) + 1e-13 * (np.abs(mx) + np.abs(my)))[tile]
    x, y = mx[tile], my[tile]
    ex, ey, along = nearest(x, y, tiles.piece)
    d = np.sqrt(ex * ex + ey * ey)
    ux, uy = (np.divide(e, d, out=np.full(len(d), 0.5**0.5), where=d > 0) for e in (ex, ey))
    # No place of the cell is farther from the centre than `span`, towards the piece or across.
    span = half * (np.abs(ux) + np.abs(uy))
    near = d - span <= reach + slack
    whole = np.logical_or.reduceat(np.sqrt((d + span) ** 2 + span * span) + slack <= reach, first)
    keep, crossed = near, tiles.crossed
    if crossed.any():
        x1, y1, x2, y2 = tiles.piece
        edge = half + slack
        rows = (np.minimum(y1, y2) <= y + edge) & (np.maximum(y1, y2) >= y - edge) & (np.maximum(x1, x2) >= x - edge)
        meets = np.abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) <= edge * (np.abs(x2 - x1) + np.abs(y2 - y1))
        touched = crossed & np.logical_or.reduceat(rows & (np.minimum(x1, x2) <= x + edge) & meets, first)
        inside = np.add.reduceat(crossings(x, y, tiles.piece)[0].astype(np.int64), first) % 2 == 1
        whole |= crossed & ~touched & inside
        crossed = touched
        keep = near | crossed[tile] & rows
    piece = tiles.piece
    keep &= ~whole[tile]
    several = np.flatnonzero(keep & (~crossed & (np.bincount(tile[keep], minlength=count) > 1))[tile])
    if len(several):
        piece = piece.copy()
        _prune(several, tile, keep, piece, along, d, ux, uy, span, slack, half)
    size = np.bincount(tile[keep], minlength=count)
    rim = np.flatnonzero(size > 0)
    bare = np.flatnonzero(whole)
    done = Tiles(*(c[bare] for c in tiles[:4]), crossed[bare], np.zeros(len(bare), np.int64), np.empty((4, 0)))
    return done, Tiles(*(c[rim] for c in tiles[:4]), crossed[rim], size[rim], piece[:, keep])


def ends(piece: np.ndarray, along: np.ndarray, half: float) -> np.ndarray:
    """Pieces, cut to their end where all of a cell is nearest to that."""
    x1, y1, x2, y2 = piece
    dx, dy = x2 - x1, y2 - y1
    long = (dx != 0) | (dy != 0)
    swing = np.divide(half * (np.abs(dx) + np.abs(dy)) * (1 + 1e-9), dx * dx + dy * dy, out=np.zeros(len(dx)), where=long) + 1e-9
    start, stop = along + swing < 0, along - swing > 1
    return np.stack([np.where(stop, x2, x1), np.where(stop, y2, y1), np.where(start, x1, x2), np.where(start, y1, y2)])


def _prune(at, tile, keep, piece, along, d, ux, uy, span, slack, half) -> None:
    """Of the pieces `at`, cuts those to their end that are so seen, and drops those that another is nearer than all over the cell."""
    piece[:, at] = x1, y1, x2, y2 = ends(piece[:, at], along[at], half)
    end = (x1 == x2) & (y1 == y2)
    # The piece next to the centre, rather one with a length.
    rank = d[at] + np.where(end, slack[at] + 1e-9 * d[at], 0.0)
    own = tile[at]
    heads = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
    group = np.cumsum(np.append(True, own[1:] != own[:-1])) - 1
    best = np.flatnonzero(rank == np.minimum.reduceat(rank, heads)[group])
    chosen = np.empty(len(heads), np.int64)
    chosen[group[best]] = best
    to = chosen[group]
    f, e = at, at[to]
    # Distances grow with q * u at least, and by the bend more at most, where q leads from the centre to a place.
    bend = np.divide(span[e] ** 2, 2 * (d[e] - span[e]), out=np.full(len(at), np.inf), where=d[e] > span[e])
    beaten = d[f] - d[e] >= half * (np.abs(ux[f] - ux[e]) + np.abs(uy[f] - uy[e])) + bend + slack[f]
    beaten |= end & ((x1 == x1[to]) & (y1 == y1[to]) | (x1 == x2[to]) & (y1 == y2[to]))
    beaten &= to != np.arange(len(at))
    keep[at[beaten]] = False


def _spread(values: np.ndarray) -> np.ndarray:
    """The lowest bits with a gap before each."""
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        values = (values | values << shift) & mask
    return values


def counted(x: np.ndarray, y: np.ndarray, cx: np.ndarray, cy: np.ndarray, tiles: Tiles, cell: float, reach: float) -> np.ndarray:
    """Of places (x, y) in the cells (cx, cy) the sum of weights of the tiles there that have them in reach."""
    lines = np.lexsort((cy, cx))
    fresh = np.append(True, (np.diff(cx[lines]) != 0) | (np.diff(cy[lines]) != 0))
    root = np.empty(len(x), np.int64)
    root[lines] = np.cumsum(fresh) - 1
    fine, side = cell / 2**LEVELS, 1 << LEVELS
    inner = [np.clip(np.floor(v / fine).astype(np.int64) - c * side, 0, side - 1) for v, c in ((x, cx), (y, cy))]
    code = (root << 2 * LEVELS) | _spread(inner[0]) | _spread(inner[1]) << 1
    order = np.argsort(code, kind="stable")
    code, x, y = code[order], x[order], y[order]
    number = {at: i for i, at in enumerate(zip(cx[lines][fresh].tolist(), cy[lines][fresh].tolist(), strict=True))}
    change = np.flatnonzero(np.append(True, (np.diff(tiles.cx) != 0) | (np.diff(tiles.cy) != 0)))
    runs = [number.get(at, -1) for at in zip(tiles.cx[change].tolist(), tiles.cy[change].tolist(), strict=True)]
    tiles = tiles._replace(code=np.repeat(np.array(runs, np.int64), np.diff(np.append(change, len(tiles.cx)))))
    tiles = _by_cell(tiles.take(np.flatnonzero(tiles.code >= 0)))

    n, step = np.zeros(len(x), tiles.weight.dtype), np.zeros(len(x) + 1, tiles.weight.dtype)
    todo = [(0, tiles)]
    while todo:
        depth, tiles = todo.pop()
        heads = np.flatnonzero(np.append(True, np.diff(tiles.code) != 0)) if len(tiles.code) else tiles.code
        if len(tiles.code) > AT_ONCE and len(heads) > 1:
            cut = heads[max(1, np.searchsorted(heads, len(tiles.code) // 2))] if heads[-1] > len(tiles.code) // 2 else heads[-1]
            todo += [(depth, tiles.take(np.arange(cut))), (depth, tiles.take(np.arange(cut, len(tiles.code))))]
            continue
        width, many = cell / 2**depth, np.diff(np.append(heads, len(tiles.code)))
        cells = tiles.code[heads]
        start, stop = (np.searchsorted(code, (cells + i) << 2 * (LEVELS - depth)) for i in (0, 1))
        places = stop - start
        few = (places <= PLAIN) | (places * many <= PAIRS) | (depth == LEVELS)
        each = np.repeat(np.arange(len(heads)), many)
        _compare(tiles, np.flatnonzero((few & (places > 0))[each]), start[each], places[each], x, y, reach, n)
        split = np.flatnonzero(~few[each])
        one = (tiles.size == 1) & ~tiles.crossed
        ready = ~few & (places <= BALANCE * np.sqrt(np.add.reduceat(one.astype(np.int64), heads) if len(heads) else 0))
        if ready.any():
            done = np.zeros(len(each), bool)
            first = np.cumsum(tiles.size) - tiles.size
            for i in np.flatnonzero(ready):
                mine = heads[i] + np.flatnonzero(one[heads[i] : heads[i] + many[i]])
                part = slice(start[i], stop[i])
                middle = (tiles.cx[heads[i]] + 0.5) * width, (tiles.cy[heads[i]] + 0.5) * width
                more, counts = by_sectors(x[part], y[part], tiles.piece[:, first[mine]], tiles.weight[mine], *middle, width, reach)
                n[part] += more
                done[mine[counts]] = True
            split = np.flatnonzero(~few[each] & ~done)
        for at in range(0, len(split), AT_ONCE):
            whole, rim = judged(quarters(tiles.take(split[at : at + AT_ONCE])), width / 2, reach)
            for i, sign in ((0, 1), (1, -1)):
                np.add.at(step, np.searchsorted(code, (whole.code + i) << 2 * (LEVELS - depth - 1)), sign * whole.weight)
            if len(rim.code):
                todo.append((depth + 1, _by_cell(rim)))
    found = np.empty_like(n)
    found[order] = n + np.cumsum(step)[:-1]
    return found


def _by_cell(tiles: Tiles) -> Tiles:
    return tiles.take(np.argsort(tiles.code, kind="stable"))


def _compare(tiles: Tiles, at: np.ndarray, start: np.ndarray, places: np.ndarray, x: np.ndarray, y: np.ndarray, reach: float, n: np.ndarray) -> None:
    """Adds to `n` by comparing each place of a tile with each of its pieces."""
    first = np.cumsum(tiles.size) - tiles.size
    cost = np.cumsum(places[at] * tiles.size[at])
    for own in np.split(at, np.searchsorted(cost, np.arange(AT_ONCE, cost[-1] if len(cost) else 0, AT_ONCE))):
        if not len(own):
            continue
        tile, who = np.repeat(own, places[own]), ranges(start[own], places[own])
        sizes = tiles.size[tile]
        heads = np.cumsum(sizes) - sizes
        pair = np.repeat(np.arange(len(tile)), sizes)
        piece, px, py = tiles.piece[:, ranges(first[tile], sizes)], x[who][pair], y[who][pair]
        ex, ey, _ = nearest(px, py, piece)
        within = np.logical_or.reduceat(ex * ex + ey * ey <= reach * reach, heads)
        crossed = tiles.crossed[tile]
        if crossed.any():
            meets, on = crossings(px, py, piece)
            within |= crossed & ((np.add.reduceat(meets.astype(np.int64), heads) % 2 == 1) | np.logical_or.reduceat(on, heads))
        np.add.at(n, who[within], tiles.weight[tile[within]])


def by_sectors(x: np.ndarray, y: np.ndarray, piece: np.ndarray, weight: np.ndarray, mx: float, my: float, width: float, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """For the places (x, y) of the cell around (mx, my) the weight of the pieces in reach, and which pieces this counts.

    From the centre to a place q away, the distance to a piece that lies in the direction -u grows by q * u or more, and at most as
    that to a point does. Pieces too near to have a direction are left out.
    """
    n = np.zeros(len(x), weight.dtype)
    ex, ey, along = nearest(np.full(len(weight), mx), np.full(len(weight), my), piece)
    piece, d = ends(piece, along, width / 2), np.sqrt(ex * ex + ey * ey)
    used = np.flatnonzero(d > width)
    if not len(used):
        return n, used
    angle, inward = np.arctan2(ey[used], ex[used]), reach - d[used]
    order = np.argsort(angle)
    edges = np.linspace(0, len(used), max(1, int(0.6 * len(used) ** 0.5)) + 1).astype(np.int64)
    low, high = angle[order[edges[:-1]]], angle[order[edges[1:] - 1]]
    middle, turn = ((low + high) / 2)[:, None], ((high - low) / 2 + 1e-12)[:, None]
    cos, sin, more, less = np.cos(middle), np.sin(middle), np.where(turn < np.pi / 2, np.sin(turn), 1.0), 1 - np.cos(turn)
    order = order[np.lexsort((inward[order], np.repeat(np.arange(len(middle)), np.diff(edges))))]
    inward, (x1, y1, x2, y2), weight = inward[order], piece[:, used[order]], weight[used[order]]
    long, sums = (x1 != x2) | (y1 != y2), running(weight)
    slack = 1e-11 * (width + reach) + 1e-12 * (abs(mx) + abs(my))
    block = max(1, AT_ONCE // len(middle))
    for at in range(0, len(x), block):
        px, py = x[at : at + block], y[at : at + block]
        qx, qy = px - mx, py - my
        ahead, aside = qx * cos + qy * sin, np.abs(qy * cos - qx * sin)
        swing = np.abs(ahead)
        aside_most = aside + swing * more
        swing = swing * less + aside * more + slack
        room = reach * reach - aside_most**2
        sure = np.where(room > 0, ahead + swing + (reach - np.sqrt(np.maximum(room, 0.0))), np.inf)
        maybe = ahead - swing
        first, last = np.empty(maybe.shape, np.int64), np.empty(maybe.shape, np.int64)
        for j, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            first[j] = a + np.searchsorted(inward[a:b], maybe[j])
            last[j] = a + np.searchsorted(inward[a:b], sure[j])
        total = (sums[edges[1:]][:, None] - sums[last]).sum(axis=0)
        starts, sizes = first.ravel(), (last - first).ravel()
        stops = np.cumsum(sizes)
        who, link = np.repeat(np.tile(np.arange(len(px)), len(middle)), sizes), ranges(starts, sizes)
        square = (px[who] - x1[link]) ** 2 + (py[who] - y1[link]) ** 2
        far = np.flatnonzero(long[link])
        ex, ey, _ = nearest(px[who[far]], py[who[far]], np.stack([x1, y1, x2, y2])[:, link[far]])
        square[far] = ex * ex + ey * ey
        open_sums = running(np.where(square <= reach * reach, weight[link], weight.dtype.type(0)))
        total += (open_sums[stops] - open_sums[stops - sizes]).reshape(maybe.shape).sum(axis=0)
        n[at : at + block] += total
    return n, used
