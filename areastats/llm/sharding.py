"""Histogram sort: shards of near equal bytes from exactly counted splitters, and one exchange.

The sort key is (hash of the text, doc_id), so equal texts lie side by side and a group of copies of any size can be cut
between two of its documents. Each pass counts rows and bytes exactly below candidate boundaries (probes) across all
partitions, one partial aggregate of a narrow written table; only cells that still hold a splitter are probed again.
When every splitter is within the tolerance, each row finds its part from the splitters and one exchange moves it there.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from areastats.llm.common import materialise, small_frame

#: The text hash keeps 63 bits; the first pass counts 2^12 equal ranges of it.
HASH_BITS, BIN_BITS, STEP_BITS = 63, 12, 8


@dataclass
class Cell:
    """A key range with what lies before it and in it: all exact."""

    low: tuple
    high: tuple
    rows: int
    size: int
    rows_before: int = 0
    size_before: int = 0
    id: int = field(default=-1)


@dataclass
class Splitters:
    keys: list[tuple]  # the first key of part 1, 2, …
    rows_before: list[int]
    total_rows: int
    total_size: int
    passes: int
    bins: list[int]


def keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """Size, checksum and sort key of each row. The id is cut into two halves that never overflow; null ids come first."""
    text, doc_id = F.coalesce(docs["text"], F.lit("")), docs["doc_id"].cast("long")
    return docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).bitwiseAND(2**63 - 1).alias("h"),
        F.coalesce(F.shiftright(doc_id, 32), F.lit(-(2**31) - 1)).cast("long").alias("hi"),
        F.coalesce(doc_id.bitwiseAND(0xFFFFFFFF), F.lit(0)).cast("long").alias("lo"),
        *more,
    )


def bin_of() -> Column:
    return F.shiftright("h", HASH_BITS - BIN_BITS)


def sums() -> list[Column]:
    key = F.struct("h", "hi", "lo")
    return [F.count(F.lit(1)).alias("n"), F.sum("size").alias("s"), F.min(key).alias("low"), F.max(key).alias("high")]


def as_cells(rows: list, rows_before: int, size_before: int) -> list[Cell]:
    out = []
    for r in rows:
        out.append(Cell(tuple(r["low"]), tuple(r["high"]), r["n"], r["s"], rows_before, size_before))
        rows_before, size_before = rows_before + r["n"], size_before + r["s"]
    return out


def probe_plan(cell: Cell) -> dict:
    """2^8 probes at most over the first coordinate on which the cell's keys differ."""
    at = next(i for i in range(3) if cell.low[i] != cell.high[i])
    shift = max(0, (cell.high[at] - cell.low[at]).bit_length() - STEP_BITS)
    return {"cell": cell.id, "at": at, "base": cell.low[at], "shift": shift}


def find_splitters(keys: DataFrame, parts: int, tolerance: float) -> Splitters:
    """Refine the boundaries between `parts` parts of equal bytes until each is within `tolerance` of a part's bytes.

    A boundary that cannot come nearer (one row, or rows of one key) takes the nearer edge. To the driver come at most
    2^12 counts in the first pass and 2^8 for each open splitter in the later ones.
    """
    spark = keys.sparkSession
    first = sorted(keys.groupBy(bin_of().alias("bin")).agg(*sums()).collect(), key=lambda r: r["bin"])
    cells = as_cells(first, 0, 0)
    total_rows, total_size = sum(c.rows for c in cells), sum(c.size for c in cells)
    wanted = {k: total_size * k / parts for k in range(1, parts)}
    slack, done, passes = tolerance * total_size / parts, {}, 1
    within = {k: cells for k in wanted}
    while wanted and cells:
        open_cells: dict[tuple, Cell] = {}
        holds: dict[int, tuple] = {}
        for k in list(wanted):
            own, t = within[k], wanted[k]
            c = own[max(0, bisect_right([x.size_before for x in own], t) - 1)]
            left, right = t - c.size_before, c.size_before + c.size - t
            if min(left, right) <= slack or c.low == c.high:
                done[k] = (c.low, c.rows_before) if left <= right else ((*c.high[:2], c.high[2] + 1), c.rows_before + c.rows)
                del wanted[k]
            else:
                open_cells[c.low] = c
                holds[k] = c.low
        if not wanted:
            break
        for i, c in enumerate(open_cells.values()):
            c.id = i
        plans = small_frame(
            spark,
            [
                {"bin": c.low[0] >> (HASH_BITS - BIN_BITS), **probe_plan(c), "l": list(c.low), "r": list(c.high)}
                for c in open_cells.values()
            ],
            "bin bigint, cell int, at int, base bigint, shift int, l array<bigint>, r array<bigint>",
        )
        key = F.array("h", "hi", "lo")
        inside = keys.withColumn("bin", bin_of()).join(F.broadcast(plans), "bin").where((key >= F.col("l")) & (key <= F.col("r")))
        probe = F.expr("shiftright(array(h, hi, lo)[at] - base, shift)")
        found = inside.groupBy("cell", probe.alias("probe")).agg(*sums()).collect()
        passes += 1
        by_cell: dict[int, list] = {}
        for r in sorted(found, key=lambda r: (r["cell"], r["probe"])):
            by_cell.setdefault(r["cell"], []).append(r)
        finer = {c.low: as_cells(by_cell[c.id], c.rows_before, c.size_before) for c in open_cells.values()}
        within = {k: finer[low] for k, low in holds.items()}
    order = [done[k] for k in sorted(done)]
    return Splitters(
        [x[0] for x in order], [x[1] for x in order], total_rows, total_size, passes, [r["bin"] for r in first]
    )


def with_parts(keys: DataFrame, found: Splitters) -> DataFrame:
    """The part of each row: the number of splitters at or below its key, looked up by the key's bin."""
    spark = keys.sparkSession
    by_bin: dict[int, list] = {}
    for k in found.keys:
        by_bin.setdefault(k[0] >> (HASH_BITS - BIN_BITS), []).append(list(k))
    rows, before = [], 0
    for b in sorted({*found.bins, *by_bin}):
        rows.append({"bin": b, "before": before, "inside": by_bin.get(b, [])})
        before += len(by_bin.get(b, []))
    bins = small_frame(spark, rows, "bin bigint, before int, inside array<array<bigint>>")
    below = F.size(F.filter("inside", lambda s: s <= F.array("h", "hi", "lo")))
    part = (F.col("before") + below).alias("part")
    return keys.withColumn("bin", bin_of()).join(F.broadcast(bins), "bin").select(*keys.columns, part)


def histogram_sort(
    docs: DataFrame, shards: int = 40, tolerance: float = 0.001, rows_per_part: int = 200_000, rows: bool = False
) -> DataFrame:
    """Shard and slot of every row of `docs` (doc_id, text): shards of near equal bytes, slots gapless from 0.

    A shard is cut into parts of about `rows_per_part` rows, whose splitters come from the same histogram, so that no
    task sorts a whole shard. `rows=True` carries the whole input row through the exchange as struct `row`.

    Null texts count 0 bytes and hash as the empty text; null ids come first. Repeated rows are kept and get slots of
    their own; rows of one key (same text and same id) stay in one shard. Empty input gives no rows. Other columns are
    not looked at, whatever their names.
    """
    narrow = materialise(keyed(docs))
    fine = max(1, -(-narrow.count() // (shards * rows_per_part)))
    found = find_splitters(narrow, shards * fine, tolerance)
    payload = [F.struct(*[docs[c] for c in docs.columns]).alias("row")] if rows else []
    parted = with_parts(keyed(docs, *payload) if rows else narrow, found)
    start = [0, *found.rows_before]
    places = small_frame(
        docs.sparkSession,
        [{"part": p, "shard": p // fine, "start": n - start[p // fine * fine]} for p, n in enumerate(start)],
        "part int, shard int, start bigint",
    )
    inside = F.row_number().over(W.partitionBy("part").orderBy("h", "hi", "lo")) - 1
    return (
        parted.withColumn("inside", inside)
        .join(F.broadcast(places), "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("inside")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            *(["row"] if rows else []),
        )
    )
