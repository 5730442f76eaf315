"""Ranks, neighbouring values and exact quantiles over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from areastats.session import materialise


def ranges(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """The rows written in range partitions of group and order, with the partition's number in `_part`.

    What follows must see one and the same partitioning, hence the written copy. A group of any size spreads over many
    ranges, which follow each other in order.
    """
    return materialise(df.repartitionByRange(*groups, *order).withColumn("_part", F.spark_partition_id()))


def with_rank(df: DataFrame, groups: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Position from 0 within each group. `order` must tell all rows of a group apart.

    The rows are ranked within their range and shifted by the counts of the ranges before; only the counts of a group
    meet in one task.
    """
    fixed = ranges(df, groups, order)
    counts = fixed.groupBy("_part", *groups).agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", *groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy("_part", *groups).orderBy(*order)) - 1
    joined = fixed.withColumn("_in", inside).join(starts, ["_part", *groups])
    return joined.select(*df.columns, (F.col("_start") + F.col("_in")).alias(name))


def with_neighbours(fixed: DataFrame, groups: list[str], order: str, value: str) -> DataFrame:
    """Position from 1 within each group (`pos`) and the nearest rows with a value before and after it (`prev`, `next`,
    each pos and v; null if there is none), for rows as `ranges` lays them out.

    Within a range, a window over its rows finds the neighbours; across ranges, one row for each range and group carries
    its count and its first and last value. So no task sees more of a group than one range, or these marks.
    """
    inner = W.partitionBy("_part", *groups).orderBy(order)
    # The next mark is the last one in backward order: a frame that runs to the end would be read again for every row.
    back = W.partitionBy("_part", *groups).orderBy(F.desc("_in"))
    rows = fixed.withColumn("_in", F.row_number().over(inner))
    mark = F.when(F.col(value).isNotNull(), F.struct(F.col("_in").alias("pos"), F.col(value).alias("v")))
    rows = rows.withColumn("_mark", mark).withColumns(
        {
            "_prev": F.last("_mark", True).over(inner.rowsBetween(W.unboundedPreceding, -1)),
            "_next": F.last("_mark", True).over(back.rowsBetween(W.unboundedPreceding, -1)),
        }
    )

    def shifted(mark: str) -> Column:
        moved = F.struct((F.col("_start") + F.col(f"{mark}.pos")).alias("pos"), F.col(f"{mark}.v").alias("v"))
        return F.when(F.col(mark).isNotNull(), moved)

    earlier, later = (W.partitionBy(*groups).orderBy(o).rowsBetween(W.unboundedPreceding, -1) for o in ("_part", F.desc("_part")))
    # Marks compare by position first, so the least and the greatest are the first and the last.
    marks = rows.groupBy("_part", *groups).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mark").alias("_first"), F.max("_mark").alias("_last")
    )
    marks = marks.withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    marks = marks.withColumns({"_first": shifted("_first"), "_last": shifted("_last")}).select(
        "_part",
        *groups,
        "_start",
        F.last("_last", True).over(earlier).alias("_far_prev"),
        F.last("_first", True).over(later).alias("_far_next"),
    )
    return rows.join(marks, ["_part", *groups]).select(
        *[c for c in fixed.columns if c != "_part"],
        (F.col("_start") + F.col("_in")).alias("pos"),
        F.coalesce(shifted("_prev"), F.col("_far_prev")).alias("prev"),
        F.coalesce(shifted("_next"), F.col("_far_next")).alias("next"),
    )


def exact_quantiles(df: DataFrame, groups: list[str], value: str, tie: str, points: list[float]) -> DataFrame:
    """Quantiles with linear interpolation as an array per group, in the order of `points`.

    Only the ranked rows next to a wanted position are joined and collected, never the values of a group.
    """
    present = df.where(F.col(value).isNotNull()).select(*groups, value, tie)
    ranked = with_rank(present, groups, [value, tie])
    sizes = ranked.groupBy(*groups).agg((F.max("rank") + 1).alias("_n"))
    spots = F.explode(
        F.expr(f"transform(array({', '.join(f'{p!r}D' for p in points)}), (p, i) -> struct(i, (_n - 1) * p as h))")
    )
    wanted = sizes.select(*groups, spots.alias("_s")).select(*groups, F.col("_s.i").alias("_i"), F.col("_s.h").alias("_h"))
    ends = wanted.select(
        *groups, "_i", "_h", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))).alias("rank")
    )
    picked = ranked.join(ends, [*groups, "rank"])
    low = F.min_by(value, "rank")
    high = F.max_by(value, "rank")
    each = picked.groupBy(*groups, "_i").agg(
        (low + (high - low) * (F.max("_h") - F.floor(F.max("_h")))).alias("_q")
    )
    rows = F.array_sort(F.collect_list(F.struct("_i", "_q")))
    return each.groupBy(*groups).agg(F.transform(rows, lambda r: r["_q"]).alias("q"))
