"""Legend breaks: minimum and quintiles of every summary column, gaps filled in geoid order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areastats.operators.ranking import exact_quantiles, ranges, with_neighbours

QUINTILES = [0.2, 0.4, 0.6, 0.8, 1.0]
NO_LEGEND = ("geoid10", "sqmiland", "name10", "id", "geography", "table_name")
OUT = ["table_name", "column_name", "min", "q1", "q2", "q3", "q4", "q5"]


def _long(summary: DataFrame, columns: list[str]) -> DataFrame:
    doubles = [F.col(c).cast("double").alias(c) for c in columns]
    wide = summary.select("table_name", "geoid10", *doubles)
    return wide.unpivot(["table_name", "geoid10"], columns, "column_name", "v")


def _filled(placed: DataFrame) -> DataFrame:
    """Fill nulls between two values linearly by row position and trailing nulls with the last value."""
    step = F.try_divide(F.col("pos") - F.col("prev.pos"), F.col("next.pos") - F.col("prev.pos"))
    between = F.col("prev.v") + (F.col("next.v") - F.col("prev.v")) * step
    value = F.coalesce("v", F.when(F.col("next").isNotNull(), between).otherwise(F.col("prev.v")))
    return placed.select("table_name", "column_name", "geoid10", value.alias("v"))


def legend_breaks(summary: DataFrame) -> DataFrame:
    """Breaks for rows `(table_name, geoid10, columns…)` of one or several summary tables with the same columns.

    A null first row (in geoid order) is replaced by the median, inner gaps are filled linearly, trailing gaps keep the
    last value; the minimum is that of the given values. Text columns and columns without any value give zeros. The
    values are written once, in ranges of geoids, and a column of any size is filled range by range.
    """
    columns = [f for f in summary.schema.fields if f.name not in NO_LEGEND]
    numbers = [f.name for f in columns if isinstance(f.dataType, T.NumericType)]
    others = [f.name for f in columns if f.name not in numbers]
    group = ["table_name", "column_name"]
    values = ranges(_long(summary, numbers), group, ["geoid10"])
    first = F.struct(F.min("geoid10").alias("id"), F.min_by("v", "geoid10").alias("v"))
    stats = values.groupBy(*group).agg(first.alias("first"), F.min("v").alias("low"))
    # Medians are needed only of the columns whose first row is null.
    headless = stats.where("first.v is null and low is not null").select(*group, F.col("first.id").alias("first_id"))
    medians = exact_quantiles(values.join(headless, group, "left_semi"), group, "v", "geoid10", [0.5])
    heads = headless.join(medians, group).select(*group, F.col("first_id").alias("geoid10"), F.col("q")[0].alias("median"))
    led = values.join(heads, [*group, "geoid10"], "left").withColumn("v", F.coalesce("v", "median")).drop("median")
    filled = _filled(with_neighbours(led, group, "geoid10", "v"))
    breaks = exact_quantiles(filled, group, "v", "geoid10", QUINTILES)
    joined = stats.select(*group, "low").join(breaks, group, "left")
    rounded = [F.coalesce(F.bround(F.col("q")[i], 2), F.lit(0.0)).alias(f"q{i + 1}") for i in range(5)]
    out = joined.select(*group, F.coalesce(F.bround("low", 2), F.lit(0.0)).alias("min"), *rounded)
    if others:
        names = F.explode(F.array(*[F.lit(c) for c in others])).alias("column_name")
        text = summary.select("table_name").distinct().select("table_name", names)
        out = out.unionByName(text.select(*group, *[F.lit(0.0).alias(c) for c in OUT[2:]]))
    return out.select(*OUT)


def legend_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Legend rows of all summary tables."""
    parts = [legend_breaks(df.withColumn("table_name", F.lit(name))) for name, df in tables.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
