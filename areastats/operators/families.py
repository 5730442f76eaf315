"""Indicator families as DataFrame operators; the catalogue and the registered queries share them.

Aggregates are all of the kind Spark combines before the shuffle, so one area that holds most of the features sends one
partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.functions.numbers import ratio, real_change, scaled
from areastats.operators.counting import counts_within
from areastats.operators.spatial import (
    AREA_KEYS,
    assign,
    clipped_length,
    near_pairs,
    nearest_distance,
    representative_points,
    within,
)

FEET_PER_MILE = 5280.0


def attach(areas: DataFrame, values: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Copy columns to the areas by key; areas without a match get null, a repeated key gives its smallest row."""
    picked = values.groupBy(F.col(key).alias("_key")).agg(F.min(F.struct(*columns)).alias("_row"))
    joined = areas.join(picked, areas["geoid10"] == F.col("_key"), "left")
    return joined.select(areas["*"], *[F.col("_row")[c].alias(c) for c in columns])


def per_area(
    features: DataFrame, dim: int, tiles: DataFrame, cell: float, aggregates: list[Column], boundary: bool = False
) -> DataFrame:
    """Assign features to areas by centroid and aggregate once for all geographies."""
    return assign(features, dim, tiles, cell, boundary).groupBy(*AREA_KEYS).agg(*aggregates)


def pick_one(value: Column, order: Column) -> Column:
    """One value per area: the one with the smallest order key."""
    return F.min_by(value, order)


def share_where(condition: Column, counted: Column) -> Column:
    """Percent of the non-null `counted` rows that meet the condition."""
    return 100 * ratio(F.count_if(condition), F.count(counted))


def weighted_share(part: Column, whole: Column) -> Column:
    return 100 * ratio(F.sum(part), F.sum(whole))


def distinct_on(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """One row per key, the first by `order`; an aggregate rather than a window, so it combines before the shuffle."""
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.groupBy(*keys).agg(first.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def scale_over_layer(layer: DataFrame, value: Column, name: str) -> DataFrame:
    """Scale a value by the layer's own minimum and maximum.

    The bounds are a one-row aggregate joined back, instead of a window over the whole layer in one task.
    """
    valued = layer.withColumn("_v", value)
    bounds = valued.agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    joined = valued.join(F.broadcast(bounds))  # one row by construction
    return joined.withColumn(name, scaled(F.col("_v"), F.col("_low"), F.col("_high"))).drop("_v", "_low", "_high")


def name_match(areas: DataFrame, table: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """Values of a table whose name equals the area's name, ignoring case; one whole row where a name repeats.

    That is the row with the smallest `feature_id`, or without such ids the smallest values, nulls last.
    """
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    order = ["feature_id", *values] if "feature_id" in table.columns else values
    keyed = table.withColumn("_name", F.lower(name))
    picked = distinct_on(keyed, ["_name"], order, columns)
    return areas.join(picked, F.lower(areas["name10"]) == F.col("_name")).drop("_name")


def sidewalk_flags(streets: DataFrame, sidewalks: DataFrame, street_id: str, sidewalk_id: str) -> DataFrame:
    """Streets with `sidewalk` YES where the id occurs among the sidewalks, NO otherwise and for a null id."""
    ids = sidewalks.where(F.col(sidewalk_id).isNotNull()).select(F.col(sidewalk_id).alias("_id")).distinct()
    joined = streets.join(ids, streets[street_id] == F.col("_id"), "left")
    return joined.withColumn("sidewalk", F.when(F.col("_id").isNotNull(), "YES").otherwise("NO")).drop("_id")


def flag_share(
    features: DataFrame, dim: int, areas: DataFrame, cell: float, reach: float, flag: str = "sidewalk"
) -> DataFrame:
    """Features near each area by flag: `flag_yes`, `flag_no` and their percent `flag_pct`; 0 for an area without any."""
    shapes = ["rings"] if dim != g.POINT_DIM else ["x", "y"]
    keyed = features.select("feature_id", flag, *shapes)
    pairs = near_pairs(keyed, dim, areas.select(*AREA_KEYS, "rings"), g.POLYGON_DIM, cell, reach)
    counts = pairs.groupBy(*AREA_KEYS).agg(
        F.count_if(F.col(flag) == "YES").alias("flag_yes"), F.count_if(F.col(flag) == "NO").alias("flag_no")
    )
    joined = areas.select(*AREA_KEYS).join(counts, AREA_KEYS, "left").na.fill(0, ["flag_yes", "flag_no"])
    both = F.col("flag_yes") + F.col("flag_no")
    return joined.withColumn("flag_pct", F.when(both > 0, 100 * ratio(F.col("flag_yes"), both)).otherwise(0.0))


def pairs_within(units: DataFrame, others: DataFrame, other_dim: int, cell: float, reach: float) -> DataFrame:
    """Point units (`feature_id`, `x`, `y`) with `pairs`, the number of other features within reach, at least 1.

    The least of 1 is what counting the rows of a left join gives a unit without partner. Nothing is paired to be counted,
    and units at one place are counted once.
    """
    shape = ["x", "y"] if other_dim == g.POINT_DIM else ["rings"]
    right = others.select(F.lit(1).cast("long").alias("weight"), *shape)
    counts = counts_within(units, right, other_dim, cell, reach)
    return units.join(counts, ["x", "y"], "left").withColumn("pairs", F.coalesce("n", F.lit(1))).drop("n")


def pair_count(
    units: DataFrame, others: DataFrame, other_dim: int, tiles: DataFrame, cell: float, reach: float
) -> DataFrame:
    """Pairs of units in the area and other features within reach of the unit."""
    counted = pairs_within(units, others, other_dim, cell, reach)
    return within(counted, tiles, cell).groupBy(*AREA_KEYS).agg(F.sum("pairs").alias("pairs"))


def nearest_to_areas(
    areas: DataFrame, layers: list[tuple[DataFrame, int]], cell: float, by: str | None = None, names: list[str] | None = None
) -> DataFrame:
    """Miles from each area's centroid to the nearest feature; with `by`, for each of the layers in `names`."""
    centres = representative_points(areas.select(*AREA_KEYS, "rings"), g.POLYGON_DIM)
    if by:
        centres = centres.withColumn(by, F.explode(F.array(*[F.lit(n) for n in names])))
    keys = [by] if by else []
    dist = nearest_distance(centres, layers, cell, keys)
    return dist.select(*AREA_KEYS, *keys, (F.col("dist") / FEET_PER_MILE).alias("miles"))


def roll_up(
    fine_areas: DataFrame, fine: DataFrame, value: str, tiles: DataFrame, cell: float, by: list[str] | None = None
) -> DataFrame:
    """Mean of a fine area's value over each area that holds its centroid; null values count in the number of areas."""
    by = by or []
    centres = representative_points(fine_areas.select(*AREA_KEYS, "rings"), g.POLYGON_DIM)
    keyed = centres.join(fine, AREA_KEYS).select(
        F.col("geoid10").alias("_fine"), *by, F.col(value).alias("_v"), "x", "y"
    )
    return (
        within(keyed, tiles, cell)
        .groupBy(*AREA_KEYS, *by)
        .agg(ratio(F.sum("_v"), F.count("_fine")).alias(value))
    )


def length_per_area(lines: DataFrame, areas: DataFrame, cell: float, buffer: float = 0.5) -> DataFrame:
    """Miles of line within each area (widened by the buffer)."""
    keyed = lines.select("feature_id", "rings")
    clipped = clipped_length(keyed, areas.select(*AREA_KEYS, "rings"), cell, buffer)
    return clipped.groupBy(*AREA_KEYS).agg((F.sum("length") / FEET_PER_MILE).alias("miles"))


def summed_per_key(features: DataFrame, detail: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Features with the sum of a detail table per key; the detail is summed before it is joined."""
    totals = detail.groupBy(key).agg(F.sum(value).alias(name))
    return features.join(totals, key)


def composition_share(first: DataFrame, second: DataFrame, part: str, rest: str, name: str) -> DataFrame:
    """`part / (part + rest)` in percent for the areas that occur in both aggregates."""
    joined = first.join(second, AREA_KEYS)
    return joined.withColumn(name, 100 * ratio(F.col(part), F.col(part) + F.col(rest)))


def change_share(new: DataFrame, old: DataFrame, now: str, then: str, factor: float, name: str) -> DataFrame:
    joined = new.join(old, AREA_KEYS)
    return joined.withColumn(name, real_change(F.col(now), F.col(then), factor))


def pivot_rates(
    table: DataFrame, key: str, row: str, column: str, value: str, cells: dict[str, tuple[str, str]]
) -> DataFrame:
    """One column per (row, column) pair of codes; two values for one cell are an error, as for a scalar subquery."""
    wanted = {name: (F.col(row) == pair[0]) & (F.col(column) == pair[1]) for name, pair in cells.items()}
    aggregates = []
    for name, match in wanted.items():
        found = F.count_if(match)
        once = F.when(found <= 1, F.max(F.when(match, F.col(value))))
        twice = F.raise_error(F.lit(f"more than one value for {name}")).cast("double")
        aggregates.append(F.when(found > 1, twice).otherwise(once).alias(name))
    return table.groupBy(key).agg(*aggregates)


# Areas that parcel data cover.
COVERED_COUNTY = "47157"
COVERED_PLACES = ["4701740", "4748000", "4716420", "4749060", "4740350", "4728960", "4703440"]
COVERED_ZIPS = [
    "38109", "38107", "38127", "38002", "38125", "38112", "38104", "38106", "38120", "38115", "38053", "38138",
    "38114", "38108", "38122", "38018", "38132", "38126", "38119", "38054", "38139", "38118", "38135", "38103",
    "38141", "38028", "38017", "38133", "38134", "38111", "38131", "38036", "38152", "38117", "38016", "38128",
    "38116", "38029", "38105",
]
METRO = "32820"
DROPPED_ZIPS = ["72364", "38023"]


def covered(drop: list[str] | None = None) -> Column:
    """Areas with parcel coverage; needs no join, the list is part of the expression."""
    geography, code = F.col("geography"), F.col("geoid10")
    mask = (
        ((geography == "cen_county_2010") & (code == COVERED_COUNTY))
        | ((geography == "cen_place_2010") & code.isin(COVERED_PLACES))
        | ((geography == "cen_tract_2010") & (F.substring(code, 1, 5) == COVERED_COUNTY))
        | ((geography == "cen_zip_2010") & code.isin(COVERED_ZIPS))
        | ((geography == "cen_msa_2013") & (code == METRO))
    )
    return mask & ~code.isin(drop) if drop else mask
