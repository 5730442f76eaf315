"""Data dictionary and the report of sources, categories and update seasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.functions.text import table_part

# Category names and the season in which a source is refreshed.
CATEGORIES = {
    "1": "Demographics",
    "2": "Community Development",
    "3": "Housing",
    "4": "Transportation",
    "5": "Environment",
    "6": "Economy & Jobs",
    "7": "Education",
    "8": "Arts & Community",
    "9": "Community Engagement",
    "10": "Health & Safety",
}
SEASONS = {
    "Winter": [
        "U.S. Green Building Council",
        "Federal Communications Commission; 08/19/2016",
        "Memphis Light, Gas, and Water",
        "Memphis Urban Area Metropolitan Planning Organization",
    ],
    "Spring": ["U.S. Environmental Protection Agency"],
    "Summer": ["Shelby County Assessor's Certified Roll", "U.S. Census Bureau; American Community Survey"],
    "Fall": [
        "Memphis Area Transit Authority",
        "National Highway Traffic Safety Administration Fatality Analysis Reporting System",
    ],
}


def category(code: Column, names: dict[str, str] | None = None) -> Column:
    out = None
    for key, name in (names or CATEGORIES).items():
        out = F.when(code == key, name) if out is None else out.when(code == key, name)
    return out


def season(source: Column, seasons: dict[str, list[str]] | None = None) -> Column:
    """First season one of whose texts occurs in the source. In these patterns a dot stands for itself."""
    out = None
    for name, texts in (seasons or SEASONS).items():
        hit = None
        for text in texts:
            hit = source.contains(text) if hit is None else hit | source.contains(text)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("None")


def data_dictionary(
    fields: DataFrame, table_titles: DataFrame, line_titles: DataFrame, layers: DataFrame
) -> DataFrame:
    """(units, field, citation, field_desc) for every summary column in `fields(field)`.

    A column whose name without the last three characters is a survey table is described as `table:line` with the
    table's citation and units; any other is looked up among the layers; else the entries are `NA`.
    """
    titles = table_titles.groupBy(F.lower("id").alias("_table")).agg(F.max("title").alias("_title"))
    lines = line_titles.where(F.col("field") != "").groupBy(F.lower("field").alias("_line")).agg(
        F.max("title").alias("_line_title")
    )
    layer = layers.groupBy(F.col("field").alias("_layer")).agg(F.max(F.struct("description", "units", "citation")).alias("_l"))
    base = fields.select("field", F.substring("field", F.lit(1), F.length("field") - 3).alias("_stem"))
    joined = (
        base.join(titles, F.col("_stem") == F.col("_table"), "left")
        .join(lines, F.col("field") == F.col("_line"), "left")
        .withColumn("_lookup", F.when(F.col("_table").isNotNull(), F.col("_stem")).otherwise(F.col("field")))
        .join(layer, F.col("_lookup") == F.col("_layer"), "left")
    )
    survey, known = F.col("_table").isNotNull(), F.col("_layer").isNotNull()

    def entry(name: str) -> Column:
        value = F.coalesce(F.col("_l")[name], F.lit(""))
        return F.when(survey | known, value).otherwise("NA")

    described = F.concat_ws(":", F.coalesce("_title", F.lit("")), F.coalesce("_line_title", F.lit("")))
    return joined.select(
        entry("units").alias("units"),
        "field",
        entry("citation").alias("citation"),
        F.when(survey, described).otherwise(entry("description")).alias("field_desc"),
    )


def source_report(
    columns: DataFrame,
    dictionary: DataFrame,
    sources: DataFrame,
    change_dictionary: DataFrame,
    categories: dict[str, str] | None = None,
    seasons: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Per described summary column: category, title, source, update season, geographies that have it, change yes/no."""
    used = columns.where(table_part(F.col("table_name"), 1) == "summary")
    areas = used.groupBy("column_name").agg(
        F.array_join(F.array_sort(F.collect_set(table_part(F.col("table_name"), 3))), ", ").alias("geography")
    )
    described = dictionary.join(sources, F.col("citation") == F.col("descid")).where(F.col("field_desc").isNotNull())
    changed = change_dictionary.select(F.col("field").alias("_changed")).distinct()
    joined = areas.join(described, F.col("column_name") == F.col("field")).join(
        changed, F.col("column_name") == F.col("_changed"), "left"
    )
    return (
        joined.select(
            "field_desc",
            category(F.col("categoryid"), categories).alias("category"),
            "title",
            "source",
            season(F.col("source"), seasons).alias("update_period"),
            "geography",
            F.when(F.col("_changed").isNotNull(), "Yes").otherwise("No").alias("change"),
        )
        .distinct()
        .orderBy("category", "field_desc")
    )
