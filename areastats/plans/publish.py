"""Exports: CSV per geography, JSON documents per table, promotion of new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.operators.ranking import with_rank

NOT_EXPORTED = ("spatial_ref_sys", "legend_values", "data_dictionary", "data_dictionary_chng", "data_sources")
NOT_PUBLISHED = ("spatial_ref_sys", "data_sources")
PROMOTED = {
    "compiledgeographies": "geographyid",
    "geographies": "id",
    "geographylabels": "geographyid",
    "geographyvalues": "geographyid",
}


def export_name(table: str, year: str) -> str:
    """File name of a summary export: `tract_2018`, or `tract_chng` for a change table."""
    parts = table.split("_")
    return f"{parts[2]}_{year}" if len(parts) < 5 else f"{parts[2]}_{parts[-1]}"


def export_csv(tables: dict[str, DataFrame], root: str, year: str) -> list[str]:
    """Write every summary and change table as CSV with a row number; returns the folder names.

    A table is a folder of part files in the order of the row number.
    """
    written = []
    for name, df in tables.items():
        if name in NOT_EXPORTED:
            continue
        target = export_name(name, year)
        numbered = with_rank(df, [], ["geoid10"], "index").select("index", *df.columns).orderBy("index")
        numbered.write.mode("overwrite").option("header", True).csv(f"{root.rstrip('/')}/{target}.csv")
        written.append(target)
    return written


def row_json(columns: list[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def json_documents(df: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """One JSON array of row objects per group of `by` (or for the whole table), rows in `order`.

    The array is one text value per published table, because that is the published format; it holds one object per area.
    """
    by = by or []
    columns = [c for c in df.columns if c not in by]
    entry = F.struct(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)], row_json(columns).alias("_json"))
    rows = df.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    texts = F.transform("_rows", lambda r: r["_json"])
    return rows.select(*by, F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]")).alias("csv"))


def json_fragments(df: DataFrame, order: list[str], by: list[str] | None = None, size: int = 10_000) -> DataFrame:
    """The JSON arrays of `json_documents` in fragments of `size` objects: by, fragment (from 0), text.

    The fragments of a group, one after the other, are its document: the first opens the bracket, the later ones begin
    with a comma, the last one closes. No row holds more than `size` objects, however large a table is, and rows are placed
    by their rank, so no task sees a whole group. An empty table has no fragment.
    """
    by = by or []
    columns = [c for c in df.columns if c not in by]
    # The group as one struct, so that null is a group like any other and no `by` is one group.
    group = F.struct(F.lit(1).alias("one"), *by).alias("_group")
    rows = df.select(group, *[F.col(c).alias(f"_k{i}") for i, c in enumerate(order)], row_json(columns).alias("_json"))
    # Rows alike in all columns have the same text, so it does not matter which of them comes first.
    placed = with_rank(rows, ["_group"], [*[f"_k{i}" for i in range(len(order))], "_json"], "_at")
    number = F.floor(F.col("_at") / size).cast("long")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("_at", "_json"))), lambda r: r["_json"])
    parts = placed.groupBy("_group", number.alias("fragment")).agg(F.array_join(texts, ",").alias("_text"))
    last = placed.groupBy("_group").agg(F.max(number).alias("_last"))
    opening = F.when(F.col("fragment") == 0, "[").otherwise(",")
    closing = F.when(F.col("fragment") == F.col("_last"), "]").otherwise("")
    text = F.concat(opening, "_text", closing).alias("text")
    return parts.join(last, "_group").select(*[F.col("_group")[c].alias(c) for c in by], "fragment", text)


def export_json(df: DataFrame, path: str, order: list[str], size: int = 10_000) -> None:
    """Write a table as one JSON array over text files: read in the order of their names, they are the document."""
    fragments = json_fragments(df, order, size=size)
    ordered = fragments.repartitionByRange("fragment").sortWithinPartitions("fragment")
    ordered.select("text").write.mode("overwrite").text(path)


def target_of(table: str, year: str) -> tuple[str, str]:
    """(year, geotype) of the published row a table belongs to."""
    year = "chng" if table.split("_")[-1] == "chng" else year
    if table == "legend_values":
        return year, "legend"
    if "data_dictionary" in table:
        return year, "datadictionary"
    return year, table.split("_")[2]


def publish(tables: dict[str, DataFrame], geographies: DataFrame, year: str) -> DataFrame:
    """Rows (geographyid, csv) with the JSON document of each published table."""
    parts = []
    for name, df in tables.items():
        if name in NOT_PUBLISHED:
            continue
        when, geotype = target_of(name, year)
        order = [c for c in ("geoid10", "table_name", "column_name", "field") if c in df.columns] or df.columns[:1]
        document = json_documents(df, order)
        parts.append(document.select(F.lit(when).alias("year"), F.lit(geotype).alias("geotype"), "csv"))
    documents = parts[0]
    for part in parts[1:]:
        documents = documents.unionByName(part)
    ids = geographies.select(F.col("id").alias("geographyid"), "year", "geotype")
    return documents.join(ids, ["year", "geotype"]).select("geographyid", "csv")


def updated_documents(compiled: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored documents with the fresh ones in place."""
    joined = compiled.join(fresh.withColumnRenamed("csv", "_new"), "geographyid", "left")
    return joined.withColumn("csv", F.coalesce("_new", "csv")).drop("_new").select(*compiled.columns)


def new_rows(staging: DataFrame, key: str, published: DataFrame) -> DataFrame:
    """Staged rows whose geography is not published yet (`published` has the ids)."""
    known = published.select(F.col("id").alias(key)).distinct()
    return staging.where(F.col(key).isNotNull()).join(known, key, "left_anti").select(*staging.columns)


def promote(staging: dict[str, DataFrame], production: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows to append to each production table."""
    return {t: new_rows(staging[t], key, production["geographies"]) for t, key in PROMOTED.items() if t in staging}
