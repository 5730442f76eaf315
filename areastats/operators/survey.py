"""Survey table assembly: field schema, layout, sequence split and stitch, geoheader join, yearly extract."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from areastats.functions.numbers import number
from areastats.functions.text import short_geoid, zfill
from areastats.session import materialise

# File columns 2 to 6 under the names they are stored with.
RECORD_KEYS = ["fileid", "stusab", "sumlevel", "component", "logrecno"]
# Fixed value: the table that the original leaves out.
EXCLUDED_TABLES = ("c27010",)

# Public summary-level codes and the geographies they stand for.
SUMMARY_LEVELS = {
    "050": "cen_county_2010",
    "310": "cen_msa_2013",
    "160": "cen_place_2010",
    "140": "cen_tract_2010",
    "860": "cen_zip_2010",
}


def table_fields(lookup: DataFrame) -> DataFrame:
    """Fields per table: one row (table_id, table_title, fields: array<struct<pos, field, comment>>) in file order.

    Lines with a blank or fractional line number are headings; the first line of a table gives its title. A field keeps
    one entry per description.
    """
    line = F.trim("line_no")
    rows = lookup.withColumn("table_id", F.lower("table_id"))
    titles = rows.groupBy("table_id").agg(F.min_by("description", "pos").alias("table_title"))
    fields = (
        rows.where((line != "") & ~line.contains("."))
        .groupBy("table_id", F.concat("table_id", zfill(line, 3)).alias("field"), F.col("description").alias("comment"))
        .agg(F.min("pos").alias("pos"))
        .groupBy("table_id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "field", "comment"))).alias("fields"))
    )
    return titles.join(fields, "table_id")


def layout_index(sheet: DataFrame) -> DataFrame:
    """Distinct (table_id, sequence, start, end) with zero-based start, in sheet order (`pos`)."""
    parts = F.split("positions", "-")
    return (
        sheet.select(
            F.lower("table_id").alias("table_id"),
            zfill(F.col("sequence"), 4).alias("sequence"),
            (F.trim(parts[0]).cast("int") - 1).alias("start"),
            F.trim(parts[1]).cast("int").alias("end"),
            "pos",
        )
        .groupBy("table_id", "sequence", "start", "end")
        .agg(F.min("pos").alias("pos"))
    )


def split_sequence(cells: DataFrame, start: int, end: int) -> DataFrame:
    """Record keys and the value cells `start:end` of one sequence; markers for missing values become null.

    A row that ends before `end` raises.
    """
    keys = [F.col("cells")[i + 1].alias(name) for i, name in enumerate(RECORD_KEYS)]
    return cells.select(*keys, _values(F.lit(start), F.lit(end), F.size("cells") >= end).alias("vals"))


def _values(start: Column, end: Column, whole: Column) -> Column:
    """The numbers in `cells` from `start` to before `end`, counted from 0; a row that is not `whole` raises."""
    return F.when(whole, F.transform(F.slice("cells", start + 1, end - start), number)).otherwise(_short("array<double>"))


def _short(kind: str = "string") -> Column:
    text = F.concat(F.lit("survey row of "), F.size("cells").cast("string"), F.lit(" cells: "), F.array_join("cells", ","))
    return F.raise_error(text).cast(kind)


def stitch(parts: list[DataFrame]) -> DataFrame:
    """Put the values of several sequences of one table side by side, matched on the record key."""
    join_on = ["fileid", "stusab", "logrecno"]
    out = parts[0]
    for i, part in enumerate(parts[1:], 1):
        more = part.select(*join_on, F.col("vals").alias(f"_v{i}"))
        out = out.join(more, join_on)
    extra = [F.col(f"_v{i}") for i in range(1, len(parts))]
    return out.select(*RECORD_KEYS, F.concat("vals", *extra).alias("vals"))


def geoheader(raw: DataFrame) -> DataFrame:
    """One geoheader row per geoid, the smallest; the same file may come with several archives."""
    rows = raw.where(F.col("geoid").isNotNull()).groupBy("geoid").agg(F.min(F.struct(*raw.columns)).alias("_row"))
    return rows.select("_row.*")


def build_table(records: DataFrame, header: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Survey table: records joined to the geoheader, one double column per field, field comments as metadata."""
    names = _names(header)
    rec = records.select("fileid", F.col("stusab").alias("_lower"), F.col("logrecno").alias("_no"), "vals")
    joined = rec.join(names, (F.col("_rec") == F.col("_no")) & (F.lower("_state") == F.col("_lower")))
    return joined.select("geoid", "name", F.col("_state").alias("stusab"), "sumlevel", "fileid", *_columns(fields))


def _names(header: DataFrame) -> DataFrame:
    return header.select(
        short_geoid(F.col("geoid")).alias("geoid"),
        "name",
        F.col("stusab").alias("_state"),
        "sumlevel",
        F.col("logrecno").alias("_rec"),
    )


def _columns(fields: list[tuple[str, str]]) -> list[Column]:
    """One column for each field, from `vals`; another number of values raises."""
    n = F.size("vals")
    broken = F.raise_error(F.concat(F.lit(f"{len(fields)} fields, values: "), n.cast("string"))).cast("array<double>")
    vals = F.when(n == len(fields), F.col("vals")).otherwise(broken)
    return [vals[i].alias(name, metadata={"comment": comment}) for i, (name, comment) in enumerate(fields)]


def year_plan(layout: DataFrame, excluded: tuple[str, ...] = EXCLUDED_TABLES) -> DataFrame:
    """What a row of each sequence is cut into: (sequence, width, table_id, part, parts, start, end).

    `part` counts the sequences of a table in sheet order from 0. `width` is the number of cells of the sequence's rows,
    excluded tables included. Written once: its size is then measured, so that it meets the rows without moving them.
    """
    width = layout.groupBy("sequence").agg(F.max("end").alias("width"))
    own = layout.where(~F.col("table_id").isin(*excluded)).groupBy("table_id")
    own = own.agg(F.array_sort(F.collect_list(F.struct("pos", "sequence", "start", "end"))).alias("all"))
    rows = own.select("table_id", F.size("all").alias("parts"), F.posexplode("all").alias("part", "one"))
    return materialise(rows.select("table_id", "parts", "part", "one.sequence", "one.start", "one.end").join(width, "sequence"))


def year_records(cells: DataFrame, layout: DataFrame, header: DataFrame, excluded: tuple[str, ...] = EXCLUDED_TABLES) -> DataFrame:
    """All tables of a survey year: (table_id, geoid, name, stusab, sumlevel, fileid, vals), from one pass over the cells.

    `cells` holds the rows of all sequence files. Every row meets its area once, and then the layout, which hands each of
    the sequence's tables its stretch of cells; these are written once, so the files are read and cut a single time. Only
    tables over several sequences are then put together by record. A record without one of its sequences is left out, one
    that repeats raises, and so does a row of another width than the layout's.
    """
    fileid, lower, no = (F.get("cells", F.lit(1 + RECORD_KEYS.index(k))) for k in ("fileid", "stusab", "logrecno"))
    # A blank line has no sequence and meets no layout; tests of join keys may run before any filter.
    sequence = F.when(F.size("cells") > len(RECORD_KEYS), zfill(F.get("cells", F.lit(4)), 4)).when(F.array_join("cells", "") != "", _short())
    rows = cells.select(sequence.alias("sequence"), "cells", fileid.alias("fileid"), lower.alias("_lower"), no.alias("_no"))
    names = _names(header)
    rows = rows.join(names, (F.col("_no") == F.col("_rec")) & (F.col("_lower") == F.lower("_state")))
    rows = rows.join(year_plan(layout, excluded), "sequence")
    record = ["table_id", "geoid", "name", F.col("_state").alias("stusab"), "sumlevel", "fileid"]
    vals = _values(F.col("start"), F.col("end"), F.size("cells") == F.col("width"))
    rows = materialise(rows.select(*record, "_no", "_lower", "parts", "part", vals.alias("vals")))
    out = ["table_id", "geoid", "name", "stusab", "sumlevel", "fileid", "vals"]
    whole = rows.where("parts = 1").select(*out)
    found = rows.where("parts > 1").groupBy("_no", "_lower", *out[:-1], "parts").agg(F.collect_list(F.struct("part", "vals")).alias("_all"))
    twice = F.raise_error(F.concat(F.lit("record twice in table "), F.col("table_id"), F.lit(": "), F.col("_no")))
    joined = F.when(F.size("_all") > F.col("parts"), twice.cast("array<double>")).otherwise(
        F.flatten(F.transform(F.array_sort("_all"), lambda x: x["vals"]))
    )
    return whole.unionByName(found.where("size(_all) >= parts").select(*out[:-1], joined.alias("vals")))


def write_year(records: DataFrame, folder: str) -> None:
    """All tables in one job, a folder for each. Partitions hold the rows of few tables and are evened out by size, so a
    large table is spread over many files and small ones do not scatter."""
    records.hint("rebalance", "table_id").write.partitionBy("table_id").parquet(folder)


def year_table(spark: SparkSession, folder: str, table_id: str, fields: list[tuple[str, str]]) -> DataFrame:
    """One written table with a column for each field; only its own folder is read."""
    schema = "geoid string, name string, stusab string, sumlevel string, fileid string, vals array<double>, table_id string"
    rows = spark.read.schema(schema).parquet(folder).where(F.col("table_id") == table_id)
    return rows.select("geoid", "name", "stusab", "sumlevel", "fileid", *_columns(fields))


def assemble(
    sequences: dict[str, DataFrame],
    layout: Iterable[tuple[str, int, int]],
    header: DataFrame,
    fields: list[tuple[str, str]],
) -> DataFrame:
    """One survey table from its sequences: `layout` lists (sequence, start, end) in order.

    Layout and fields describe a single table, so they are plain values; the records never leave the executors.
    """
    parts = [split_sequence(sequences[seq], start, end) for seq, start, end in layout]
    return build_table(stitch(parts), header, fields)


def table_layout(layout: DataFrame, table_id: str) -> list[tuple[str, int, int]]:
    """The layout of one table as plain values."""
    rows = layout.where(F.col("table_id") == table_id).orderBy("pos").collect()
    return [(r["sequence"], r["start"], r["end"]) for r in rows]


def wanted_tables(layout: DataFrame, excluded: tuple[str, ...] = EXCLUDED_TABLES) -> DataFrame:
    return layout.where(~F.col("table_id").isin(*excluded)).select("table_id").distinct()


def refreshed_names(catalogue: DataFrame) -> DataFrame:
    """Survey tables among all table names: (table_schema, table_name) cut to the survey identifier."""
    ident = F.regexp_extract("table_name", "^([a-z][0-9]+[a-z]?)", 1)
    return catalogue.select("table_schema", ident.alias("table_name")).where(F.col("table_name") != "").distinct()


def extract_year(table: DataFrame, metro_zips: DataFrame, metro: str = "32820") -> DataFrame:
    """Estimate rows of the wanted summary levels: all counties, places and tracts, the metro area, and its ZIP areas."""
    base = table.where(F.substring("fileid", 5, 1) == "e")
    direct = base.where(
        F.col("sumlevel").isin("050", "160", "140") | ((F.col("sumlevel") == "310") & (F.col("geoid") == metro))
    )
    zips = base.where(F.col("sumlevel") == "860").join(
        metro_zips.select(F.col("zip").alias("geoid")), "geoid", "left_semi"
    )
    return direct.unionByName(zips.select(*direct.columns))


def with_geography(table: DataFrame) -> DataFrame:
    """Name the geography of each row after its summary level."""
    name = None
    for level, geography in SUMMARY_LEVELS.items():
        match = F.col("sumlevel") == level
        name = F.when(match, geography) if name is None else name.when(match, geography)
    return table.withColumn("geography", name)
