"""Change between two years and carry-forward of a year's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from areastats.functions.numbers import percent_change
from areastats.plans.indicators import BASE_COLUMNS

NOT_COMPARED = {*BASE_COLUMNS, "id", "geography"}
NOT_SUMMARIES = ("legend_values", "spatial_ref_sys", "data_dictionary", "data_dictionary_chng", "data_sources")


def change_table(old: DataFrame, new: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Percent change of every column both years share, relative to the newer value, one row per area of the newer year.

    Columns of the newer year that are not compared stay, all null. A repeated area counts once; the aggregate picks one
    whole row, independent of row order.
    """
    keys = keys or ["geoid10"]

    def once(df: DataFrame) -> DataFrame:
        rest = [c for c in df.columns if c not in keys]
        picked = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
        return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])

    numeric = {f.name for f in new.schema.fields if isinstance(f.dataType, T.NumericType)}
    shared = [c for c in new.columns if c in old.columns and c not in NOT_COMPARED and c not in keys and c in numeric]
    before = once(old.select(*keys, *shared)).withColumnsRenamed({c: f"_old_{c}" for c in shared})
    joined = once(new).join(before, keys, "left")
    columns = [
        percent_change(F.col(f"_old_{c}"), F.col(c)).alias(c)
        if c in shared
        else F.lit(None).cast(new.schema[c].dataType).alias(c)
        for c in new.columns
        if c not in keys
    ]
    return joined.select(*keys, *columns)


def change_tables(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Change table `<name>_chng` for every summary table of the newer year."""
    return {
        f"{name}_chng": change_table(old[name], df)
        for name, df in new.items()
        if name not in NOT_SUMMARIES and not name.endswith("_chng") and name in old
    }


def carry_forward(tables_by_year: dict[str, list[str]], year: str) -> dict[str, str]:
    """Table -> newest year up to `year` that holds it, so a new year starts from the previous one."""
    out = {}
    for have in sorted(y for y in tables_by_year if y <= year):
        for table in tables_by_year[have]:
            out[table] = have
    return out


def read_year(spark, root: str, tables_by_year: dict[str, list[str]], year: str) -> dict[str, DataFrame]:
    chosen = carry_forward(tables_by_year, year)
    return {t: spark.read.parquet(f"{root.rstrip('/')}/year={y}/{t}") for t, y in chosen.items()}
