"""Text expressions: padded codes, identifiers and year roll-forward."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def zfill(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer text stays whole (plain `lpad` would cut it)."""
    text = value.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def county_code(state: Column, county: Column) -> Column:
    """Five-digit county identifier from separate state and county codes."""
    return F.concat(zfill(state, 2), zfill(county, 3))


def short_geoid(geoid: Column) -> Column:
    """The area code after `US` in a survey identifier; the letters U and S are trimmed at both ends."""
    tail = F.substring(geoid, F.instr(geoid, "US"), F.length(geoid))
    return F.trim(tail, F.lit("US"))


def roll_years(text: Column, all_at_once: bool = False) -> Column:
    """Add one to every four-digit number in a text.

    By default each number is replaced in turn over the whole text, so `2014-2015` becomes `2016-2016`.
    With `all_at_once` every number moves by one and `2014-2015` becomes `2015-2016`.
    """
    digits = F.lit(r"([0-9]{4})")
    found = F.regexp_extract_all(text, digits, 1)
    if not all_at_once:
        return F.aggregate(
            found, text, lambda acc, y: F.replace(acc, y, (y.cast("int") + 1).cast("string"))
        )
    between = F.split(text, "[0-9]{4}")
    moved = F.transform(found, lambda y: (y.cast("int") + 1).cast("string"))
    return F.array_join(
        F.transform(between, lambda part, i: F.concat(part, F.coalesce(F.get(moved, i), F.lit("")))), ""
    )


def next_source_id(descid: Column, new: str) -> Column:
    """Replace the two-digit year at the end of a source identifier."""
    return F.concat(F.substring(descid, F.lit(1), F.length(descid) - 2), F.lit(new))


def table_part(name: Column, part: int) -> Column:
    """The n-th underscore-separated part of a table name (negative counts from the end)."""
    return F.split_part(name, F.lit("_"), F.lit(part))
