"""Arithmetic with three zero-denominator policies (null, zero, guarded) and two rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMERIC = "decimal(20,2)"


def numeric(value: Column, type_: str = NUMERIC) -> Column:
    """Store a value the way a numeric(20,2) column does: two decimals, half away from zero."""
    return value.cast(type_)


def ratio(num: Column, den: Column) -> Column:
    """True division; a zero or null denominator gives null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    """Percent share, null where the denominator is zero."""
    return ratio(num, den) * 100


def pct_zero(num: Column, den: Column) -> Column:
    """Percent share, zero where the denominator is zero, null where it is null."""
    return F.when(den == 0, F.lit(0.0)).otherwise(ratio(100 * num.cast("double"), den))


def year_gap(year: int, value: Column) -> Column:
    """Years between a fixed reference year and a value such as a mean construction year."""
    return F.lit(year) - value


def real_change(new: Column, old: Column, factor: float) -> Column:
    """Percent change after bringing the old amount to new prices; both amounts are stored at two decimals first."""
    now = numeric(new).cast("double")
    then = numeric(old * F.lit(factor)).cast("double")
    return 100 * ratio(now - then, then)


def percent_change(old: Column, new: Column) -> Column:
    """Change relative to the newer value, two decimals half-even; zero in the newer year gives null."""
    old, new = old.cast("double"), new.cast("double")
    return F.bround(ratio(new - old, new) * 100, 2)


def scaled(value: Column, low: Column, high: Column) -> Column:
    """Published index scaling `100 * (v - min) / max - min` (the precedence is part of the published numbers)."""
    return ratio(100 * (value - low), high) - low


def recode(value: Column, codes: dict[int, int]) -> Column:
    """Map codes to values; anything else becomes null."""
    out = None
    for key, target in codes.items():
        out = F.when(value == key, target) if out is None else out.when(value == key, target)
    return out


def number(text: Column) -> Column:
    """A survey cell as a number: `.` and blank are missing, any other text that does not parse raises."""
    cleaned = missing(F.trim(text))
    broken = F.raise_error(F.concat(F.lit("not a number: "), cleaned)).cast("double")
    return F.coalesce(cleaned.try_cast("double"), F.when(cleaned.isNotNull(), broken))


def missing(text: Column) -> Column:
    """Survey markers for a missing value become null."""
    return F.nullif(F.nullif(text, F.lit(".")), F.lit(""))


def not_nan(value: Column) -> Column:
    """NaN counts as missing, because Spark orders it above every number."""
    return F.when(~F.isnan(value), value)
