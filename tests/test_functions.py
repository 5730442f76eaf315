import math

import pytest
from pyspark.sql import functions as F

from areastats.functions import numbers as n
from areastats.functions import text as t
from areastats.functions.projection import CONE, point_text, to_state_plane


def values(spark, *columns):
    return [*spark.range(1).select(*columns).first()]


def test_zero_denominator_policies(spark):
    num, zero, none = F.lit(5.0), F.lit(0.0), F.lit(None).cast("double")
    assert values(spark, n.pct(num, zero), n.pct_zero(num, zero), n.pct_zero(num, none), n.pct(num, F.lit(8))) == [
        None,
        0.0,
        None,
        62.5,
    ]


def test_rounding_rules(spark):
    half = F.lit(0.125)
    assert [str(v) for v in values(spark, n.numeric(half), n.numeric(-half))] == ["0.13", "-0.13"]
    assert values(spark, n.percent_change(F.lit(2.0), F.lit(3.0)), n.percent_change(F.lit(2.0), F.lit(0.0))) == [33.33, None]


def test_survey_numbers(spark):
    df = spark.createDataFrame([(".",), ("",), ("12",), ("-1.5",), (None,)], "v string")
    assert [r[0] for r in df.select(n.number(F.col("v"))).collect()] == [None, None, 12.0, -1.5, None]


def test_recode_and_scale(spark):
    assert values(spark, n.recode(F.lit(3), {0: 0, 3: 600}), n.recode(F.lit(9), {0: 0, 3: 600})) == [600, None]
    assert values(spark, n.scaled(F.lit(6.0), F.lit(2.0), F.lit(10.0))) == [38.0]


def test_padding_never_cuts(spark):
    assert values(spark, t.zfill(F.lit(7), 3), t.zfill(F.lit(12345), 3), t.county_code(F.lit(5), F.lit(35))) == [
        "007",
        "12345",
        "05035",
    ]


def test_short_geoid(spark):
    assert values(spark, t.short_geoid(F.lit("14000US47157000100")), t.short_geoid(F.lit("31000US32820US"))) == [
        "47157000100",
        "32820",
    ]


@pytest.mark.parametrize(
    "text, turn, once",
    [
        ("Survey, 2010-2014", "Survey, 2011-2015", "Survey, 2011-2015"),
        ("2014-2015", "2016-2016", "2015-2016"),
        ("no year", "no year", "no year"),
        ("9999", "10000", "10000"),
    ],
)
def test_roll_years(spark, text, turn, once):
    assert values(spark, t.roll_years(F.lit(text)), t.roll_years(F.lit(text), True)) == [turn, once]


def test_projection_control_values(spark):
    x, y = to_state_plane(F.lit(-86.0), F.lit(34 + 20 / 60))
    x2, y2 = to_state_plane(F.lit(-90.049), F.lit(35.1495))
    got = values(spark, x, y, x2, y2)
    assert got == pytest.approx([1968500.0, 0.0, 758351.105, 322131.124], abs=0.01)
    assert CONE == pytest.approx(0.58543973, abs=1e-8)
    assert values(spark, *to_state_plane(F.lit(float("nan")), F.lit(35.0))) == [None, None]


def test_point_text(spark):
    assert values(spark, point_text(F.lit(1.5), F.lit(2.0)), point_text(F.lit(math.nan), F.lit(2.0))) == [
        "SRID=2274;POINT(1.5 2.0)",
        None,
    ]
