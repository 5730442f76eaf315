"""Versions of tables, carried years, and runs that go on where they stopped."""

import pytest
from pyspark.sql import functions as F
from world import World

from areastats.plans import indicators
from areastats.plans.catalogue import COUNTY, PLACE, TRACT, ZIP, Parameters
from areastats.plans.indicators import RUN_FIELDS, RUN_LOG, Inputs, run
from areastats.sources.versions import contents, get, get_year, put, read_log, versions


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_write_that_dies_leaves_the_version_before(spark, tmp_path):
    root = str(tmp_path)
    put(spark.range(3), root, "t", "2018")
    bad = spark.range(5).select(F.when(F.col("id") < 4, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        put(bad.repartition(3), root, "t", "2018")
    assert values(get(spark, root, "t", "2018")) == [(0,), (1,), (2,)] and versions(spark, root).count() == 1
    old = get(spark, root, "t", "2018")
    put(spark.range(1), root, "t", "2018")
    assert values(get(spark, root, "t", "2018")) == [(0,)] and old.count() == 3
    assert [r.number for r in contents(spark, root, "2018").collect()] == [2]


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, tmp_path):
    root = str(tmp_path)
    put(spark.range(3), root, "t", "2018")
    put(get(spark, root, "t", "2018").where("id > 0"), root, "t", "2018")
    assert values(get(spark, root, "t", "2018")) == [(1,), (2,)]


def test_years_carry_forward_what_they_lack(spark, tmp_path):
    root = str(tmp_path)
    for year, name, n in [("2017", "a", 17), ("2017", "b", 1), ("2018", "b", 18), ("2019", "a", 19), ("2018", "b", 81)]:
        put(spark.range(n), root, name, year)
    assert {k: df.count() for k, df in get_year(spark, root, "2018").items()} == {"a": 17, "b": 81}
    assert {k: df.count() for k, df in get_year(spark, root, "2020").items()} == {"a": 19, "b": 81}
    assert get_year(spark, root, "2016") == {} and contents(spark, root, "2019").count() == 1
    with pytest.raises(ValueError):
        get(spark, root, "b", "2019")
    assert get(spark, root, "b", "2019", carried=True).count() == 81


@pytest.fixture(scope="module")
def inputs(spark):
    full = World(spark).inputs()
    layers = {n: full.layers[n] for n in ("hospitals", "regis_foreclosures", "epa_airquality") if n in full.layers}
    return Inputs(areas=full.areas, survey={"b01003": full.survey["b01003"]}, layers=layers)


@pytest.fixture(scope="module")
def whole(inputs, tmp_path_factory):
    return values(run(inputs, str(tmp_path_factory.mktemp("whole")), "2018"))


def pairs_of(spark, root):
    log = read_log(spark, f"{root}/year=2018", RUN_LOG, RUN_FIELDS).where("source is not null")
    return {(r.source, r.indicator, r.geography): (r.run, r.step) for r in log.orderBy("run", "step").collect()}, log.count()


def test_a_run_goes_on_by_geography(spark, inputs, whole, tmp_path, monkeypatch):
    root = str(tmp_path)
    first = run(inputs, root, "2018", geographies=[COUNTY, PLACE])
    assert {r.geography for r in first.select("geography").distinct().collect()} == {COUNTY, PLACE}
    before, _ = pairs_of(spark, root)
    built = []

    def stopping(self):
        made = real(self)
        return {n: (lambda n=n: (built.append(n), made[n]())[1]) if n != "nearest" else self._lost for n in made}

    real = indicators.SourceFrames.builders
    monkeypatch.setattr(indicators.SourceFrames, "builders", stopping)
    monkeypatch.setattr(indicators.SourceFrames, "_lost", lambda self: (_ for _ in ()).throw(RuntimeError("lost")), raising=False)
    with pytest.raises(RuntimeError):
        run(inputs, root, "2018", rerun=True)
    assert "b01003" in built
    monkeypatch.undo()
    halfway, _ = pairs_of(spark, root)
    # What the old summary holds is still there.
    assert values(get(spark, root, "summary", "2018")) == values(first)
    again = run(inputs, root, "2018", rerun=True)
    after, rows = pairs_of(spark, root)
    assert values(again) == whole
    assert before.items() <= halfway.items() <= after.items() and rows == len(after)  # no pair was computed twice
    assert {g for s, _, g in set(after) - set(halfway)} >= {TRACT, ZIP} and {s for s, *_ in set(after) - set(halfway)} == {"nearest"}


def test_other_parameters_and_full_runs_start_anew(spark, inputs, whole, tmp_path):
    root = str(tmp_path)
    few = [COUNTY]
    run(inputs, root, "2018", geographies=few)
    run(inputs, root, "2018", Parameters(age_year=1999), rerun=True, geographies=few)
    log, _ = pairs_of(spark, root)
    assert {r for r, _ in log.values()} == {2}  # every pair again
    run(inputs, root, "2018", Parameters(age_year=1999), rerun=True, geographies=few)
    assert pairs_of(spark, root)[0] == log
    run(inputs, root, "2018", Parameters(age_year=1999), geographies=few)
    assert {r for r, _ in pairs_of(spark, root)[0].values()} == {3}
