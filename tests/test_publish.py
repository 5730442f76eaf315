import json
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from areastats.plans.change import carry_forward, change_table, change_tables, read_year
from areastats.plans.legend import legend_breaks, legend_values
from areastats.plans.metadata import SEASONS, category, season
from areastats.operators.ranking import exact_quantiles, ranges, with_neighbours, with_rank
from areastats.plans.publish import export_csv, export_json, export_name, json_documents, json_fragments, promote, target_of


def test_change(spark):
    old = spark.createDataFrame([("1", 10.0, 1.0), ("1", 99.0, 1.0), ("3", 1.0, 1.0)], "geoid10 string, a double, gone double")
    new = spark.createDataFrame(
        [("1", "n", 8.0, 5.0), ("2", "n", 4.0, 5.0), ("3", "n", 0.0, 5.0)], "geoid10 string, name10 string, a double, fresh double"
    )
    got = {r.geoid10: r for r in change_table(old, new).collect()}
    assert {k: r.a for k, r in got.items()} == {"1": -25.0, "2": None, "3": None}
    assert got["1"].name10 is None and got["1"].fresh is None and change_table(old, new).columns == new.columns
    assert list(change_tables({"summary_cen_zip_2010": old}, {"summary_cen_zip_2010": new, "legend_values": new})) == [
        "summary_cen_zip_2010_chng"
    ]


def test_carry_forward(spark, tmp_path):
    have = {"2017": ["a", "b"], "2018": ["b"], "2019": ["a"]}
    assert carry_forward(have, "2018") == {"a": "2017", "b": "2018"}
    for year, names in have.items():
        for name in names:
            spark.range(int(year) - 2000).write.parquet(f"{tmp_path}/year={year}/{name}")
    assert {k: df.count() for k, df in read_year(spark, str(tmp_path), have, "2018").items()} == {"a": 17, "b": 18}


@pytest.mark.parametrize("seed", range(4))
def test_legend_matches_the_series_rules(spark, seed):
    rnd = random.Random(seed)
    ids = sorted(f"{rnd.randint(0, 99999):05d}{i:03d}" for i in range(60))
    gaps = [None if rnd.random() < 0.5 else round(rnd.uniform(0, 100), 2) for _ in ids]
    gaps[0] = None if seed % 2 else 5.0
    gaps[-1] = None
    rows = list(zip(["summary_cen_tract_2010"] * len(ids), ids, gaps, ["t"] * len(ids), [None] * len(ids)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "table_name string, geoid10 string, v double, txt string, none double")
    series = pd.Series(gaps, dtype=float)
    if np.isnan(series[0]):
        series[0] = series.median()
    filled = series.interpolate()
    got = {r.column_name: r for r in legend_breaks(df).collect()}
    want = filled.quantile([0.2, 0.4, 0.6, 0.8, 1.0]).tolist()
    have = [got["v"][f"q{i}"] for i in range(1, 6)]
    assert have == pytest.approx(want, abs=0.0051) and got["v"]["min"] == pytest.approx(series.min())
    assert [got["txt"][c] for c in ("min", "q1", "q5")] == [0.0, 0.0, 0.0] and got["none"].q3 == 0.0


@pytest.mark.parametrize("share", [0.0, 0.02, 0.5, 1.0])
def test_gaps_are_filled_across_ranges(spark, share):
    """One column whose ids share all but their last digits lies in many ranges, some of them without any value."""
    rnd = random.Random(int(share * 100))
    values = {g: [rnd.uniform(0, 9) if rnd.random() < share else None for _ in range(400)] for g in ("a", "b")}
    rows = [(g, f"47157{i:06d}", v) for g, vs in values.items() for i, v in enumerate(vs)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, id string, v double").repartition(4)
    few = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        fixed = ranges(df, ["g"], ["id"])
        parts = fixed.groupBy("g").agg(F.count_distinct("_part").alias("n")).collect()
        assert all(r.n >= 3 for r in parts)
        got = with_neighbours(fixed, ["g"], "id", "v").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", few)
    assert len(got) == len(rows) and set(got[0].asDict()) == {"g", "id", "v", "pos", "prev", "next"}
    for r in got:
        own = values[r.g]
        i = int(r.id[5:])
        before = [(j + 1, own[j]) for j in range(i) if own[j] is not None][-1:]
        after = next(([(j + 1, own[j])] for j in range(i + 1, 400) if own[j] is not None), [])
        assert r.pos == i + 1
        assert [tuple(x) for x in (r.prev, r.next) if x] == before + after


def test_no_window_holds_a_column(spark):
    """Windows over rows are cut by range; those over a whole group see one row for each range."""
    df = spark.createDataFrame([("t", "1", None), ("t", "2", 1.0)], "table_name string, geoid10 string, v double")
    plan = with_neighbours(ranges(df, ["table_name"], ["geoid10"]), ["table_name"], "geoid10", "v")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in text.split("\n") if " Window " in f" {line.lstrip(' :+-')}"]
    assert windows and all("_part" in line for line in windows)


def test_no_frame_runs_to_the_end(spark):
    """Frames that end at the last row are read again for every row, so a range would cost the square of its rows."""
    df = spark.createDataFrame([("t", "1", None), ("t", "2", 1.0)], "table_name string, geoid10 string, v double")
    plan = with_neighbours(ranges(df, ["table_name"], ["geoid10"]), ["table_name"], "geoid10", "v")
    text = plan._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in text and "unboundedfollowing" not in text


def test_legend_of_a_single_row_table(spark):
    df = spark.createDataFrame([("32820", 7.126, None)], "geoid10 string, v double, empty double")
    got = {r.column_name: r for r in legend_values({"summary_cen_msa_2013": df}).collect()}
    assert [got["v"][c] for c in ("min", "q1", "q5")] == [7.13] * 3 and got["empty"].q1 == 0.0


def test_names():
    assert export_name("summary_cen_tract_2010", "2018") == "tract_2018"
    assert export_name("summary_cen_tract_2010_chng", "2018") == "tract_chng"
    assert target_of("summary_cen_zip_2010_chng", "2018") == ("chng", "zip")
    assert target_of("legend_values", "2018") == ("2018", "legend")
    assert target_of("data_dictionary_chng", "2018") == ("chng", "datadictionary")


def test_ranks_across_partitions(spark):
    df = spark.range(5000).selectExpr("id % 3 as k", "format_string('%05d', (id * 7919) % 5000) as geoid10").repartition(6)
    got = {r.geoid10: (r.k, r["rank"]) for r in with_rank(df, ["k"], ["geoid10"]).collect()}
    want = {}
    for i in sorted(range(5000), key=lambda i: i * 7919 % 5000):
        k = i % 3
        want[f"{i * 7919 % 5000:05d}"] = (k, sum(1 for w in want.values() if w[0] == k))
    assert got == want


def test_quantiles_with_one_value_in_most_rows(spark):
    df = spark.range(3000).selectExpr("id % 2 as k", "if(id % 3 > 0, 5D, id * 7919 % 1000 / 10D) as v", "id")
    points = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {r.k: r.q for r in exact_quantiles(df, ["k"], "v", "id", points).collect()}
    for k in (0, 1):
        series = pd.Series([5.0 if i % 3 else i * 7919 % 1000 / 10 for i in range(k, 3000, 2)])
        assert got[k] == pytest.approx(series.quantile(points).tolist())


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame([("2", 1.0), ("1", None)], "geoid10 string, v double")
    assert export_csv({"summary_cen_zip_2010": df, "data_sources": df}, str(tmp_path), "2018") == ["zip_2018"]
    back = spark.read.option("header", True).csv(f"{tmp_path}/zip_2018.csv")
    assert [tuple(r) for r in back.collect()] == [("0", "1", None), ("1", "2", "1.0")]


@pytest.mark.parametrize("size", [1, 7, 20, 1_000])
def test_fragments_make_the_document(spark, size):
    rows = [(g, f"{i:03d}", None if i % 3 else 'a "q"') for g, n in (("x", 41), (None, 20), ("z", 1)) for i in range(n)]
    rows += [("x", "007", "tie"), ("x", "007", "tie"), ("x", None, "no id")]
    df = spark.createDataFrame(rows, "g string, geoid10 string, v string").repartition(3)
    documents = {r.g: r.csv for r in json_documents(df, ["geoid10"], ["g"]).collect()}
    parts = json_fragments(df, ["geoid10"], ["g"], size).orderBy("fragment").collect()
    for g, document in documents.items():
        own = [r for r in parts if r.g == g]
        assert [r.fragment for r in own] == list(range(-(-sum(x[0] == g for x in rows) // size)))
        assert "".join(r.text for r in own) == document
        assert all(r.text.count('"geoid10":') <= size for r in own)


def test_json_files_are_the_document(spark, tmp_path):
    df = spark.createDataFrame([(f"{i:03d}", i) for i in range(95)], "geoid10 string, n int").repartition(5)
    export_json(df, str(tmp_path / "t.json"), ["geoid10"], size=10)
    text = "".join(f.read_text() for f in sorted((tmp_path / "t.json").glob("part-*")))
    assert json.loads(text) == [{"geoid10": f"{i:03d}", "n": i} for i in range(95)]
    assert json_fragments(df.limit(0), ["geoid10"]).count() == 0


def test_json_keeps_nulls_and_quotes(spark):
    df = spark.createDataFrame([("2", "D'Arc \"x\"", None), ("1", "n", 1.5)], "geoid10 string, name10 string, v double")
    text = json_documents(df, ["geoid10"]).first().csv
    assert json.loads(text) == [
        {"geoid10": "1", "name10": "n", "v": 1.5},
        {"geoid10": "2", "name10": "D'Arc \"x\"", "v": None},
    ]


def test_promotion(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id long")
    staged = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "geographyid long, csv string")
    got = promote({"compiledgeographies": staged}, {"geographies": ids})["compiledgeographies"]
    assert [tuple(r) for r in got.collect()] == [(3, "b")]


def test_seasons_and_categories(spark):
    texts = [(f"x {t} y", name) for name, ts in SEASONS.items() for t in ts] + [("UxSx Green Building Council", "None")]
    df = spark.createDataFrame(texts, "source string, want string").withColumn("got", season(F.col("source")))
    assert all(r.got == r.want for r in df.collect())
    row = spark.range(1).select(category(F.lit("10")), category(F.lit("11"))).first()
    assert [*row] == ["Health & Safety", None] and not math.isnan(1.0)
