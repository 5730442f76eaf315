import pytest
from pyspark.sql import functions as F

from areastats.functions import geometry as g
from areastats.operators import clean
from areastats.operators import families as fam
from areastats.operators import spatial as sp
from areastats.sources import files as io


def test_delimited_reader_keeps_codes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('State Code,Latitude,Parameter Name\n05,35.5,"PM2.5, local"\n28,,Ozone\n')
    df = io.read_air_quality(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["state_code", "latitude", "parameter_name"]
    assert [tuple(r) for r in df.collect()] == [("05", 35.5, "PM2.5, local"), ("28", None, "Ozone")]


def test_tab_separated_reader(spark, tmp_path):
    (tmp_path / "b.csv").write_text("ID\tCity\tIsConfidential\n1\tMemphis\tNo\n")
    df = io.read_green_buildings(spark, str(tmp_path / "b.csv"))
    assert [tuple(r) for r in df.collect()] == [("1", "Memphis", "No")] and df.columns[2] == "isconfidential"


def test_crash_files(spark, tmp_path):
    (tmp_path / "acc.csv").write_text("STATE,ST_CASE,LATITUDE,LONGITUD,PERSONS\n47,1,35.1,-90,2\n47,2,35.1,-90,3\n1,3,35,-90,1\n")
    (tmp_path / "pb.csv").write_text("STATE,ST_CASE\n47,1\n47,1\n1,3\n")
    out = clean.crashes(io.read_crashes(spark, str(tmp_path / "acc.csv")), io.read_ped_bike(spark, str(tmp_path / "pb.csv")))
    assert [(r.st_case, r.persons) for r in out.collect()] == [(1, 2)]
    assert {"x", "y"} <= set(out.columns) and "latitude" not in out.columns


def test_assessor_reload(spark, tmp_path):
    (tmp_path / "DWELDAT.txt").write_text("PARID,LUC,ZIP1,YRBLT,SFLA\n001,062,03810,1950,1200\n")
    (tmp_path / "ASMT.txt").write_text("PARID,RTOTAPR\n001,1000\n")
    names = [("built", n) for n in ("sca_dweldat", "sca_asmt", "sca_asmt_2004", "sca_shelby_parcels_2018", "other")]
    chosen = clean.assessor_tables(spark.createDataFrame(names, "table_schema string, table_name string"))
    assert {(r.table_name, r.file_part) for r in chosen.collect()} == {("sca_dweldat", "DWELDAT"), ("sca_asmt", "ASMT")}
    root = str(tmp_path / "out")
    assert clean.load_assessor(spark, ["sca_dweldat", "sca_asmt"], str(tmp_path), root, "2018") == ["sca_dweldat", "sca_asmt_2018"]
    row = io.read_table(spark, root, "sca_dweldat").first()
    assert (row.parid, row.luc, row.zip1, row.yrblt) == ("001", "062", "03810", 1950.0)


def test_sinks_replace_and_append(spark, tmp_path):
    df = spark.range(3)
    io.replace_table(df, str(tmp_path), "t")
    io.append_table(df, str(tmp_path), "t")
    assert io.read_table(spark, str(tmp_path), "t").count() == 6
    io.replace_table(df, str(tmp_path), "t")
    assert io.read_table(spark, str(tmp_path), "t").count() == 3


def test_column_catalogue(spark):
    got = io.column_catalogue({"b": spark.range(1)}, {"b": "demo"}).first()
    assert tuple(got) == ("demo", "b", "id", 1, "bigint")


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, "b")], "v double, k string")
    assert [r.v for r in io.without_nan(df).collect()] == [None, 1.0]


def test_region_lists():
    assert len(clean.CITIES) == 53 and len(clean.COUNTIES) == 8 and len(clean.COUNTY_GEOIDS) == 8


def test_roll_sources_default_list(spark):
    source = "U.S. Census Bureau; American Community Survey, 2010-2014"
    rows = [("d", "acs16", source, "t", "1"), ("d", "acs15", source, "t", "1"), ("d", "oth16", "Other 2016", "t", "2")]
    df = spark.createDataFrame(rows, "description string, descid string, source string, title string, categoryid string")
    got = clean.roll_sources(df).collect()
    assert [(r.descid, r.source) for r in got] == [("acs17", "U.S. Census Bureau; American Community Survey, 2011-2015")]
    rest = clean.roll_sources(df, limit=False).collect()
    assert [(r.descid, r.source) for r in rest] == [("oth17", "Other 2016")]


def test_sidewalk_flags_with_nulls(spark):
    streets = spark.createDataFrame([(1,), (2,), (None,)], "dynamap_id int")
    walks = spark.createDataFrame([(1,), (1,), (None,)], "teleatlas_id int")
    got = [(r.dynamap_id, r.sidewalk) for r in fam.sidewalk_flags(streets, walks, "dynamap_id", "teleatlas_id").collect()]
    assert sorted(got, key=str) == sorted([(1, "YES"), (2, "NO"), (None, "NO")], key=str)


def test_pivot_rejects_two_values_for_a_cell(spark):
    df = spark.createDataFrame([("z", "RES", "K", 1.0), ("z", "RES", "K", 2.0)], "zip string, meter string, scat string, v double")
    with pytest.raises(Exception, match="more than one value"):
        fam.pivot_rates(df, "zip", "meter", "scat", "v", {"krate_res": ("RES", "K")}).collect()


def test_attach_takes_one_whole_row(spark):
    areas = spark.createDataFrame([("1",), ("2",)], "geoid10 string")
    values = spark.createDataFrame([("1", 5.0, "b"), ("1", 4.0, "z")], "geoid string, v double, w string")
    got = {r.geoid10: (r.v, r.w) for r in fam.attach(areas, values, "geoid", ["v", "w"]).collect()}
    assert got == {"1": (4.0, "z"), "2": (None, None)}


def test_zips_in_metro(spark):
    def square(x, y, s):
        return [(0, False, [(x, y), (x + s, y), (x + s, y + s), (x, y + s)])]

    rows = [("msa", "32820", square(0.0, 0.0, 100.0)), ("msa", "1", square(200.0, 0.0, 100.0))]
    rows += [("zip", "in", square(80.0, 10.0, 30.0)), ("zip", "out", square(90.0, 10.0, 30.0)), ("zip", "else", square(210.0, 10.0, 5.0))]
    df = spark.createDataFrame(rows, f"geography string, geoid10 string, rings {g.RINGS_TYPE}")
    metro = sp.area_tiles(df.where("geography = 'msa'"), 30.0)
    assert [r.zip for r in sp.zips_within(df.where("geography = 'zip'"), metro, 30.0).collect()] == ["in"]
    assert df.where(F.col("geoid10") == "in").count() == 1
