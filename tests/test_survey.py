import pytest
from pyspark.sql import functions as F

from areastats.operators import survey as sv
from areastats.sources import survey_files as sf


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    home = tmp_path_factory.mktemp("survey")
    (home / "lookup.txt").write_text(
        "File ID,Table ID,Sequence,Line,Start,Cells,Total,Long Table Title,Subject\n"
        'ACSSF,B00001,0001, ,7,2 CELLS,,"TOTAL, PEOPLE\'S COUNT",Pop\n'
        "ACSSF,B00001,0001,,,,,Universe: all,\n"
        "ACSSF,B00001,0001,1,,,,Total:,\n"
        "ACSSF,B00001,0001,1.5,,,,Heading,\n"
        "ACSSF,B00001,0001,2,,,,Men,\n"
        "ACSSF,B00001,0002,3,,,,Women,\n"
        "ACSSF,B00001,0002,3,,,,Women,\n"
        "ACSSF,C27010,0003,1,,,,Skipped,\n"
    )
    (home / "positions.csv").write_text(
        "Table,Title,Restrictions,Sequence,Positions,Topics\n"
        "B00001,t,,1.0,7-8,x\nB00001,t,,0002,8-8,x\nB00001,t,,1,7-8,x\nC27010,t,,3,7-7,x\n"
    )
    for kind, add in (("e", 0), ("m", 1000)):
        (home / f"{kind}20165tn0001000.txt").write_text(
            f"ACSSF,2016{kind}5,tn,000,0001,0000001,{10 + add},.\nACSSF,2016{kind}5,tn,000,0001,0000002,{20 + add},\n"
        )
        (home / f"{kind}20165tn0002000.txt").write_text(
            f'ACSSF,2016{kind}5,tn,000,0002,0000002,9,"{21 + add}"\nACSSF,2016{kind}5,tn,000,0002,0000001,9,{11 + add}\n'
        )
    for archive in ("a", "b"):
        lines = []
        for rec, level, geoid, name in [
            ("0000001", "140", "14000US47157000100", "D'Arc, “Café”"),
            ("0000002", "860", "86000US38109", "ZCTA5 38109"),
        ]:
            row = {f: "" for f in sf.GEOHEADER_FIELDS}
            row.update(fileid="ACSSF", stusab="TN", sumlevel=level, component=".", logrecno=rec, geoid=geoid, name=f'"{name}"')
            lines.append(",".join(row[f] for f in sf.GEOHEADER_FIELDS))
        (home / f"g20165tn{archive}.csv").write_bytes(("\n".join(lines) + "\n").encode("cp1252"))
    return home


def test_lookup_to_fields(spark, files):
    fields = {r.table_id: r for r in sv.table_fields(sf.field_lookup(spark, str(files / "lookup.txt"))).collect()}
    assert fields["b00001"].table_title == "TOTAL, PEOPLE'S COUNT"
    assert [(f.field, f.comment) for f in fields["b00001"].fields] == [
        ("b00001001", "Total:"),
        ("b00001002", "Men"),
        ("b00001003", "Women"),
    ]


def test_layout_and_exclusion(spark, files):
    layout = sv.layout_index(sf.position_sheet(spark, str(files / "positions.csv")))
    assert sv.table_layout(layout, "b00001") == [("0001", 6, 8), ("0002", 7, 8)]
    assert [r.table_id for r in sv.wanted_tables(layout).collect()] == ["b00001"]


def test_raw_files_to_table(spark, files):
    sequences = {
        s: sf.sequence_cells(spark, f"{files}/[em]20165??{s}000.txt", 8).where(F.col("sequence") == s).select("cells")
        for s in ("0001", "0002")
    }
    header = sv.geoheader(sf.geoheader_csv(spark, f"{files}/g20165tn*.csv"))
    assert header.count() == 2
    fields = [("b00001001", "Total:"), ("b00001002", "Men"), ("b00001003", "Women")]
    table = sv.assemble(sequences, [("0001", 6, 8), ("0002", 7, 8)], header, fields)
    got = {(r.geoid, r.fileid): r for r in table.collect()}
    assert len(got) == 4
    first = got[("47157000100", "2016e5")]
    assert (first.name, first.stusab, first.sumlevel) == ("D'Arc, “Café”", "TN", "140")
    assert (first.b00001001, first.b00001002, first.b00001003) == (10.0, None, 11.0)
    assert got[("38109", "2016m5")].b00001003 == 1021.0
    assert table.schema["b00001002"].metadata == {"comment": "Men"}


def test_measure_comes_from_the_file_name(spark, files):
    cells = sf.sequence_cells(spark, f"{files}/[em]20165??0001000.txt", 8)
    assert {r.measure for r in cells.select("measure").distinct().collect()} == {"e", "m"}


def test_fixed_width_geoheader(spark, tmp_path):
    row = {f: "" for f in sf.OLD_GEOHEADER_FIELDS}
    row.update(fileid="ACSSF", stusab="tn", sumlevel="140", logrecno="0000001", geoid="14000US47157000100", name="Café, TN")
    text = "".join(row[f].ljust(w) for f, w in sf.GEOHEADER_WIDTHS[: len(sf.OLD_GEOHEADER_FIELDS)])
    (tmp_path / "g20095tn.txt").write_bytes((text + "\n").encode("cp1252"))
    got = sf.geoheader_fixed(spark, str(tmp_path)).first()
    assert (got.geoid, got.name, got.stusab, got.county) == ("14000US47157000100", "Café, TN", "tn", None)
    assert len(got) == 50 and len(sf.GEOHEADER_FIELDS) == 53


def test_extract_year(spark):
    rows = [
        ("47157", "050", "2016e5"),
        ("47157", "050", "2016m5"),
        ("38109", "860", "2016e5"),
        ("99999", "860", "2016e5"),
        ("32820", "310", "2016e5"),
        ("11111", "310", "2016e5"),
        ("x", "040", "2016e5"),
    ]
    table = spark.createDataFrame(rows, "geoid string, sumlevel string, fileid string")
    zips = spark.createDataFrame([("38109",), ("38109",)], "zip string")
    got = {r.geoid for r in sv.extract_year(table, zips).collect()}
    assert got == {"47157", "38109", "32820"}
    named = sv.with_geography(table).where("geoid = '32820'").first()
    assert named.geography == "cen_msa_2013"


def test_refreshed_names(spark):
    rows = [("demographics", "b01003"), ("demographics", "b17001a"), ("x", "cpgis_parks"), ("x", "c27007_old")]
    got = sv.refreshed_names(spark.createDataFrame(rows, "table_schema string, table_name string"))
    assert {r.table_name for r in got.collect()} == {"b01003", "b17001a", "c27007"}


def test_rows_of_another_length_and_broken_cells_raise(spark, tmp_path):
    wide = ",".join(["ACSSF", "2016e5", "tn", "000", "1", "0000001", *map(str, range(300))])
    (tmp_path / "e20165tn0001000.txt").write_text(wide + "\n")
    cells = sf.sequence_cells(spark, str(tmp_path / "e20165tn0001000.txt"), 306).select("cells")
    assert sv.split_sequence(cells, 6, 306).first().vals == [float(i) for i in range(300)]
    for width in (305, 307):
        with pytest.raises(Exception, match="(?i)malformed"):
            sf.sequence_cells(spark, str(tmp_path / "e20165tn0001000.txt"), width).select("cells").collect()
    broken = spark.createDataFrame([(["a", "b", "c", "d", "e", "1", "x"],)], "cells array<string>")
    with pytest.raises(Exception, match="not a number"):
        sv.split_sequence(broken, 6, 7).collect()


LAYOUT = "pos long, table_id string, sequence string, start int, end int"
NAMES = "geoid string, name string, stusab string, sumlevel string, logrecno string"


def year(spark, folder, lines, layout):
    folder.mkdir()
    for name, rows in lines.items():
        (folder / name).write_text("".join(f"{r}\n" for r in rows))
    header = spark.createDataFrame([("14000US1", "A", "TN", "140", "1"), ("14000US2", "B", "TN", "140", "2")], NAMES)
    cells = sf.year_cells(spark, f"{folder}/[em]*.txt")
    return sv.year_records(cells, spark.createDataFrame(layout, LAYOUT), header)


def test_whole_year_in_one_scan(spark, tmp_path):
    """Every table of every sequence; quoted cells, two measures, a table over two sequences, records without a part."""
    lines = {
        "e20165tn0001000.txt": ['F,2016e5,tn,000,0001,1,10,"11",.', "F,2016e5,tn,000,0001,2,20,,22", "F,2016e5,tn,000,0001,9,1,1,1"],
        "m20165tn0001000.txt": ["F,2016m5,tn,000,1,1,110,111,112"],
        "e20165tn0002000.txt": ["F,2016e5,tn,000,0002,1,30", ""],
        "g20165tn.txt": ["not a sequence"],
    }
    layout = [(1, "b1", "0001", 6, 8), (2, "b2", "0001", 8, 9), (3, "b2", "0002", 6, 7), (4, "c27010", "0002", 6, 7), (5, "b3", "0001", 7, 8)]
    records = year(spark, tmp_path / "in", lines, layout)
    assert "FileScan text" not in records._jdf.queryExecution().executedPlan().toString()  # the cells were read once
    sv.write_year(records, str(tmp_path / "out"))

    def got(table_id, n):
        rows = sv.year_table(spark, str(tmp_path / "out"), table_id, [(f"v{i}", "") for i in range(n)]).collect()
        return {(r.geoid, r.fileid): list(r)[5:] for r in rows}

    assert got("b1", 2) == {("1", "2016e5"): [10, 11], ("2", "2016e5"): [20, None], ("1", "2016m5"): [110, 111]}
    assert got("b3", 1) == {("1", "2016e5"): [11], ("2", "2016e5"): [None], ("1", "2016m5"): [111]}
    assert got("b2", 2) == {("1", "2016e5"): [None, 30]}
    assert got("c27010", 1) == {}
    with pytest.raises(Exception, match="3 fields"):
        got("b1", 3)


def test_broken_years_raise(spark, tmp_path):
    layout = [(1, "b1", "0001", 6, 7), (2, "b1", "0002", 6, 7)]
    good = {"e1.txt": ["F,2016e5,tn,000,0001,1,10"], "e2.txt": ["F,2016e5,tn,000,0002,1,30"]}
    assert year(spark, tmp_path / "good", good, layout).first().vals == [10, 30]
    for name, row, match in (("short", "F,2016e5,tn,000,0002,1", "survey row of 6"), ("long", "F,2016e5,tn,000,0002,1,2,3", "survey row of 8")):
        with pytest.raises(Exception, match=match):
            year(spark, tmp_path / name, good | {"e2.txt": [row]}, layout).collect()
    with pytest.raises(Exception, match="record twice"):
        year(spark, tmp_path / "twice", good | {"e3.txt": good["e2.txt"]}, layout).collect()


def test_short_rows_raise(spark, tmp_path):
    cells = spark.createDataFrame([(["a", "b", "c", "d", "e", "1", "2"],)], "cells array<string>")
    with pytest.raises(Exception, match="survey row of 7"):
        sv.split_sequence(cells, 6, 8).collect()
    (tmp_path / "g.csv").write_text("a,b,c\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        sf.geoheader_csv(spark, str(tmp_path)).collect()
