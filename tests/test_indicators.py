"""The whole catalogue on the invented region, compared with plain Python."""

import math
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F
from world import AREAS, World, inside

from areastats.plans.catalogue import COUNTY, METRO, NEAREST, PLACE, TRACT, ZIP, catalogue, output_columns
from areastats.plans.indicators import pending, run, run_list, stack, summary_table, with_row_id


@pytest.fixture(scope="module")
def world(spark):
    w = World(spark)
    w.inputs_ = w.inputs()
    return w


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("years"))


@pytest.fixture(scope="module")
def summary(world, root):
    return run(world.inputs_, root, "2018")


@pytest.fixture(scope="module")
def rows(summary):
    return {(r.geography, r.geoid10): r for r in summary.collect()}


def two(value):
    return None if value is None else Decimal(repr(float(value))).quantize(Decimal("0.01"), ROUND_HALF_UP)


def check(rows, column, expected):
    """Compare one column for all areas; one cent off is a rounding tie."""
    for a in AREAS:
        got, want = rows[(a[0], a[1])][column], two(expected(a))
        assert (got is None) == (want is None), (column, a[:2], got, want)
        assert got is None or abs(got - want) <= Decimal("0.01"), (column, a[:2], got, want)


def div(a, b):
    return None if a is None or b is None or b == 0 else a / b


def sqmi(a):
    return a[3] / 2589988


def held(world, layer, area, key=lambda r: True):
    return [r for r in world.points[layer] if inside(area, r["x"], r["y"]) and key(r)]


def total(rows, field):
    return sum(r[field] for r in rows) if rows else None


def test_catalogue_counts(spark):
    found = catalogue()
    assert len({i.name for i in found}) == 84
    assert len(output_columns(found)) == 183
    assert len(output_columns(found, COUNTY)) == 183 - 13 - 4
    assert output_columns(found)["life_exp"] == "int" and output_columns(found)["pcat_10"] == "decimal(20,0)"


def test_every_area_once_with_types(summary, rows):
    assert len(rows) == len(AREAS) == summary.count()
    assert dict(summary.dtypes)["totpop"] == "decimal(20,2)" and dict(summary.dtypes)["heart_disease"] == "int"
    assert len(summary.columns) == 183 - 1 + 5  # broadband is skipped


def test_survey_columns(world, rows):
    def line(table, n):
        return lambda a: world.survey_rows[table][(a[0], a[1])][n - 1]

    check(rows, "totpop", line("b01003", 1))
    check(rows, "pct_bl", lambda a: div(line("b02001", 3)(a), line("b02001", 1)(a)) and 100 * line("b02001", 3)(a) / line("b02001", 1)(a))
    b17 = lambda a: world.survey_rows["b17001"][(a[0], a[1])]
    check(rows, "pct_pov_65up", lambda a: div(100 * sum(b17(a)[i - 1] for i in (15, 16, 29, 30)), b17(a)[0]))
    b01 = lambda a: world.survey_rows["b01001"][(a[0], a[1])]
    check(rows, "pct_50to66", lambda a: div(100 * sum(b01(a)[i - 1] for i in [*range(16, 21), *range(40, 45)]), b01(a)[0]))
    check(rows, "pct_male", lambda a: 0 if b01(a)[0] == 0 else None if b01(a)[1] is None else 100 * b01(a)[1] / b01(a)[0])
    own, everyone = line("b25003a", 2), line("b25003", 1)
    check(rows, "pct_own_wh", lambda a: 0 if everyone(a) == 0 else None if own(a) is None else 100 * own(a) / everyone(a))
    check(rows, "hsng_density", lambda a: line("b25001", 1)(a) / sqmi(a))
    vacant, units = line("b25004", 1), line("b25001", 1)
    check(rows, "pct_hu_vcnt", lambda a: 0 if units(a) == 0 else 100 * vacant(a) / units(a))
    hisp, people = line("b03003", 3), line("b01003", 1)
    check(rows, "pct_hisp", lambda a: 0 if hisp(a) == 0 else div(100 * hisp(a), people(a)))
    assert rows[(TRACT, "47157000000")].mdn_yr_lived == 2012 - line("b25039", 1)(AREAS[5])


def test_key_joined_columns(world, rows):
    ht = {r[0]: r for r in world.tables["htaindex"]}
    check(rows, "ht_ami", lambda a: ht[a[1]][1] if a[1] in ht else None)
    rates = {(z, m, s): v for z, m, s, v in world.tables["mlgw_rates"]}
    check(rows, "grate_apt", lambda a: rates.get((a[1], "APT", "G")) if a[0] == ZIP else None)
    assert rows[(ZIP, "38109")].life_exp == 70 and rows[(COUNTY, "47157")].life_exp is None
    assert rows[(TRACT, "47157000001")].heartdis == Decimal("4.50") and rows[(ZIP, "38109")].heartdis is None
    assert rows[(PLACE, "4748000")].pct_canopy == Decimal("31.50") and rows[(PLACE, "2811111")].pct_canopy is None


def test_layer_columns(world, rows):
    totpop = lambda a: world.survey_rows["b01003"][(a[0], a[1])][0]
    hu = lambda a: world.survey_rows["b25001"][(a[0], a[1])][0]
    pick = lambda name: lambda a: min(held(world, name, a), key=lambda r: r["feature_id"], default=None)
    check(rows, "foreclose", lambda a: len(held(world, "regis_foreclosures", a)) or None)
    check(rows, "brnfld_sqmi", lambda a: div(len(held(world, "tristate_brownfield", a)) or None, sqmi(a)))
    parks = lambda a: len(held(world, "cpgis_parks", a, lambda r: r["name"] == "A")) or None
    check(rows, "park_pcap", lambda a: None if parks(a) is None or totpop(a) == 0 else parks(a) / totpop(a) * 10000)
    walk = lambda r: r["facility_class"] != "Lane"
    check(rows, "gwy_sqmi", lambda a: div(total(held(world, "mpo_bicyclefacilities", a, walk), "miles"), sqmi(a)))
    afford = lambda a: total(held(world, "hud_affordable_housing", a), "total_units")
    check(rows, "pct_afford", lambda a: None if afford(a) is None or hu(a) == 0 else 100 * afford(a) / hu(a))
    fuel = lambda a: held(world, "alternative_fuel_stations", a)
    check(rows, "elec_chg_station", lambda a: sum(r["fuel"] == "Electric" for r in fuel(a)) if fuel(a) else None)
    wet = lambda r: "Wetland" in r["wetland_type"]
    check(rows, "wetland_sqmi", lambda a: div(total(held(world, "nwi_wetlands", a, wet), "acres"), sqmi(a)))
    fed = pick("esri_fedland")
    check(rows, "fed_acre_sqmi", lambda a: fed(a) and fed(a)["sqmi"] * 640 / sqmi(a))
    emp = pick("emp_centers")
    check(rows, "pct_lowinc_job", lambda a: emp(a) and div(100 * emp(a)["ce01"], emp(a)["c000"]))
    check(rows, "pct_commercial", lambda a: emp(a) and div(100 * sum(emp(a)[f"cns{i:02d}"] for i in (7, 9, 10, 12, 13, 17, 18, 19)), emp(a)["c000"]))
    jobs = lambda a: held(world, "emp_centers", a)
    check(rows, "pct_ed", lambda a: div(100 * total(jobs(a), "cns15"), total(jobs(a), "c000")) if jobs(a) else None)
    bike = world.points["bikeability"]
    val = lambda r: r["commutebikepercnorm"] + r["intersectionnorm"] + r["bikenet_norm"] + r["bikepathlengthdensitynorm"]
    lo, hi, one = min(map(val, bike)), max(map(val, bike)), pick("bikeability")
    check(rows, "bic_index", lambda a: one(a) and (100 * (val(one(a)) - lo) / hi - lo) / sqmi(a))
    riders = defaultdict(float)
    for stop, n in world.tables["mata_ridership"]:
        riders[stop] += n
    stops = lambda a: [riders[r["stop_id"]] for r in held(world, "mata_stops", a) if r["stop_id"] in riders]
    check(rows, "rider_sqmi", lambda a: sum(stops(a)) / sqmi(a) if stops(a) else None)
    watched = lambda r: r["parameter_name"] in ("Ozone", "PM2.5 - Local")

    def days(a):
        if a[0] == COUNTY:
            near = [r for r in world.points["epa_airquality"] if r["state_code"] + r["county_code"].zfill(3) == a[1] and watched(r)]
        else:
            near = held(world, "epa_airquality", a, watched)
        return total(near, "primary_exceedance_count")

    check(rows, "days_ovr_aq_stndrd", days)
    canopy = lambda a: held(world, "tree_canopy", a)
    check(
        rows,
        "pct_imp",
        lambda a: {"4748000": 22.25}.get(a[1])
        if a[0] == PLACE
        else 100 * total(canopy(a), "impervious_acres") / (total(canopy(a), "aland10") * 0.000247105) if canopy(a) else None,
    )


COVERED = {"47157", "4748000", "38109", "32820"}


def covered(a):
    return (a[1] in COVERED and a[1] != "38023") or (a[0] == TRACT and a[1].startswith("47157"))


def test_parcel_columns(world, rows):
    spots = {r["parcelid"]: r for r in world.points["parcels"]}
    old = {r["parcelid"]: r for r in world.points["parcels_2004"]}

    def here(table, a, where=spots):
        return [r for r in world.tables[table] if r[0] in where and inside(a, where[r[0]]["x"], where[r[0]]["y"])]

    def mean_age(found):
        return 2014 - sum(r[1] for r in found) / len(found) if found else None

    check(rows, "age_comm", lambda a: mean_age(here("sca_comdat", a)) if covered(a) else None)
    check(rows, "age_sf", lambda a: mean_age(here("sca_dweldat", a)) if covered(a) else None)

    def buildings(a):
        return [*{r[:2] for r in here("sca_comdat", a) + here("sca_dweldat", a)}]

    check(rows, "age_bldg", lambda a: mean_age(buildings(a)) if covered(a) else None)

    def vacant(a):
        known = [r for r in here("sca_pardat", a) if r[1] is not None]
        return 100 * sum(r[1] == "000" for r in known) / len(known) if known and covered(a) else None

    check(rows, "pct_vac", vacant)

    def change(a):
        if not (covered(a) if a[0] == ZIP else a[1].startswith("47157")):
            return None
        now, then = here("sca_asmt", a), here("sca_asmt_2004", a, old)
        before = sum(r[1] for r in then) * 236.736 / 188.9
        return 100 * (sum(r[1] for r in now) - before) / before if now and then else None

    check(rows, "pct_chgprop", change)

    def smallest(table, field):
        out = {}
        for r in world.tables[table]:
            out[r[0]] = min(out.get(r[0], math.inf), r[field])
        return {k: v for k, v in out.items() if k in spots}

    def floor(a):
        home = [v for k, v in smallest("sca_dweldat", 2).items() if inside(a, spots[k]["x"], spots[k]["y"])]
        touch = lambda p: a[4] <= p["x"] + 100 and a[4] + a[6] >= p["x"] - 100 and a[5] <= p["y"] + 100 and a[5] + a[7] >= p["y"] - 100
        shop = [v for k, v in smallest("sca_comintext", 1).items() if touch(spots[k])]
        return 100 * sum(shop) / (sum(shop) + sum(home)) if home and shop and covered(a) else None

    check(rows, "pct_comm", floor)


def box_gap(a, x0, y0, x1, y1):
    dx = max(a[4] - x1, x0 - a[4] - a[6], 0)
    dy = max(a[5] - y1, y0 - a[5] - a[7], 0)
    return math.hypot(dx, dy)


def test_distance_columns(world, rows):
    parks = world.points["cpgis_parks"]
    edge = lambda u, p: math.hypot(max(0, abs(u["x"] - p["x"]) - 200), max(0, abs(u["y"] - p["y"]) - 200))
    pairs = lambda u: max(1, sum(edge(u, p) <= 2640 for p in parks))
    units = lambda a: held(world, "hud_affordable_housing", a)
    check(rows, "affhsgreen", lambda a: sum(map(pairs, units(a))) if units(a) else None)

    walks = {r[0] for r in world.tables["mpo_sidewalks"]} - {None}

    def sidewalk(a):
        near = [r for r in world.points["teleatlas_streets"] if box_gap(a, *r["a"], *r["b"]) <= 2]
        return 100 * sum(r["dynamap_id"] in walks for r in near) / len(near) if near else 0

    check(rows, "strtsdw_pct", sidewalk)

    def clipped(layer):
        def miles(a):
            length = 0.0
            for r in world.points[layer]:
                if box_gap(a, *r["a"], *r["b"]) == 0:
                    dx = min(r["b"][0], a[4] + a[6] + 0.5) - max(r["a"][0], a[4] - 0.5)
                    dy = min(r["b"][1], a[5] + a[7] + 0.5) - max(r["a"][1], a[5] - 0.5)
                    length += dx if r["b"][0] > r["a"][0] else dy
            return length / 5280 / sqmi(a) if length else None

        return miles

    check(rows, "mata_route_sqmi", clipped("mata_routes"))
    check(rows, "bic_sqmi", clipped("mpo_bicyclefacilities"))

    centre = lambda a: (a[4] + a[6] / 2, a[5] + a[7] / 2)
    for column, layer, code in NEAREST.values():
        spots = [r for r in world.points[layer] if code is None or r["fcode"] == code]

        def direct(a, spots=spots, layer=layer):
            if layer == "cpgis_parks":
                return min(edge(dict(zip("xy", centre(a))), r) for r in spots) / 5280
            return min(math.dist(centre(a), (r["x"], r["y"])) for r in spots) / 5280

        def value(a, direct=direct):
            if a[0] in (TRACT, ZIP):
                return direct(a)
            tracts = [t for t in AREAS if t[0] == TRACT and inside(a, *centre(t))]
            return sum(map(direct, tracts)) / len(tracts) if tracts else None

        check(rows, column, value)


def test_run_list(spark):
    found = catalogue()
    wanted = run_list(spark, found, [TRACT, ZIP])
    pairs = {tuple(r) for r in wanted.collect()}
    assert ("life_exp", ZIP) in pairs and ("life_exp", TRACT) not in pairs and ("tdh_health", TRACT) in pairs
    done = wanted.where("indicator < 'h'")
    assert {tuple(r) for r in pending(wanted, done).collect()} == {p for p in pairs if p[0] >= "h"}


def test_summary_tables_per_geography(summary):
    found = catalogue()
    tracts = summary_table(summary, TRACT, found)
    assert "heartdis" in tracts.columns and "life_exp" not in tracts.columns and tracts.count() == 5
    ids = with_row_id(summary).where(F.col("geography") == METRO).select("id").collect()
    assert [r.id for r in ids] == [1]


def test_repeated_source_row_gives_one_whole_row(spark):
    rows = [("g", "1", (1.0, 9.0)), ("g", "1", (2.0, 3.0))]
    frame = spark.createDataFrame(rows, "geography string, geoid10 string, t struct<a:double,b:double>")
    assert [tuple(r.t) for r in stack({"t": frame}).collect()] == [(2.0, 3.0)]


def test_rerun_reads_back_what_is_finished(world, root, rows):
    # Last, because it replaces the files behind `summary`.
    again = run(world.inputs_, root, "2018", rerun=True)
    assert {(r.geography, r.geoid10): r for r in again.collect()} == rows
