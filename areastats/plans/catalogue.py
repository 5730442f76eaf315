"""The indicator catalogue: 84 indicators, 183 columns, as data.

An indicator names its source, the measures taken per area at that source, and its output columns as expressions over
one row per area. In outputs `src("b25004")` is the source's row (null where the area has none there).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from areastats.functions.numbers import NUMERIC, pct, pct_zero, ratio, real_change, recode, year_gap
from areastats.operators.families import DROPPED_ZIPS, covered, pick_one, share_where, weighted_share

COUNTY, METRO, PLACE, TRACT, ZIP = (
    "cen_county_2010",
    "cen_msa_2013",
    "cen_place_2010",
    "cen_tract_2010",
    "cen_zip_2010",
)
GEOGRAPHIES = [COUNTY, METRO, PLACE, TRACT, ZIP]
SKIPPED = ("broadband",)


@dataclass(frozen=True)
class Parameters:
    """Constants an annual run may change."""

    age_year: int = 2014
    tenure_year: int = 2012
    price_factor: float = 236.736 / 188.9
    cell: float = 5280.0
    fine_cell: float = 2640.0
    park_reach: float = 2640.0
    street_reach: float = 2.0
    clip_buffer: float = 0.5


@dataclass(frozen=True)
class Indicator:
    name: str
    family: str
    source: str
    measures: dict[str, Column]
    outputs: dict[str, Column]
    type: str = NUMERIC
    only: tuple[str, ...] = ()
    needs: tuple[str, ...] = ()
    also: tuple[str, ...] = ()


def src(source: str, measure: str | None = None) -> Column:
    row = F.col(f"`{source}`")
    return row if measure is None else row[measure]


def _lines(table: str, numbers: list[int]) -> Column:
    total = F.col(f"{table}{numbers[0]:03d}")
    for n in numbers[1:]:
        total = total + F.col(f"{table}{n:03d}")
    return total


def _direct(name, family, source, columns: dict[str, Column], **kw) -> Indicator:
    """Measures that are the outputs themselves."""
    return Indicator(name, family, source, columns, {c: src(source, c) for c in columns}, **kw)


def _copy(name: str, source: str, columns: dict[str, str], **kw) -> Indicator:
    return _direct(name, "F1", source, {c: F.col(v) for c, v in columns.items()}, **kw)


RACES = {"a": "wh", "b": "bl", "c": "ai", "d": "as", "e": "nh", "f": "ot", "g": "2m", "i": "hp"}


def survey_indicators(p: Parameters) -> list[Indicator]:
    out = [
        _copy("tot_pop", "b01003", {"totpop": "b01003001"}),
        _copy("hhinc", "b19013", {"hhinc": "b19013001"}),
        _direct(
            "pct_race",
            "F2",
            "b02001",
            {
                f"pct_{s}": pct(F.col(f"b0200100{i}"), F.col("b02001001"))
                for i, s in enumerate(["wh", "bl", "ai", "as", "nh", "ot", "2m"], 2)
            },
        ),
    ]
    poverty = {
        "to14": [4, 5, 6, 7, 18, 19, 20, 21],
        "15to17": [8, 9, 22, 23],
        "18to24": [10, 24],
        "25to34": [11, 25],
        "35to44": [12, 26],
        "45to54": [13, 27],
        "55to64": [14, 28],
        "65up": [15, 16, 29, 30],
    }
    out.append(
        _direct(
            "pct_poverty",
            "F2",
            "b17001",
            {f"pct_pov_{k}": pct(_lines("b17001", v), F.col("b17001001")) for k, v in poverty.items()},
        )
    )
    for letter, suffix in {"": "tot", **RACES}.items():
        table = f"b17001{letter}"
        share = pct(F.col(f"{table}002"), F.col(f"{table}001"))
        out.append(_direct("pct_poverty_race", "F2", table, {f"pct_pov_{suffix}": share}))
    out.append(
        _direct(
            "pct_by_sex",
            "F3",
            "b01001",
            {
                "pct_male": pct_zero(F.col("b01001002"), F.col("b01001001")),
                "pct_female": pct_zero(F.col("b01001026"), F.col("b01001001")),
            },
        )
    )
    span = lambda a, b: [*range(a, b + 1), *range(a + 24, b + 25)]  # noqa: E731  (male lines, then female lines)
    ages = {
        "to14": span(3, 5),
        "15to19": span(6, 7),
        "20to24": span(8, 10),
        "25to34": span(11, 12),
        "35to49": span(13, 15),
        "50to66": span(16, 20),
        "67up": span(21, 25),
    }
    out.append(
        _direct(
            "pct_age",
            "F2",
            "b01001",
            {f"pct_{k}": pct(_lines("b01001", v), F.col("b01001001")) for k, v in ages.items()},
        )
    )
    out += [
        Indicator(
            "housing_density",
            "F1",
            "b25001",
            {"_units": F.col("b25001001")},
            {"hsng_density": ratio(src("b25001", "_units"), F.col("sqmiland"))},
        ),
        _copy("housing_units", "b25001", {"hu": "b25001001"}),
        _copy("mdn_house_price", "b25077", {"mdnhprice": "b25077001"}),
        _copy("mdn_gross_rent", "b25064", {"mdngrrent": "b25064001"}),
        Indicator(
            "hsng_vac_rate",
            "F3",
            "b25004",
            {"_vacant": F.col("b25004001")},
            {
                "pct_hu_vcnt": F.when(
                    src("b25004").isNotNull(), pct_zero(src("b25004", "_vacant"), F.col("hu"))
                )
            },
            needs=("hu",),
        ),
        _direct("pct_own", "F3", "b25003", {"pct_own": pct_zero(F.col("b25003002"), F.col("b25003001"))}),
        _direct("pct_rent", "F2", "b25003", {"pct_rent": pct(F.col("b25003003"), F.col("b25003001"))}),
        Indicator("pct_own_race", "F3", "b25003", {"_households": F.col("b25003001")}, {}),
    ]
    for letter, suffix in RACES.items():
        table = f"b25003{letter}"
        share = F.when(
            src(table).isNotNull() & src("b25003").isNotNull(),
            pct_zero(src(table, "_own"), src("b25003", "_households")),
        )
        out.append(
            Indicator("pct_own_race", "F3", table, {"_own": F.col(f"{table}002")}, {f"pct_own_{suffix}": share})
        )
    out += [
        _direct(
            "pct_mf",
            "F3",
            "b25032",
            {"pct_mf": pct_zero(_lines("b25032", list(range(16, 22))), F.col("b25032001"))},
        ),
        _direct(
            "mdn_yr_lived",
            "F4",
            "b25039",
            {"mdn_yr_lived": year_gap(p.tenure_year, F.col("b25039001"))},
            type="double",
        ),
        _direct(
            "travel_time",
            "F2",
            "b08303",
            {f"b08303{i:03d}": pct(F.col(f"b08303{i:03d}"), F.col("b08303001")) for i in range(2, 14)},
        ),
        _direct(
            "travel_mode",
            "F2",
            "b08301",
            {
                f"b08301{i:03d}": pct(F.col(f"b08301{i:03d}"), F.col("b08301001"))
                for i in (2, 10, 16, 18, 19, 20)
            },
        ),
        _direct("snap_receipt", "F2", "b19058", {"pct_snap": pct(F.col("b19058002"), F.col("b19058001"))}),
        _copy("avg_hours_worked", "b23020", {"avg_hours": "b23020001"}),
        _direct(
            "pct_labor_force",
            "F3",
            "b23025",
            {"pct_labor_force": pct_zero(F.col("b23025002"), F.col("b23025001"))},
        ),
        _direct("pct_unemp", "F3", "b23025", {"pct_unemp": pct_zero(F.col("b23025005"), F.col("b23025002"))}),
        _direct(
            "ed_attain",
            "F3",
            "b15003",
            {
                f"pct_b15003{i:03d}": pct_zero(F.col(f"b15003{i:03d}"), F.col("b15003001"))
                for i in range(16, 26)
            },
        ),
        _direct(
            "medicaid_pop",
            "F3",
            "c27007",
            {"pct_medicaid": pct_zero(_lines("c27007", [4, 7, 10, 14, 17, 20]), F.col("c27007001"))},
        ),
        Indicator(
            "hisp_pop",
            "F3",
            "b03003",
            {"_hisp": F.col("b03003003")},
            {
                "pct_hisp": F.when(src("b03003", "_hisp") == 0, F.lit(0.0)).otherwise(
                    pct(src("b03003", "_hisp"), F.col("totpop"))
                )
            },
            needs=("totpop",),
        ),
    ]
    incomes = {"a": "wh", "b": "b", "c": "na", "d": "as", "e": "nh", "f": "ot", "g": "2r", "i": "hp"}
    for letter, suffix in incomes.items():
        out.append(_copy("mdnhhinc_race", f"b19013{letter}", {f"mdnhhinc_{suffix}": f"b19013{letter}001"}))
    return out


def keyed_indicators(p: Parameters) -> list[Indicator]:
    mortality = ["heart_disease", "neoplasm", "cerebrovascular", "lower_resp", "diabetes", "alzheimers"]
    tract_health = ["births11_15", "deaths10_14", "neoplasms", "heartdis"]
    rates = ["krate_res", "krate_apt", "grate_res", "grate_apt", "wrate_res", "wrate_apt"]
    band = recode(F.col("pcat_10x1"), {0: 0, 1: 200, 2: 400, 3: 600, 4: 800, 5: 1000})
    return [
        _copy("hsng_trans_burden", "htaindex", {"ht_ami": "ht_ami"}),
        _copy("vmt", "htaindex", {"vmt_per_hh_ami": "vmt_per_hh_ami"}),
        _copy("car_own", "htaindex", {"autos_per_hh_ami": "autos_per_hh_ami"}),
        _copy("job_access", "htaindex", {"emp_ovrll_ndx": "emp_ovrll_ndx"}),
        _copy("emp_mix", "htaindex", {"emp_ndx": "emp_ndx"}),
        _direct("broadband", "F19", "fcc_broadband", {"pcat_10": band}, type="decimal(20,0)"),
        _copy("life_exp", "schd_life_exp_0913", {"life_exp": "life_exp"}, type="int", only=(ZIP,)),
        _copy("mortality", "schd_mortality_0913", {c: c for c in mortality}, type="int", only=(ZIP,)),
        _copy("tdh_health", "tdh_indicators", {c: c for c in tract_health}, only=(TRACT,)),
        _direct("mlgw_rates", "F20", "mlgw_rates", {c: F.col(c) for c in rates}, only=(ZIP,)),
    ]


# Key column of each key-joined table.
KEY_COLUMNS = {
    "htaindex": "geoid",
    "fcc_broadband": "tractcode",
    "schd_life_exp_0913": "zipcode",
    "schd_mortality_0913": "zipcode",
    "tdh_indicators": "geoid",
    "mlgw_rates": "zip",
}

RATE_CELLS = {
    "krate_res": ("RES", "K"),
    "krate_apt": ("APT", "K"),
    "grate_res": ("RES", "G"),
    "grate_apt": ("APT", "G"),
    "wrate_res": ("RES", "W"),
    "wrate_apt": ("APT", "W"),
}

EXCLUDED_PARK = "Wapanocca National Wildlife Refuge"
WALKING_CLASSES = ["Shared Use Path", "Walking Path"]
POLLUTANTS = ["Nitrogen dioxide (NO2)", "Ozone", "Sulfur dioxide", "Carbon monoxide"]
SQ_METRES_TO_ACRES = 0.000247105
TRANSIT_MAXIMUM = 13.3553

SECTORS = [
    "pct_ag", "pct_mining", "pct_util", "pct_construction", "pct_manuf", "pct_wholesale", "pct_retail",
    "pct_transport", "pct_info", "pct_finance", "pct_realestate", "pct_prof_services", "pct_mgmt", "pct_waste_mgmt",
    "pct_ed", "pct_health", "pct_arts", "pct_food", "pct_other", "pct_pubadmin",
]


def exceedances() -> Column:
    watched = F.col("parameter_name").isin(POLLUTANTS) | F.col("parameter_name").contains("PM")
    return F.sum(F.when(watched, F.col("primary_exceedance_count")))


def layer_indicators(p: Parameters) -> list[Indicator]:
    n, fid = F.count(F.lit(1)), F.col("feature_id")

    def density(name, family, source, column, measure, **kw) -> Indicator:
        return Indicator(
            name, family, source, {"_sum": measure}, {column: ratio(src(source, "_sum"), F.col("sqmiland"))}, **kw
        )

    jobs = [F.col(f"cns{i:02d}") for i in range(1, 21)]
    commercial = sum((jobs[i - 1] for i in (9, 10, 12, 13, 17, 18, 19)), jobs[6])
    bike = F.col("_scaled")
    walk = F.col("hh_density_norm") + F.col("intersectiondensity_norm") + F.col("retaildensity_norm")
    access = (F.col("access1") + F.col("bus_thirdm") + F.col("closest_bu")) / TRANSIT_MAXIMUM * 100
    acres = F.sum("aland10") * SQ_METRES_TO_ACRES
    no_place = (COUNTY, METRO, TRACT, ZIP)
    return [
        Indicator(
            "park_pcap",
            "F5",
            "cpgis_parks",
            {"_parks": F.nullif(F.count_if(F.col("name") != EXCLUDED_PARK), F.lit(0))},
            {"park_pcap": ratio(src("cpgis_parks", "_parks"), F.col("totpop")) * 10000},
            needs=("totpop",),
        ),
        density(
            "gwy_sqmi",
            "F6",
            "mpo_bicyclefacilities",
            "gwy_sqmi",
            F.sum(F.when(F.col("facility_class").isin(WALKING_CLASSES), F.col("miles"))),
        ),
        Indicator(
            "pct_afford_housing",
            "F6",
            "hud_affordable_housing",
            {"_units": F.sum("total_units")},
            {"pct_afford": 100 * ratio(src("hud_affordable_housing", "_units"), F.col("hu"))},
            needs=("hu",),
        ),
        _direct("foreclosure", "F5", "regis_foreclosures", {"foreclose": n}),
        density("bikeability", "F14", "bikeability", "bic_index", pick_one(bike, fid)),
        density("mmode_connection", "F5", "multimodalconnection", "mmcnxpsmi", n),
        _direct("transit_access", "F14", "transit_access", {"transit_access": pick_one(access, fid)}),
        _direct("mata_stops", "F5", "mata_stops", {"mata_stop_sqmi": n}),
        density("bus_rider", "F17", "mata_ridership", "rider_sqmi", F.sum("tot")),
        _direct("walkability", "F14", "walkability", {"walkscore": pick_one(walk, fid)}),
        Indicator(
            "tree_canopy",
            "F15",
            "tree_canopy",
            {"_share": 100 * ratio(F.sum("tree_canopy_acres"), acres)},
            {
                "pct_canopy": F.when(
                    F.col("geography") == PLACE, src("tree_canopy_muni", "percent_tree_canopy")
                ).otherwise(src("tree_canopy", "_share"))
            },
            also=("tree_canopy_muni",),
        ),
        Indicator(
            "pct_impervious",
            "F15",
            "tree_canopy",
            {"_paved": 100 * ratio(F.sum("impervious_acres"), acres)},
            {
                "pct_imp": F.when(
                    F.col("geography") == PLACE, src("tree_canopy_muni", "percent_impervious")
                ).otherwise(src("tree_canopy", "_paved"))
            },
            also=("tree_canopy_muni",),
        ),
        _direct(
            "elec_station",
            "F5",
            "alternative_fuel_stations",
            {"elec_chg_station": F.sum(F.when(F.col("fuel") == "Electric", 1).otherwise(0))},
        ),
        density("green_bldgs", "F5", "leed_buildings", "green_bldgs_sqmi", n),
        Indicator(
            "air_qual",
            "F6",
            "epa_airquality",
            {"_days": exceedances()},
            {
                "days_ovr_aq_stndrd": F.when(
                    F.col("geography") == COUNTY, src("epa_airquality_county", "_days")
                ).otherwise(src("epa_airquality", "_days"))
            },
            also=("epa_airquality_county",),
        ),
        density("protected_land", "F14", "esri_fedland", "fed_acre_sqmi", pick_one(F.col("sqmi") * 640, fid)),
        _direct(
            "pct_commercial",
            "F14",
            "emp_centers",
            {"pct_commercial": pick_one(100 * ratio(commercial, F.col("c000")), fid)},
        ),
        _direct(
            "emp_sector",
            "F15",
            "emp_centers",
            {name: weighted_share(job, F.col("c000")) for name, job in zip(SECTORS, jobs)},
        ),
        _direct(
            "low_mod_jobs",
            "F14",
            "emp_centers",
            {"pct_lowinc_job": pick_one(100 * ratio(F.col("ce01"), F.col("c000")), fid)},
        ),
        Indicator(
            "bikepedinc_pcap",
            "F6",
            "nhtsa_ped_bike_fatality",
            {"_persons": F.sum("persons")},
            {"bpinc_pcap": ratio(src("nhtsa_ped_bike_fatality", "_persons"), F.col("totpop")) * 10000},
            needs=("totpop",),
        ),
        density("os_sqmi", "F6", "cpgis_openspace", "os_sqmi", F.sum("acreage")),
        density(
            "wetlands_sqmi",
            "F6",
            "nwi_wetlands",
            "wetland_sqmi",
            F.sum(F.when(F.col("wetland_type").contains("Wetland"), F.col("acres"))),
        ),
        density("brownfld_sqmi", "F5", "tristate_brownfield", "brnfld_sqmi", n),
    ]


# Nearest-feature layers: indicator -> (column, layer, school code).
NEAREST = {
    "park": ("park_dist", "cpgis_parks", None),
    "elem_schools": ("elem_dist", "cpgis_schools", 73003),
    "middle_schools": ("middle_dist", "cpgis_schools", 73004),
    "high_schools": ("high_dist", "cpgis_schools", 73005),
    "pvt_schools": ("pvt_dist", "cpgis_schools", 73006),
    "daycare_dist": ("chldcntr_dist", "cpgis_childcare_cntrs", None),
    "community_gardens": ("cmgrdn_dist", "community_gardens_130426", None),
    "farmers_markets": ("frmrmkt_dist", "farmers_markets_130426", None),
    "libraries": ("library_dist", "libraries_130610", None),
    "commcenters_dist": ("commcenter_dist", "community_centers_130508", None),
    "hospitals": ("hosp_dist", "hospitals", None),
    "police_stations": ("pol_dist", "police_stations", None),
    "fire_stations": ("fire_dist", "fire_stations", None),
}


def special_indicators(p: Parameters) -> list[Indicator]:
    """Indicators whose measures come from their own spatial plan (see `indicators.py`)."""
    kind = F.col("kind")

    def of(name: str, value: Column) -> Column:
        return F.when(kind == name, value)

    def masked(value: Column, drop: list[str] | None = None) -> Column:
        return F.when(covered(drop), value)

    lots = lambda m: src("parcels", m)
    prop_mask = F.when(F.col("geography") == ZIP, covered(DROPPED_ZIPS)).otherwise(
        F.substring("geoid10", 1, 5) == "47157"
    )
    both = src("parcels", "_sfla_rows").isNotNull() & src("commercial_floor").isNotNull()
    floor = pct(
        src("commercial_floor", "_sf"), src("commercial_floor", "_sf") + lots("_sfla")
    )
    luc = of("pardat", F.col("luc"))
    out = [
        Indicator(
            "sfcomm",
            "F21",
            "parcels",
            {"_sfla": F.sum(of("sfla", F.col("n"))), "_sfla_rows": F.max(of("sfla", F.lit(1)))},
            {"pct_comm": masked(F.when(both, floor))},
            also=("commercial_floor",),
        ),
        Indicator(
            "age_comm",
            "F7",
            "parcels",
            {"_comm": year_gap(p.age_year, F.avg(of("comdat", F.col("n"))))},
            {"age_comm": masked(lots("_comm"))},
        ),
        Indicator(
            "pct_developed",
            "F8",
            "parcels",
            {"_dev": share_where(luc != "000", luc)},
            {"pct_dev": masked(lots("_dev"))},
        ),
        Indicator(
            "pct_vacant",
            "F8",
            "parcels",
            {"_vac": share_where(luc == "000", luc)},
            {"pct_vac": masked(lots("_vac"), DROPPED_ZIPS)},
        ),
        Indicator(
            "age_bldg",
            "F7",
            "parcels",
            {"_bldg": year_gap(p.age_year, F.avg(of("building", F.col("n"))))},
            {"age_bldg": masked(lots("_bldg"), DROPPED_ZIPS)},
        ),
        Indicator(
            "age_sf",
            "F7",
            "parcels",
            {"_sf": year_gap(p.age_year, F.avg(of("dweldat", F.col("n"))))},
            {"age_sf": masked(lots("_sf"), DROPPED_ZIPS)},
        ),
        Indicator(
            "chg_prop_val",
            "F18",
            "parcels",
            {"_now": F.sum(of("asmt", F.col("n"))), "_then": F.sum(of("asmt_2004", F.col("n")))},
            {"pct_chgprop": F.when(prop_mask, real_change(lots("_now"), lots("_then"), p.price_factor))},
        ),
        _direct("afford_hsng_green", "F12", "housing_parks", {"affhsgreen": F.sum("pairs")}),
        Indicator(
            "pct_streets_sdw",
            "F11",
            "streets",
            {"flag_pct": F.max("flag_pct")},
            {"strtsdw_pct": src("streets", "flag_pct")},
        ),
        Indicator(
            "mata_routes",
            "F13",
            "routes",
            {"miles": F.max("miles")},
            {"mata_route_sqmi": ratio(src("routes", "miles"), F.col("sqmiland"))},
        ),
        Indicator(
            "bicyle_facilities",
            "F13",
            "bike_routes",
            {"miles": F.max("miles")},
            {"bic_sqmi": ratio(src("bike_routes", "miles"), F.col("sqmiland"))},
        ),
    ]
    out += [
        Indicator(name, "F9/F10", "nearest", {column: F.max(column)}, {column: src("nearest", column)})
        for name, (column, _, _) in NEAREST.items()
    ]
    return out


def catalogue(p: Parameters | None = None) -> list[Indicator]:
    """All indicators; needs a running Spark session, since expressions are Spark columns."""
    p = p or Parameters()
    return survey_indicators(p) + keyed_indicators(p) + layer_indicators(p) + special_indicators(p)


def output_columns(indicators: list[Indicator], geography: str | None = None) -> dict[str, str]:
    """Column -> type, for one geography or for all of them."""
    out = {}
    for ind in indicators:
        if geography is None or not ind.only or geography in ind.only:
            for column in ind.outputs:
                out[column] = ind.type
    return out
