"""A small invented region: square areas, random features, and plain-Python answers to compare with."""

import random

from areastats.functions.geometry import LINE_DIM, POINT_DIM, POLYGON_DIM, RINGS_TYPE
from areastats.plans.catalogue import COUNTY, METRO, NEAREST, PLACE, TRACT, ZIP
from areastats.plans.indicators import Inputs, Layer

UNIT = 10000.0


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def rect(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


# geography, code, name, land area, x, y, width, height
AREAS = [
    (COUNTY, "47157", "Shelby", 2.0e9, 0.0, 0.0, 4 * UNIT, 4 * UNIT),
    (COUNTY, "28033", "Other", 1.0e9, 4 * UNIT, 0.0, 4 * UNIT, 4 * UNIT),
    (METRO, "32820", "Metro", 3.0e9, 0.0, 0.0, 8 * UNIT, 4 * UNIT),
    (PLACE, "4748000", "Memphis", 0.5e9, UNIT, UNIT, 2 * UNIT, 2 * UNIT),
    (PLACE, "2811111", "Outside", 0.4e9, 5 * UNIT, UNIT, UNIT, UNIT),
    *[
        (TRACT, f"47157{i:06d}", f"Tract {i}", 0.5e9, (i % 2) * 2 * UNIT, (i // 2) * 2 * UNIT, 2 * UNIT, 2 * UNIT)
        for i in range(4)
    ],
    (TRACT, "28033000000", "Tract 9", 1.0e9, 4 * UNIT, 0.0, 4 * UNIT, 4 * UNIT),
    (ZIP, "38109", "38109", 1.0e9, 0.0, 0.0, 4 * UNIT, 2 * UNIT),
    (ZIP, "38023", "38023", 1.0e9, 0.0, 2 * UNIT, 4 * UNIT, 2 * UNIT),
    (ZIP, "38680", "38680", 1.0e9, 4 * UNIT, 0.0, 4 * UNIT, 4 * UNIT),
]

LEVEL = {COUNTY: "050", METRO: "310", PLACE: "160", TRACT: "140", ZIP: "860"}


def inside(area, x, y):
    return area[4] < x < area[4] + area[6] and area[5] < y < area[5] + area[7]


class World:
    def __init__(self, spark, seed=7):
        self.spark, self.rnd = spark, random.Random(seed)
        self.survey_rows, self.points, self.tables = {}, {}, {}

    def areas(self):
        rows = [(a[0], a[1], a[2], a[3], [(0, False, rect(*a[4:]))]) for a in AREAS]
        return self.spark.createDataFrame(
            rows, f"geography string, geoid10 string, name10 string, aland10 double, rings {RINGS_TYPE}"
        )

    def survey(self, table, lines):
        names = [f"{table}{i:03d}" for i in range(1, lines + 1)]
        rows = []
        for n, a in enumerate(AREAS):
            values = [float(self.rnd.randint(1, 900)) for _ in names]
            if n == 1:
                values[0] = 0.0
            if n == 4 and lines > 1:
                values[1] = None
            rows.append((a[1], a[2], "TN", LEVEL[a[0]], "2016e5", *values))
        self.survey_rows[table] = {(a[0], a[1]): r[5:] for a, r in zip(AREAS, rows)}
        schema = "geoid string, name string, stusab string, sumlevel string, fileid string, " + ", ".join(
            f"{c} double" for c in names
        )
        return self.spark.createDataFrame(rows, schema)

    def spot(self):
        return self.rnd.randint(0, 800) * 100 + 0.5, self.rnd.randint(0, 400) * 100 + 0.5

    def point_layer(self, layer_name, n, **attributes):
        rows = []
        for i in range(n):
            x, y = self.spot()
            rows.append((i, x, y, *[f(self.rnd, i) for _, f in attributes.values()]))
        self.points[layer_name] = [dict(zip(["feature_id", "x", "y", *attributes], r)) for r in rows]
        schema = "feature_id long, x double, y double" + "".join(f", {k} {t}" for k, (t, _) in attributes.items())
        return Layer(self.spark.createDataFrame(rows, schema), POINT_DIM)

    def square_layer(self, layer_name, n, size=60.0, **attributes):
        """Small squares whose centroid is the recorded x, y."""
        layer = self.point_layer(layer_name, n, **attributes)
        rows = [
            (*[r[k] for k in ["feature_id", *attributes]], [(0, False, square(r["x"] - size / 2, r["y"] - size / 2, size))])
            for r in self.points[layer_name]
        ]
        schema = "feature_id long" + "".join(f", {k} {t}" for k, (t, _) in attributes.items()) + f", rings {RINGS_TYPE}"
        return Layer(self.spark.createDataFrame(rows, schema), POLYGON_DIM)

    def line_layer(self, layer_name, n, **attributes):
        """Axis-parallel lines off the area borders; the centre is recorded as x, y."""
        rows, kept = [], []
        for i in range(n):
            x, y = self.spot()
            dx, dy = (self.rnd.randint(5, 60) * 100, 0) if i % 2 else (0, self.rnd.randint(5, 60) * 100)
            extra = [f(self.rnd, i) for _, f in attributes.values()]
            rows.append((i, *extra, [(0, False, [(x, y), (x + dx, y + dy)])]))
            kept.append(
                dict(feature_id=i, x=x + dx / 2, y=y + dy / 2, a=(x, y), b=(x + dx, y + dy), **dict(zip(attributes, extra)))
            )
        self.points[layer_name] = kept
        schema = "feature_id long" + "".join(f", {k} {t}" for k, (t, _) in attributes.items()) + f", rings {RINGS_TYPE}"
        return Layer(self.spark.createDataFrame(rows, schema), LINE_DIM)

    def table(self, name, schema, rows):
        self.tables[name] = rows
        return self.spark.createDataFrame(rows, schema)

    def inputs(self):
        spark = self.spark
        lines = {
            "b01003": 1, "b19013": 1, "b02001": 8, "b17001": 30, "b01001": 49, "b25001": 1, "b25077": 1, "b25064": 1,
            "b25004": 1, "b25003": 3, "b25032": 21, "b25039": 1, "b08303": 13, "b08301": 20, "b19058": 2, "b23020": 1,
            "b23025": 5, "b15003": 25, "c27007": 20, "b03003": 3,
        }
        for k in "abcdefgi":
            lines.update({f"b17001{k}": 2, f"b25003{k}": 2, f"b19013{k}": 1})
        survey = {t: self.survey(t, n) for t, n in lines.items()}

        num = lambda lo, hi: ("double", lambda r, i: float(r.randint(lo, hi)))
        of = lambda *vals: ("string", lambda r, i: r.choice(vals))
        layers = {
            "cpgis_parks": self.square_layer("cpgis_parks", 30, 400.0, name=of("A", None, "Wapanocca National Wildlife Refuge")),
            "mpo_bicyclefacilities": self.line_layer(
                "mpo_bicyclefacilities", 30, facility_class=of("Shared Use Path", "Walking Path", "Lane"), miles=num(1, 9)
            ),
            "hud_affordable_housing": self.point_layer("hud_affordable_housing", 40, total_units=num(1, 90)),
            "regis_foreclosures": self.point_layer("regis_foreclosures", 60),
            "bikeability": self.square_layer(
                "bikeability", 30, commutebikepercnorm=num(1, 9), intersectionnorm=num(1, 9), bikenet_norm=num(1, 9),
                bikepathlengthdensitynorm=num(1, 9),
            ),
            "multimodalconnection": self.point_layer("multimodalconnection", 30),
            "transit_access": self.square_layer(
                "transit_access", 30, access1=num(0, 9), bus_thirdm=num(0, 9), closest_bu=num(0, 9)
            ),
            "mata_stops": self.point_layer("mata_stops", 40, stop_id=("int", lambda r, i: i)),
            "walkability": self.square_layer(
                "walkability", 30, hh_density_norm=num(0, 9), intersectiondensity_norm=num(0, 9), retaildensity_norm=num(0, 9)
            ),
            "tree_canopy": self.square_layer(
                "tree_canopy", 30, aland10=num(10**6, 10**7), tree_canopy_acres=num(1, 99), impervious_acres=num(1, 99)
            ),
            "alternative_fuel_stations": self.point_layer("alternative_fuel_stations", 20, fuel=of("Electric", "CNG")),
            "leed_buildings": self.point_layer("leed_buildings", 20),
            "epa_airquality": self.point_layer(
                "epa_airquality", 40, state_code=of("47", "28"), county_code=of("157", "33"),
                parameter_name=of("Ozone", "PM2.5 - Local", "Lead"), primary_exceedance_count=("int", lambda r, i: r.randint(0, 9)),
            ),
            "esri_fedland": self.square_layer("esri_fedland", 20, sqmi=num(1, 9)),
            "emp_centers": self.square_layer(
                "emp_centers", 30, c000=("int", lambda r, i: r.choice([0, 50, 100, 300])), ce01=("int", lambda r, i: r.randint(0, 50)),
                **{f"cns{i:02d}": ("int", lambda r, i: r.randint(0, 20)) for i in range(1, 21)},
            ),
            "nhtsa_ped_bike_fatality": self.point_layer("nhtsa_ped_bike_fatality", 30, persons=("int", lambda r, i: r.randint(1, 4))),
            "cpgis_openspace": self.square_layer("cpgis_openspace", 20, acreage=num(1, 90)),
            "nwi_wetlands": self.square_layer("nwi_wetlands", 30, wetland_type=of("Forested Wetland", "Lake", "Wetland B"), acres=num(1, 90)),
            "tristate_brownfield": self.point_layer("tristate_brownfield", 30),
            "cpgis_schools": self.point_layer(
                "cpgis_schools", 30, fcode=("int", lambda r, i: 73003 + i % 4)
            ),
            "teleatlas_streets": self.line_layer("teleatlas_streets", 60, dynamap_id=("int", lambda r, i: None if i == 3 else i)),
            "mata_routes": self.line_layer("mata_routes", 20),
        }
        for _, layer, _ in NEAREST.values():
            if layer not in layers:
                layers[layer] = self.point_layer(layer, 6)
        codes = [a[1] for a in AREAS]
        zips = [a[1] for a in AREAS if a[0] == ZIP]
        keyed = {
            "htaindex": self.table(
                "htaindex",
                "geoid string, ht_ami double, vmt_per_hh_ami double, autos_per_hh_ami double, emp_ovrll_ndx double, emp_ndx double",
                [(c, *[float(self.rnd.randint(1, 99)) for _ in range(5)]) for c in codes[:-2]],
            ),
            "fcc_broadband": self.table(
                "fcc_broadband", "tractcode string, pcat_10x1 int", [(c, i) for i, c in enumerate(codes)]
            ),
            "schd_life_exp_0913": self.table("schd_life_exp_0913", "zipcode string, life_exp int", [(z, 70 + i) for i, z in enumerate(zips)]),
            "schd_mortality_0913": self.table(
                "schd_mortality_0913",
                "zipcode string, heart_disease int, neoplasm int, cerebrovascular int, lower_resp int, diabetes int, alzheimers int",
                [(z, 1, 2, 3, 4, 5, i) for i, z in enumerate(zips)],
            ),
            "tdh_indicators": self.table(
                "tdh_indicators", "geoid string, births11_15 double, deaths10_14 double, neoplasms double, heartdis double",
                [(c, 1.5, 2.5, 3.5, 4.5) for c in codes if len(c) == 11],
            ),
            "mlgw_rates": self.table(
                "mlgw_rates", "zip string, meter string, scat string, avg_mo double",
                [(z, m, s, float(self.rnd.randint(1, 99))) for z in zips[:2] for m in ("RES", "APT") for s in "KGW"],
            ),
            "tree_canopy_muni": self.table(
                "tree_canopy_muni", "municipali string, percent_tree_canopy double, percent_impervious double",
                [("MEMPHIS", 31.5, 22.25), ("Memphis", 40.0, 50.0)],
            ),
            "mata_ridership": self.table(
                "mata_ridership", "stop_id int, sum_passengers_on double",
                [(self.rnd.randint(0, 30), float(self.rnd.randint(1, 90))) for _ in range(80)],
            ),
            "mpo_sidewalks": self.table("mpo_sidewalks", "teleatlas_id int", [(i,) for i in (1, 2, 2, 5, 8, 13, 21, 34, None)]),
        }
        parcels = self.square_layer("parcels", 60, 200.0, parcelid=("string", lambda r, i: f"P{i}"))
        old = self.square_layer("parcels_2004", 40, 200.0, parcelid=("string", lambda r, i: f"P{i}"))
        parid = lambda: f"P{self.rnd.randint(0, 65)}"
        r = self.rnd
        assessor = {
            "sca_comdat": self.table("sca_comdat", "parid string, yrblt double", [(parid(), float(r.randint(1900, 2010))) for _ in range(50)]),
            "sca_dweldat": self.table(
                "sca_dweldat", "parid string, yrblt double, sfla double",
                [(parid(), float(r.randint(1900, 2010)), float(r.randint(800, 3000))) for _ in range(60)],
            ),
            "sca_pardat": self.table("sca_pardat", "parid string, luc string", [(f"P{i}", r.choice(["000", "062", "058", None])) for i in range(60)]),
            "sca_comintext": self.table("sca_comintext", "parid string, sf double", [(parid(), float(r.randint(500, 9000))) for _ in range(60)]),
            "sca_asmt": self.table("sca_asmt", "parid string, rtotapr double", [(f"P{i}", float(r.randint(10**4, 10**6))) for i in range(60)]),
            "sca_asmt_2004": self.table("sca_asmt_2004", "parid string, rtotapr double", [(f"P{i}", float(r.randint(10**4, 10**6))) for i in range(40)]),
        }
        return Inputs(
            areas=self.areas(), survey=survey, keyed=keyed, layers=layers, parcels=parcels.df, parcels_2004=old.df,
            assessor=assessor,
        )
