"""Summary tables: from areas, survey tables, key-joined tables and layers to one wide row per area.

Every source is assigned to the areas of all geographies once and aggregated once, giving a frame
`(geography, geoid10, <source>: struct of measures)`. All those frames are stacked and grouped by area, so the wide row
costs one small shuffle instead of one join per source.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from areastats.functions import geometry as g
from areastats.functions.text import county_code
from areastats.operators.families import (
    attach,
    distinct_on,
    flag_share,
    length_per_area,
    name_match,
    nearest_to_areas,
    pairs_within,
    per_area,
    pivot_rates,
    roll_up,
    scale_over_layer,
    sidewalk_flags,
    summed_per_key,
)
from areastats.operators.spatial import AREA_KEYS, area_tiles, near_pairs, representative_points
from areastats.operators.survey import with_geography
from areastats.plans.catalogue import (
    COUNTY,
    KEY_COLUMNS,
    NEAREST,
    PLACE,
    RATE_CELLS,
    SKIPPED,
    TRACT,
    ZIP,
    Indicator,
    Parameters,
    catalogue,
    exceedances,
    output_columns,
)
from areastats.sources.files import append_table
from areastats.sources.versions import get, put, read_log

SQ_METRES_PER_SQ_MILE = 2589988.0
SQ_METRES_PER_ACRE = 4046.86
BASE_COLUMNS = ["geoid10", "sqmiland", "name10", "acreland"]


@dataclass(frozen=True)
class Layer:
    """A feature table with `feature_id`, attributes, and `rings` (lines, polygons) or `x`, `y` (points)."""

    df: DataFrame
    dim: int


@dataclass
class Inputs:
    """What a year's run reads. Anything left out gives null columns."""

    areas: DataFrame
    survey: dict[str, DataFrame] = field(default_factory=dict)
    keyed: dict[str, DataFrame] = field(default_factory=dict)
    layers: dict[str, Layer] = field(default_factory=dict)
    parcels: DataFrame | None = None
    parcels_2004: DataFrame | None = None
    assessor: dict[str, DataFrame] = field(default_factory=dict)


def with_land_units(areas: DataFrame) -> DataFrame:
    """Land area in square miles and acres from square metres."""
    return areas.withColumns(
        {"sqmiland": F.col("aland10") / SQ_METRES_PER_SQ_MILE, "acreland": F.col("aland10") / SQ_METRES_PER_ACRE}
    )


def summary_base(areas: DataFrame) -> DataFrame:
    return with_land_units(areas).select("geography", *BASE_COLUMNS)


def with_row_id(summary: DataFrame) -> DataFrame:
    """Serial id per geography in geoid order; only for consumers that need one (a geography is one bounded list)."""
    return summary.withColumn("id", F.row_number().over(W.partitionBy("geography").orderBy("geoid10")))


def measures_by_source(indicators: list[Indicator]) -> dict[str, dict[str, Column]]:
    out: dict[str, dict[str, Column]] = {}
    for ind in indicators:
        out.setdefault(ind.source, {}).update(ind.measures)
    return out


def _packed(df: DataFrame, source: str, names: list[str]) -> DataFrame:
    return df.select(*AREA_KEYS, F.struct(*names).alias(source))


class SourceFrames:
    """Builds the measures of each source lazily; `frames()` maps source names to frames."""

    def __init__(self, inputs: Inputs, params: Parameters | None = None, indicators: list[Indicator] | None = None):
        self.inputs = inputs
        self.params = params or Parameters()
        self.indicators = indicators or [i for i in catalogue(self.params) if i.name not in SKIPPED]
        self.measures = measures_by_source(self.indicators)
        self._tiles: dict[float, DataFrame] = {}

    def tiles(self, cell: float | None = None) -> DataFrame:
        cell = cell or self.params.cell
        if cell not in self._tiles:
            self._tiles[cell] = area_tiles(self.inputs.areas, cell).persist(StorageLevel.MEMORY_AND_DISK)
        return self._tiles[cell]

    def release(self) -> None:
        """Drop the cached tiles once the results are written."""
        for tiles in self._tiles.values():
            tiles.unpersist()
        self._tiles.clear()

    def builders(self) -> dict[str, Callable[[], DataFrame]]:
        """Sources whose input is at hand, with the function that builds each."""
        i, m = self.inputs, self.measures
        out: dict[str, Callable[[], DataFrame]] = {}
        for table in i.survey:
            if table in m:
                out[table] = lambda t=table: self._survey(t)
        for table in i.keyed:
            if table in m:
                out[table] = lambda t=table: self._keyed(t)
        if "tree_canopy_muni" in i.keyed:
            out["tree_canopy_muni"] = self._municipal_canopy
        for name in i.layers:
            if name in m:
                out[name] = lambda n=name: self._layer(n)
        if "epa_airquality" in i.layers:
            out["epa_airquality_county"] = self._county_air
        if "mata_stops" in i.layers and "mata_ridership" in i.keyed:
            out["mata_ridership"] = self._ridership
        if i.parcels is not None:
            if i.assessor:
                out["parcels"] = self._parcels
            if "sca_comintext" in i.assessor:
                out["commercial_floor"] = self._commercial_floor
        if "hud_affordable_housing" in i.layers and "cpgis_parks" in i.layers:
            out["housing_parks"] = self._housing_parks
        if "teleatlas_streets" in i.layers and "mpo_sidewalks" in i.keyed:
            out["streets"] = self._streets
        if "mata_routes" in i.layers:
            out["routes"] = lambda: self._lengths("routes", "mata_routes")
        if "mpo_bicyclefacilities" in i.layers:
            out["bike_routes"] = lambda: self._lengths("bike_routes", "mpo_bicyclefacilities")
        if any(layer in i.layers for _, layer, _ in NEAREST.values()):
            out["nearest"] = self._nearest
        return out

    def frames(self) -> dict[str, DataFrame]:
        return {name: build() for name, build in self.builders().items()}

    def _survey(self, table: str) -> DataFrame:
        rows = with_geography(self.inputs.survey[table]).where(F.col("geography").isNotNull())
        exprs = [c.alias(n) for n, c in self.measures[table].items()]
        return rows.select("geography", F.col("geoid").alias("geoid10"), F.struct(*exprs).alias(table))

    def _keyed(self, table: str) -> DataFrame:
        df, key = self.inputs.keyed[table], KEY_COLUMNS[table]
        only = {o for ind in self.indicators if ind.source == table for o in ind.only}
        areas = self.inputs.areas.select(*AREA_KEYS)
        if only:
            areas = areas.where(F.col("geography").isin(*only))
        if table == "mlgw_rates":
            df = pivot_rates(df, key, "meter", "scat", "avg_mo", RATE_CELLS)
        valued = df.select(F.col(key), *[c.alias(n) for n, c in self.measures[table].items()])
        names = list(self.measures[table])
        found = attach(areas, valued.withColumn("_found", F.lit(True)), key, [*names, "_found"])
        return _packed(found.where(F.col("_found")), table, names)

    def _municipal_canopy(self) -> DataFrame:
        columns = ["percent_tree_canopy", "percent_impervious"]
        places = self.inputs.areas.where(F.col("geography") == PLACE).select(*AREA_KEYS, "name10")
        found = name_match(places, self.inputs.keyed["tree_canopy_muni"], "municipali", columns)
        return _packed(found, "tree_canopy_muni", columns)

    def _aggregated(self, source: str, points: DataFrame, dim: int, boundary: bool = False) -> DataFrame:
        exprs = [c.alias(n) for n, c in self.measures[source].items()]
        found = per_area(points, dim, self.tiles(), self.params.cell, exprs, boundary)
        return _packed(found, source, list(self.measures[source]))

    def _layer(self, name: str) -> DataFrame:
        layer = self.inputs.layers[name]
        df = layer.df
        if name == "bikeability":
            value = (
                F.col("commutebikepercnorm")
                + F.col("intersectionnorm")
                + F.col("bikenet_norm")
                + F.col("bikepathlengthdensitynorm")
            )
            return self._aggregated(name, scale_over_layer(df, value, "_scaled"), layer.dim, boundary=True)
        return self._aggregated(name, df, layer.dim)

    def _county_air(self) -> DataFrame:
        code = county_code(F.col("state_code"), F.col("county_code"))
        days = (
            self.inputs.layers["epa_airquality"]
            .df.groupBy(F.lit(COUNTY).alias("geography"), code.alias("geoid10"))
            .agg(exceedances().alias("_days"))
        )
        return _packed(days, "epa_airquality_county", ["_days"])

    def _ridership(self) -> DataFrame:
        stops = self.inputs.layers["mata_stops"]
        summed = summed_per_key(stops.df, self.inputs.keyed["mata_ridership"], "stop_id", "sum_passengers_on", "tot")
        return self._aggregated("mata_ridership", summed, stops.dim)

    def _parcels(self) -> DataFrame:
        """All assessor measures in one pass: tagged rows meet the parcels once and the areas once."""
        i = self.inputs
        number, text = F.lit(None).cast("double"), F.lit(None).cast("string")

        def rows(kind: str, df: DataFrame, n: Column = number, luc: Column = text) -> DataFrame:
            return df.select("parid", F.lit(kind).alias("kind"), n.cast("double").alias("n"), luc.alias("luc"))

        tables = i.assessor
        parts = []
        if "sca_comdat" in tables:
            parts.append(rows("comdat", tables["sca_comdat"], F.col("yrblt")))
        if "sca_pardat" in tables:
            parts.append(rows("pardat", tables["sca_pardat"], luc=F.col("luc")))
        if "sca_dweldat" in tables:
            parts.append(rows("dweldat", tables["sca_dweldat"], F.col("yrblt")))
        if "sca_asmt" in tables:
            parts.append(rows("asmt", tables["sca_asmt"], F.col("rtotapr")))
        buildings = [tables[t].select("parid", "yrblt") for t in ("sca_comdat", "sca_dweldat") if t in tables]
        if buildings:
            both = buildings[0] if len(buildings) == 1 else buildings[0].unionByName(buildings[1])
            parts.append(rows("building", both.distinct(), F.col("yrblt")))

        points = representative_points(i.parcels.select("feature_id", "parcelid", "rings"), g.POLYGON_DIM)
        located = _union(parts).join(points, F.col("parid") == F.col("parcelid")).select("kind", "n", "luc", "x", "y")
        placed = [located]
        if "sca_dweldat" in tables:
            floor = tables["sca_dweldat"].groupBy("parid").agg(F.min("sfla").alias("n"))
            once = distinct_on(points, ["parcelid"], ["feature_id"], ["x", "y"])
            joined = floor.join(once, F.col("parid") == F.col("parcelid"))
            placed.append(
                joined.select(F.lit("sfla").alias("kind"), F.col("n").cast("double"), text.alias("luc"), "x", "y")
            )
        if i.parcels_2004 is not None and "sca_asmt_2004" in tables:
            old = representative_points(i.parcels_2004.select("feature_id", "parcelid", "rings"), g.POLYGON_DIM)
            joined = rows("asmt_2004", tables["sca_asmt_2004"], F.col("rtotapr")).join(
                old, F.col("parid") == F.col("parcelid")
            )
            placed.append(joined.select("kind", "n", "luc", "x", "y"))
        return self._aggregated("parcels", _union(placed), g.POINT_DIM)

    def _commercial_floor(self) -> DataFrame:
        """Commercial floor area by parcels that touch the area, so a parcel may count in several areas."""
        floor = self.inputs.assessor["sca_comintext"].groupBy("parid").agg(F.min("sf").cast("double").alias("sf"))
        used = self.inputs.parcels.join(floor.select("parid"), F.col("parid") == F.col("parcelid"), "left_semi")
        once = distinct_on(used, ["parcelid"], ["feature_id"], ["rings"])
        areas = self.inputs.areas.select(*AREA_KEYS, "rings")
        pairs = near_pairs(once, g.POLYGON_DIM, areas, g.POLYGON_DIM, self.params.cell)
        summed = pairs.join(floor, F.col("parid") == F.col("parcelid")).groupBy(*AREA_KEYS).agg(F.sum("sf").alias("_sf"))
        return _packed(summed, "commercial_floor", ["_sf"])

    def _housing_parks(self) -> DataFrame:
        units, parks = self.inputs.layers["hud_affordable_housing"], self.inputs.layers["cpgis_parks"]
        counted = pairs_within(
            representative_points(units.df, units.dim).select("feature_id", "x", "y"),
            parks.df,
            parks.dim,
            self.params.fine_cell,
            self.params.park_reach,
        )
        return self._aggregated("housing_parks", counted, g.POINT_DIM)

    def _streets(self) -> DataFrame:
        streets = self.inputs.layers["teleatlas_streets"]
        flagged = sidewalk_flags(streets.df, self.inputs.keyed["mpo_sidewalks"], "dynamap_id", "teleatlas_id")
        share = flag_share(flagged, streets.dim, self.inputs.areas, self.params.fine_cell, self.params.street_reach)
        return _packed(share, "streets", ["flag_pct"])

    def _lengths(self, source: str, layer: str) -> DataFrame:
        lines = self.inputs.layers[layer].df
        miles = length_per_area(lines, self.inputs.areas, self.params.fine_cell, self.params.clip_buffer)
        return _packed(miles, source, ["miles"])

    def _nearest(self) -> DataFrame:
        """All nearest-distance layers in one search; tracts and ZIP areas directly, the others from their tracts."""
        parts, names = [], []
        for column, layer, code in NEAREST.values():
            if layer not in self.inputs.layers:
                continue
            have = self.inputs.layers[layer]
            df = have.df if code is None else have.df.where(F.col("fcode") == code)
            shape = ["x", "y"] if have.dim == g.POINT_DIM else ["rings"]
            parts.append((df.select(F.lit(column).alias("target"), *shape), have.dim))
            names.append(column)
        areas = self.inputs.areas
        direct = areas.where(F.col("geography").isin(TRACT, ZIP))
        miles = nearest_to_areas(direct, parts, self.params.cell, "target", names)
        tracts = areas.where(F.col("geography") == TRACT)
        coarse = self.tiles().where(~F.col("geography").isin(TRACT, ZIP))
        rolled = roll_up(
            tracts, miles.where(F.col("geography") == TRACT), "miles", coarse, self.params.cell, ["target"]
        )
        columns = [column for column, _, _ in NEAREST.values()]
        wide = miles.unionByName(rolled).groupBy(*AREA_KEYS).pivot("target", columns).agg(F.max("miles"))
        return _packed(wide, "nearest", columns)


def _union(frames: list[DataFrame]) -> DataFrame:
    """Union in pairs, so the plan stays shallow."""
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])]
        frames = paired + ([frames[-1]] if len(frames) % 2 else [])
    return frames[0]


def _struct_type(source: str, indicators: list[Indicator]) -> T.StructType:
    names = [m for ind in indicators if ind.source == source for m in ind.measures]
    return T.StructType([T.StructField(n, T.DoubleType()) for n in dict.fromkeys(names)])


def stack(frames: dict[str, DataFrame]) -> DataFrame:
    """One row per area with a struct column per source: the frames are stacked and grouped once.

    Where a source has several rows for an area, one whole row is used (the largest), so the result does not depend on
    row order.
    """
    kinds = {f.name: f.dataType.simpleString() for df in frames.values() for f in df.schema if f.name not in AREA_KEYS}
    stacked = [
        df.selectExpr(*AREA_KEYS, *[f"`{n}`" if n in df.columns else f"cast(null as {t}) as `{n}`" for n, t in kinds.items()])
        for df in frames.values()
    ]
    return _union(stacked).groupBy(*AREA_KEYS).agg(*[F.max(f"`{n}`").alias(n) for n in kinds])


def combine(areas: DataFrame, frames: dict[str, DataFrame], indicators: list[Indicator]) -> DataFrame:
    """Wide summary of all geographies: base columns and every indicator column with its type.

    A source without a frame gives null columns.
    """
    base = summary_base(areas)
    if frames:
        base = base.join(stack(frames), AREA_KEYS, "left")
    sources = dict.fromkeys(s for ind in indicators for s in (ind.source, *ind.also))
    missing = {
        s: F.lit(None).cast(_struct_type(s, indicators) if s not in EXTRA_TYPES else EXTRA_TYPES[s])
        for s in sources
        if s not in base.columns
    }
    if missing:
        base = base.withColumns(missing)
    first = [i for i in indicators if not i.needs]
    later = [i for i in indicators if i.needs]

    def outputs(chosen: list[Indicator]) -> list[Column]:
        cols = []
        for ind in chosen:
            for name, value in ind.outputs.items():
                if ind.only:
                    value = F.when(F.col("geography").isin(*ind.only), value)
                cols.append(value.cast(ind.type).alias(name))
        return cols

    waiting = dict.fromkeys(s for ind in later for s in (ind.source, *ind.also))
    step = base.select("geography", *BASE_COLUMNS, *[F.col(f"`{s}`") for s in waiting], *outputs(first))
    ready = [c for ind in first for c in ind.outputs]
    final = step.select("geography", *BASE_COLUMNS, *ready, *outputs(later))
    order = [c for ind in indicators for c in ind.outputs]
    return final.select("geography", *BASE_COLUMNS, *order)


EXTRA_TYPES = {
    "tree_canopy_muni": "struct<percent_tree_canopy:double,percent_impervious:double>",
    "epa_airquality_county": "struct<_days:bigint>",
    "commercial_floor": "struct<_sf:double>",
}


def summarise(inputs: Inputs, params: Parameters | None = None) -> DataFrame:
    """The summary of all geographies as one lazy plan."""
    sources = SourceFrames(inputs, params)
    return combine(inputs.areas, sources.frames(), sources.indicators)


def summary_table(summary: DataFrame, geography: str, indicators: list[Indicator]) -> DataFrame:
    """The table of one geography with only the columns that are computed for it."""
    columns = output_columns(indicators, geography)
    chosen = summary.where(F.col("geography") == geography)
    return chosen.select(*BASE_COLUMNS, *[c for c in summary.columns if c in columns])


def run_list(spark: SparkSession, indicators: list[Indicator], geographies: list[str]) -> DataFrame:
    """Every (indicator, geography) pair of a run."""
    rows = sorted({(i.name, geo) for i in indicators for geo in geographies if not i.only or geo in i.only})
    return spark.createDataFrame(rows, "indicator string, geography string")


def pending(wanted: DataFrame, finished: DataFrame) -> DataFrame:
    """Pairs of the run list that are not finished yet."""
    return wanted.join(finished, ["indicator", "geography"], "left_anti")


RUN_LOG = "run_log"
RUN_FIELDS = "run long, step long, fingerprint string, source string, indicator string, geography string, folder string"


def fingerprint(sources: SourceFrames) -> str:
    """A digest of the parameters and of the measures asked for; results under another one are not used again."""
    measures = {s: {n: str(c) for n, c in m.items()} for s, m in sources.measures.items()}
    text = repr((sources.params, sorted(i.name for i in sources.indicators), sorted(measures.items())))
    return hashlib.sha256(text.encode()).hexdigest()


def restricted(inputs: Inputs, geographies: set[str], source: str) -> Inputs:
    """The inputs with the areas that a source needs for some geographies: the nearest search rolls up from tracts."""
    needed = {*geographies, TRACT} if source == "nearest" else geographies
    return replace(inputs, areas=inputs.areas.where(F.col("geography").isin(*needed)))


def run(
    inputs: Inputs,
    root: str,
    year: str,
    params: Parameters | None = None,
    rerun: bool = False,
    geographies: list[str] | None = None,
) -> DataFrame:
    """Compute a year's summary, of some geographies or all, and make it the year's current version.

    Each source is written to a folder of its own, then its (indicator, geography) pairs are logged. With `rerun` the last
    run goes on: what it has logged is read back, and a source is computed only for the geographies it lacks. A run without
    `rerun`, or with other parameters than the last one's, starts anew and uses nothing of the runs before. Changed input
    tables are not noticed. The summary holds every geography the run has finished.
    """
    spark = inputs.areas.sparkSession
    home = f"{root.rstrip('/')}/year={year}"
    sources = SourceFrames(inputs, params)
    present = [r[0] for r in inputs.areas.select("geography").distinct().collect()]
    wanted = run_list(spark, sources.indicators, [g for g in present if geographies is None or g in geographies])
    own = fingerprint(sources)

    def log(run: int, step: int, source: str | None, pairs: DataFrame, folder: str | None) -> None:
        at = [F.lit(run).cast("long").alias("run"), F.lit(step).cast("long").alias("step"), F.lit(own).alias("fingerprint")]
        named = [F.lit(source).cast("string").alias("source"), "indicator", "geography", F.lit(folder).cast("string").alias("folder")]
        append_table(pairs.select(*at, *named), home, RUN_LOG)

    past = read_log(spark, home, RUN_LOG, RUN_FIELDS)
    last = past.agg(F.max(F.struct("run", "step", "fingerprint")).alias("r")).first()["r"]
    now, step = (last["run"], last["step"]) if last else (0, 0)
    if not (rerun and last and last["fingerprint"] == own):
        now, step = now + 1, 0
        log(now, step, None, spark.createDataFrame([(None, None)], "indicator string, geography string"), None)
    # One row for each source, indicator and geography: bounded by the catalogue.
    done = {}
    for r in past.where((F.col("run") == now) & F.col("source").isNotNull()).orderBy("step").collect():
        done.setdefault(r["source"], {})[r["indicator"], r["geography"]] = (r["step"], r["folder"])
    wanted_pairs = [tuple(r) for r in wanted.collect()]

    builders = sources.builders()
    # The survey sources are narrow and many, so they share one job; every other source is a job of its own.
    together = [name for name in builders if name in inputs.survey]
    batches = ([("survey", together)] if together else []) + [(n, [n]) for n in builders if n not in together]
    frames = {}
    for stored, names in batches:
        have = done.setdefault(stored, {})
        used_by = {i.name for i in sources.indicators if {i.source, *i.also} & set(names)}
        pairs = [p for p in wanted_pairs if p[0] in used_by]
        lacking = {geo for ind, geo in pairs if (ind, geo) not in have}
        if lacking:
            part = sources
            if lacking != set(present):
                part = SourceFrames(restricted(inputs, lacking, stored), params)
            made = part.builders()
            built = stack({n: made[n]() for n in names}).where(F.col("geography").isin(*lacking))
            folder, step = f"measures/{stored}/{uuid.uuid4().hex}", step + 1
            built.write.parquet(f"{home}/{folder}")
            todo = wanted.where(F.col("indicator").isin(*used_by) & F.col("geography").isin(*lacking))
            log(now, step, stored, todo, folder)
            have.update({p: (step, folder) for p in pairs if p[1] in lacking})
            if part is not sources:
                part.release()
        newest: dict[str, tuple[int, str]] = {}
        for (_, geo), at in have.items():
            newest[geo] = max(at, newest.get(geo, at))
        by_folder: dict[str, list[str]] = {}
        for geo, (_, folder) in newest.items():
            by_folder.setdefault(folder, []).append(geo)
        stored_parts = [
            spark.read.parquet(f"{home}/{folder}").where(F.col("geography").isin(*geos)) for folder, geos in by_folder.items()
        ]
        if stored_parts:
            frames[stored] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stored_parts)
    finished = {geo for have in done.values() for _, geo in have} | {geo for _, geo in wanted_pairs}
    summary = combine(inputs.areas.where(F.col("geography").isin(*finished)), frames, sources.indicators)
    put(summary, root, "summary", year, ["geography"])
    sources.release()
    return get(spark, root, "summary", year)
