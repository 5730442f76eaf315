"""Ingest of the public layers: filters, projection to the working plane, locations and roll-forward."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from areastats.functions.projection import to_state_plane
from areastats.functions.text import county_code, next_source_id, roll_years, zfill

# The region's cities, counties and states.
CITIES = [
    "Anthonyville", "Clarkedale", "Crawfordsville", "Earle", "Edmondson", "Gilmore", "Horseshoe Lake", "Jennette",
    "Jericho", "Marion", "Sunset", "Turrell", "West Memphis", "Bridgetown", "Byhalia", "Coldwater", "Hernando",
    "Holly Springs", "Horn Lake", "Lynchburg", "North Tunica", "Olive Branch", "Potts Camp", "Senatobia", "Southaven",
    "Tunica", "Tunica Resorts", "Walls", "White Oak", "Arlington", "Atoka", "Bartlett", "Braden", "Brighton",
    "Burlison", "Collierville", "Covington", "Gallaway", "Garland", "Germantown", "Gilt Edge", "La Grange", "Lakeland",
    "Mason", "Memphis", "Millington", "Moscow", "Munford", "Oakland", "Piperton", "Rossville", "Somerville",
    "Williston",
]
COUNTIES = ["shelby", "tipton", "fayette", "marshall", "desoto", "tate", "tunica", "crittenden"]
STATES = ["TN", "MS", "AR"]
STATE_CODES = [5, 28, 47]
COUNTY_GEOIDS = ["05035", "28137", "28033", "28093", "28143", "47167", "47047", "47157"]
ROLLED_SOURCES = [
    "2016 Shelby County Assessor's Certified Roll",
    "Memphis Area Transit Authority",
    "Memphis Light, Gas, and Water",
    "Memphis Urban Area Metropolitan Planning Organization",
    "U.S. Census Bureau; American Community Survey, 2010-2014",
    "U.S. Environmental Protection Agency Air Quality System, Annual Summary File 2016",
    "U.S. Environmental Protection Agency, Uniform Resource Locator",
    "U.S. Green Building Council",
    "Source: National Highway Traffic Safety Administration Fatality Analysis Reporting System",
]


def located(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Replace longitude and latitude by projected x and y (null where a coordinate is missing)."""
    x, y = to_state_plane(F.col(lon), F.col(lat))
    return df.withColumns({"x": x, "y": y}).drop(lon, lat)


def air_quality(raw: DataFrame, geoids: list[str] | None = None) -> DataFrame:
    """Monitors of the region's counties, with padded codes and projected location."""
    padded = raw.withColumns(
        {"state_code": zfill(F.col("state_code"), 2), "county_code": zfill(F.col("county_code"), 3)}
    )
    key = county_code(F.col("state_code"), F.col("county_code"))
    return located(padded.where(key.isin(geoids or COUNTY_GEOIDS)), "longitude", "latitude")


def brownfields(raw: DataFrame, states: list[str] | None = None, counties: list[str] | None = None) -> DataFrame:
    kept = raw.where(
        F.col("state_code").isin(states or STATES) & F.lower("county_name").isin(counties or COUNTIES)
    )
    return located(kept, "longitude83", "latitude83")


def crashes(accidents: DataFrame, ped_bike: DataFrame, states: list[int] | None = None) -> DataFrame:
    """Accidents of the region that involve a pedestrian or cyclist."""
    states = states or STATE_CODES
    involved = ped_bike.where(F.col("state").isin(states)).select("st_case").distinct()
    kept = accidents.where(F.col("state").isin(states)).join(involved, "st_case", "left_semi")
    return located(kept, "longitud", "latitude")


def new_green_buildings(
    raw: DataFrame, loaded: DataFrame, states: list[str] | None = None, cities: list[str] | None = None
) -> DataFrame:
    """Public projects of the region that are not loaded yet."""
    kept = raw.where(
        F.col("state").isin(states or STATES)
        & F.col("city").isin(cities or CITIES)
        & (F.col("isconfidential") == "No")
    )
    return kept.join(loaded.select("id").distinct(), "id", "left_anti")


def attach_locations(df: DataFrame, matched: DataFrame, unmatched: DataFrame) -> DataFrame:
    """Attach geocoder results `(resultid, lon, lat)` by id; lon and lat already are plane coordinates."""
    found = matched.unionByName(unmatched, allowMissingColumns=True)
    spots = found.select(F.col("resultid").alias("id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    return df.join(spots, "id")


def clip_points(points: DataFrame, region_tiles: DataFrame, cell: float) -> DataFrame:
    """Points of a layer inside the region."""
    from areastats.operators.spatial import within

    return within(points, region_tiles.drop("geography", "geoid10"), cell)


def clip_lines(lines: DataFrame, region: DataFrame, cell: float) -> DataFrame:
    """Lines of a layer cut to the region's areas: their attributes and the geometry that lies inside, one row for each area
    of the region that a line runs through."""
    from areastats.operators.spatial import clip_lines as cut

    inside = cut(lines.select("feature_id", "rings"), region, cell)
    return lines.drop("rings").join(inside, "feature_id")


def assessor_tables(catalogue: DataFrame) -> DataFrame:
    """Assessor tables to reload: names starting `sca_`, without the 2004 tables and the parcel layers."""
    name = F.col("table_name")
    return (
        catalogue.where(
            (F.substring(name, 1, 4) == "sca_") & (F.right(name, F.lit(4)) != "2004") & ~name.contains("_parcels_")
        )
        .select("table_schema", "table_name", F.upper(F.split_part(name, F.lit("_"), F.lit(2))).alias("file_part"))
        .distinct()
    )


def assessor_target(table_name: str, year: str) -> str:
    """Name a reloaded assessor table is stored under; assessments are kept per year."""
    return f"{table_name}_{year}" if "asmt" in table_name else table_name


def load_assessor(spark, names: list[str], source_dir: str, root: str, year: str) -> list[str]:
    """Reload every assessor table from its text file, replacing the stored one; returns the stored names."""
    from areastats.sources.files import read_assessor, replace_table

    stored = []
    for name in names:
        raw = read_assessor(spark, f"{source_dir.rstrip('/')}/{name.split('_')[1].upper()}.txt")
        stored.append(assessor_target(name, year))
        replace_table(raw, root, stored[-1])
    return stored


def _listed(source: Column, sources: list[str], limit: bool) -> Column:
    return source.isin(sources) if limit else ~source.isin(sources)


def roll_sources(
    sources: DataFrame, old: str = "16", new: str = "17", limit: bool = True, listed: list[str] | None = None
) -> DataFrame:
    """Source rows of one year moved to the next: new identifier, years in the text of listed sources rolled forward."""
    listed = listed or ROLLED_SOURCES
    source = F.col("source")
    rows = sources.where(_listed(source, listed, limit) & (F.right("descid", F.lit(2)) == old))
    return rows.select(
        "description",
        next_source_id(F.col("descid"), new).alias("descid"),
        F.when(source.isin(listed), roll_years(source)).otherwise(source).alias("source"),
        "title",
        "categoryid",
    )


def roll_dictionary(
    dictionary: DataFrame,
    sources: DataFrame,
    old: str = "16",
    new: str = "17",
    limit: bool = True,
    listed: list[str] | None = None,
) -> DataFrame:
    """Dictionary rows that cite a rolled source, with the new identifier and rolled years in the units."""
    listed = listed or ROLLED_SOURCES
    cited = sources.where(_listed(F.col("source"), listed, limit) & (F.right("descid", F.lit(2)) == old))
    rows = dictionary.join(cited.select("descid"), F.col("descid") == F.col("citation"))
    return rows.select(
        roll_years(F.col("units")).alias("units"),
        "field",
        next_source_id(F.col("descid"), new).alias("citation"),
        "field_desc",
    )
