"""What a viewer of the final ports asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import bounds
from tidemark.operators.scans import ranked
from tidemark.session import materialise
from tidemark.sources.geojson import features

#: Display name and property.
DISPLAY = (
    ("City", "nearest_city"), ("Region", "admin1"), ("Country", "country_name"), ("Events", "n_events"),
    ("Vessels", "n_unique_mmsi_approx"), ("Cells", "n_cells"),
)
SORTABLE = ("Events", "Vessels", "Cells", "City", "Country")


def display(ports: DataFrame) -> DataFrame:
    """Six display columns and ``_idx``, the row's place."""
    text = lambda name, src: F.coalesce(F.col(src), F.lit("")).alias(name)
    count = lambda name, src: F.coalesce(F.col(src), F.lit(0)).cast("long").alias(name)
    cols = [(text if name in ("City", "Region", "Country") else count)(name, src) for name, src in DISPLAY]
    return ports.select(F.col("cluster_id").alias("_idx"), *cols)


def search(shown: DataFrame, pattern: str | None) -> DataFrame:
    """Rows whose city, country or region contains the regular expression, whatever the case."""
    if not pattern:
        return shown
    found = [F.col(c).rlike(f"(?i){pattern}") for c in ("City", "Country", "Region")]
    return shown.where(found[0] | found[1] | found[2])


def ordered(shown: DataFrame, by: str = "Events", ascending: bool = False) -> DataFrame:
    if by not in SORTABLE:
        raise ValueError(f"sort by one of {SORTABLE}")
    return shown.orderBy(F.col(by).asc() if ascending else F.col(by).desc(), "_idx")


def pick(shown: DataFrame, position: int, by: str = "Events", ascending: bool = False) -> DataFrame:
    """The row at a position (from 0) of the ordered list."""
    if by not in SORTABLE:
        raise ValueError(f"sort by one of {SORTABLE}")
    key = F.col(by).asc() if ascending else F.col(by).desc()
    return ranked(materialise(shown, "shown"), [key, F.col("_idx")], "_place").where(F.col("_place") == position).drop("_place")


#: What a viewer reads of a feature.
PROPERTIES = (
    "harbour_id: string, h3_cells: array<string>, n_cells: int, n_events: int, n_unique_mmsi_approx: int, n_draught_changes: int, centroid_lat: double, centroid_lon: double, "
    "country_iso2: string, country_name: string, nearest_city: string, nearest_city_dist_km: double, admin1: string, matched_existing: boolean"
)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """``_idx`` (from 0, in the document's order), ``geometry`` (text) and ``properties`` of the features of a collection, read once and stored."""
    one = F.from_json("feature", f"geometry string, properties struct<{PROPERTIES}>", {"mode": "FAILFAST"})
    return ranked(features(spark, path), [F.col("ordinal")], "_idx").select("_idx", one.alias("f")).select("_idx", "f.*")


def with_bounds(ports: DataFrame) -> DataFrame:
    """``ports`` with the box ``min_lon, min_lat, max_lon, max_lat`` of their outline."""
    number = r"(-?[0-9.]+(?:[eE][-+]?[0-9]+)?)"
    pairs = F.regexp_extract_all("geometry_wkt", F.lit(f"{number} {number}"), F.lit(0))
    points = F.transform(pairs, lambda p: F.transform(F.split(p, " "), lambda x: x.cast("double")))
    return ports.withColumn("_b", bounds(points)).select(*ports.columns, "_b.*")
