"""Schemas of the tables between the phases: the data contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STOPS = (
    "mmsi long, lat double, lon double, timestamp_start timestamp, timestamp_end timestamp, duration_minutes float, "
    "n_messages int, pos_variance_meters float, nav_status short, draught_arrival float, draught_departure float, "
    "draught_delta float, detection_method string, ship_type short, destination_raw string, destination_locode string"
)
CELLS = (
    "h3_cell string, n_unique_mmsi int, n_events int, total_duration_minutes float, mean_duration_minutes float, cell_lat double, "
    "cell_lon double, n_draught_changes int, max_visits_per_mmsi int, mean_visits_per_mmsi float, n_cargo int, n_tanker int, "
    "n_passenger int, n_fishing int, n_recreational int, n_tug_pilot int, top_destination_locode string"
)
CLUSTERS = (
    "cluster_id int, h3_cells array<string>, n_cells int, n_events int, n_unique_mmsi_approx int, n_draught_changes int, "
    "centroid_lat double, centroid_lon double, centroid_h3_r8 string, bbox_min_lat double, bbox_max_lat double, "
    "bbox_min_lon double, bbox_max_lon double"
)
ENRICHED = (
    CLUSTERS + ", geometry_wkt string, country_iso2 string, country_name string, nearest_city string, nearest_city_lat double, "
    "nearest_city_lon double, nearest_city_dist_km float, admin1 string"
)
PORTS = (
    "harbour_id string, cluster_id int, h3_cells array<string>, n_cells int, n_events int, n_unique_mmsi_approx int, "
    "n_draught_changes int, centroid_lat double, centroid_lon double, country_iso2 string, country_name string, "
    "nearest_city string, nearest_city_dist_km float, admin1 string, geometry_wkt string, matched_existing boolean"
)


def columns(ddl: str) -> list[tuple[str, str]]:
    """``(name, type)`` pairs of a schema."""
    return [tuple(part.strip().split(" ", 1)) for part in ddl.split(", ")]


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to the schema; columns that are absent become null."""

    def one(name: str, kind: str) -> Column:
        value = F.col(name) if name in df.columns else F.lit(None)
        return value.cast(kind).alias(name)

    return df.select(*[one(n, k) for n, k in columns(ddl)])
