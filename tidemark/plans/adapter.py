"""Vessel messages, a gazetteer, countries and a port database, derived from the star-schema test tables.

Each is defined twice, as a DataFrame and as SQL with the same arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import CellConfig, ClusterConfig, Config, EnrichConfig, MatchConfig, StopConfig
from tidemark.sources.messages import canonical

DESTINATIONS = ("DEHAM", "DE HAM", "EN ROUTE DEHAM", "DEHAM-HAMBURG", "HAMBURG", "via NLRTM")
#: The test messages are days apart, not minutes.
CONFIG = Config(
    data={},
    stops=StopConfig(max_gap_minutes=1440.0, draught_lookup_hours=48.0),
    cells=CellConfig(min_unique_mmsi=2),
    clusters=ClusterConfig(min_events_per_cluster=2),
    enrich=EnrichConfig(),
    match=MatchConfig(centroid_match_distance_meters=20_000.0),
)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    names = F.array(*map(F.lit, DESTINATIONS))
    raw = e.select(
        (F.col("user_id") + 100_000_000).alias("mmsi"),
        F.col("ts").alias("timestamp"),
        (F.lit(53.5) + (F.col("user_id") % 7) * F.lit(0.5) + (F.col("event_id") % 11) * F.lit(0.0001)).alias("lat"),
        (F.lit(9.9) + (F.col("user_id") % 5) * F.lit(0.3) + (F.col("event_id") % 13) * F.lit(0.0001)).alias("lon"),
        (F.col("value") / 100).alias("sog"),
        F.when(kind == "view", 5).when(kind == "click", 1).when(kind == "error", 0).when(kind == "purchase", F.lit(None)).otherwise(8).alias("nav_status"),
        F.when(kind == "signup", 5).otherwise(1).alias("msg_type"),
        (F.col("value") / 10).alias("draught"),
        F.element_at(names, (F.col("event_id") % len(DESTINATIONS) + 1).cast("int")).alias("destination"),
        (30 + (F.col("user_id") * 7) % 60).cast("int").alias("ship_type"),
    )
    return canonical(raw)


_NAMES = ", ".join(f"'{d}'" for d in DESTINATIONS)
MESSAGES_SQL = f"""ais AS (
  SELECT user_id + 100000000 AS mmsi, epoch_us(ts) AS t, 53.5e0 + (user_id % 7) * 0.5e0 + (event_id % 11) * 0.0001e0 AS lat,
    9.9e0 + (user_id % 5) * 0.3e0 + (event_id % 13) * 0.0001e0 AS lon, value / 100e0 AS sog,
    CASE event_type WHEN 'view' THEN 5 WHEN 'click' THEN 1 WHEN 'error' THEN 0 WHEN 'purchase' THEN NULL ELSE 8 END AS nav_status,
    CASE event_type WHEN 'signup' THEN 5 ELSE 1 END AS msg_type, value / 10e0 AS draught,
    [{_NAMES}][CAST(event_id % {len(DESTINATIONS)} AS INTEGER) + 1] AS destination, CAST(30 + (user_id * 7) % 60 AS INTEGER) AS ship_type
  FROM events
)"""


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city per supplier, spread over the globe; names are unique."""
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    key = F.col("s_suppkey")
    return s.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("admin-"), (key % 17).cast("string")).alias("admin1"),
        F.concat(F.char(F.lit(65) + F.col("s_nationkey")), F.char(F.lit(65) + (F.col("s_nationkey") * 7) % 26)).alias("cc"),
        ((key * 37) % 1601 / F.lit(10.0) - 80.0).alias("lat"),
        ((key * 101) % 3600 / F.lit(10.0) - 180.0).alias("lon"),
    )


CITIES_SQL = """cities AS (
  SELECT s_name AS name, 'admin-' || CAST(s_suppkey % 17 AS VARCHAR) AS admin1,
    chr(CAST(65 + s_nationkey AS INTEGER)) || chr(CAST(65 + (s_nationkey * 7) % 26 AS INTEGER)) AS cc,
    (s_suppkey * 37) % 1601 / 10e0 - 80e0 AS lat, (s_suppkey * 101) % 3600 / 10e0 - 180e0 AS lon FROM supplier
)"""


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name for every nation; the last few have codes that no city has, so some codes are unknown."""
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    k = F.col("n_nationkey")
    second = F.when(k < 20, F.char(F.lit(65) + (k * 7) % 26)).otherwise(F.lit("0"))
    return n.select(F.concat(F.char(F.lit(65) + k), second).alias("iso2"), F.col("n_name").alias("name"))


COUNTRIES_SQL = """countries AS (
  SELECT chr(CAST(65 + n_nationkey AS INTEGER)) || CASE WHEN n_nationkey < 20 THEN chr(CAST(65 + (n_nationkey * 7) % 26 AS INTEGER)) ELSE '0' END AS iso2, n_name AS name
  FROM nation
)"""


def existing_ports(spark: SparkSession, sf_dir: str, clusters: DataFrame) -> DataFrame:
    """A database of every cluster, by its cells, and of a place for every supplier.

    Of three clusters, one is known by all its cells, one by its first, one by cells of
    another name.  Places lie near some latitudes of clusters and far from others.
    """
    k = F.col("cluster_id") % 3
    cells = F.when(k == 0, F.col("h3_cells")).when(k == 1, F.slice("h3_cells", 1, 1)).otherwise(F.transform("h3_cells", lambda c: F.concat(c, F.lit("x"))))
    known = clusters.select(
        F.col("cluster_id").cast("long").alias("ordinal"),
        F.concat(F.lit("known-"), F.col("cluster_id").cast("string")).alias("harbour_id"),
        cells.alias("h3_cells"),
        F.lit(None).cast("double").alias("centroid_lat"),
        F.lit(None).cast("double").alias("centroid_lon"),
    )
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    k = F.col("s_suppkey")
    near = s.select(
        (k + 1_000_000).alias("ordinal"),
        F.concat(F.lit("near-"), k.cast("string")).alias("harbour_id"),
        F.lit(None).cast("array<string>").alias("h3_cells"),
        (F.lit(53.5) + (k % 9) * F.lit(0.75)).alias("centroid_lat"),
        (F.lit(9.9) + (k % 7) * F.lit(0.3)).alias("centroid_lon"),
    )
    return known.unionByName(near)


EXISTING_SQL = """existing AS (
  SELECT CAST(cluster_id AS BIGINT) AS ordinal, 'known-' || CAST(cluster_id AS VARCHAR) AS harbour_id,
    CASE cluster_id % 3 WHEN 0 THEN h3_cells WHEN 1 THEN h3_cells[1:1] ELSE list_transform(h3_cells, lambda c: c || 'x') END AS h3_cells,
    CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon FROM clusters
  UNION ALL
  SELECT s_suppkey + 1000000, 'near-' || CAST(s_suppkey AS VARCHAR), NULL, 53.5e0 + (s_suppkey % 9) * 0.75e0, 9.9e0 + (s_suppkey % 7) * 0.3e0
  FROM supplier
)"""
