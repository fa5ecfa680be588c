"""One query per operator over the test tables.

Times are given as microseconds and measures rounded, so that other engines can
be compared value by value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import grid, vessels
from tidemark.functions.geo import bounds, haversine_meters, ring_centroid, spread_meters
from tidemark.operators import browse, cells, clusters, enrich, matching, polygons, stops
from tidemark.operators.components import connected_components
from tidemark.plans import adapter
from tidemark.session import materialise
from tidemark.sinks import export
from tidemark.sources.messages import rejected

CFG = adapter.CONFIG
RES, K = CFG.cells.h3_resolution, CFG.clusters.cluster_ring_size


def us(c: str, name: str) -> Column:
    return F.unix_micros(c).alias(name)


def r3(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 3)


def _messages(spark: SparkSession, d: str) -> DataFrame:
    return adapter.messages(spark, d)


def _segments(spark, d) -> DataFrame:
    return stops.segments(stops.candidates(_messages(spark, d), CFG.stops), CFG.stops)


def _stops(spark, d) -> DataFrame:
    return stops.extract_stops(_messages(spark, d), CFG.stops)


def _located(spark, d) -> DataFrame:
    return cells.assign_cells(_stops(spark, d), CFG.cells)


def _counts(spark, d) -> DataFrame:
    return cells.aggregate(_located(spark, d), CFG.cells)


def _hot(spark, d) -> DataFrame:
    return materialise(cells.hot_cells(_counts(spark, d), CFG.cells), "hot")


def _clusters(spark, d) -> DataFrame:
    return clusters.form_clusters(_hot(spark, d), CFG.clusters, CFG.cells)


def _shown_segments(df: DataFrame) -> DataFrame:
    return df.select(
        "mmsi", us("timestamp_start", "start_us"), us("timestamp_end", "end_us"), F.col("n_messages").cast("long").alias("n_messages"),
        r3("duration_minutes").alias("duration_minutes"), r3("pos_variance_meters").alias("spread_m"), r3("lat").alias("lat"),
        r3("lon").alias("lon"), F.col("nav_status").cast("int").alias("nav_status"),
    )


def candidates(spark, d):
    out = stops.candidates(_messages(spark, d), CFG.stops)
    return out.select("mmsi", us("timestamp", "t"), r3("lat").alias("lat"), r3("lon").alias("lon"), "sog", "nav_status")


def type5(spark, d):
    out = stops.voyages(_messages(spark, d), CFG.stops)
    return out.select("mmsi", us("timestamp", "t"), "draught", "destination", "ship_type")


def rejected_messages(spark, d):
    """Ranges narrowed so that some messages break them."""
    out = rejected(_messages(spark, d), 100_000_005, 100_000_100)
    return out.groupBy("mmsi", F.array_join("reasons", ",").alias("reasons")).agg(F.count("*").alias("n"))


def stop_sessions(spark, d):
    out = stops.sessions(stops.candidates(_messages(spark, d), CFG.stops), CFG.stops)
    return out.groupBy("mmsi", F.col("segment").cast("long").alias("segment")).agg(F.count("*").alias("n"))


def stop_segments(spark, d):
    return _shown_segments(_segments(spark, d))


def session_window_segments(spark, d):
    return _shown_segments(stops.session_window_segments(stops.candidates(_messages(spark, d), CFG.stops), CFG.stops))


def detection_method(spark, d):
    out = stops.label(_segments(spark, d), CFG.stops)
    return out.select("mmsi", us("timestamp_start", "start_us"), "detection_method")


def asof_draught(spark, d):
    return _stops(spark, d).select(
        "mmsi", us("timestamp_start", "start_us"), us("timestamp_end", "end_us"), r3("draught_arrival").alias("draught_arrival"),
        r3("draught_departure").alias("draught_departure"), r3("draught_delta").alias("draught_delta"), "destination_raw",
        "destination_locode", F.col("ship_type").cast("int").alias("ship_type"), "detection_method",
    )


def ship_type_mode(spark, d):
    return stops.ship_types(stops.voyages(_messages(spark, d), CFG.stops)).select("mmsi", "ship_type")


def parse_locode(spark, d):
    return _messages(spark, d).groupBy("destination", vessels.parse_locode(F.col("destination")).alias("locode")).agg(F.count("*").alias("n"))


def classify_ship_type(spark, d):
    return _messages(spark, d).groupBy("ship_type", vessels.ship_class(F.col("ship_type")).alias("ship_class")).agg(F.count("*").alias("n"))


def positional_spread(spark, d):
    return _messages(spark, d).groupBy("mmsi").agg(r3(spread_meters(F.col("lat"), F.col("lon"))).alias("spread_m"))


def haversine(spark, d):
    c = adapter.cities(spark, d)
    return c.select("name", r3(haversine_meters(F.lit(53.54), F.lit(9.97), F.col("lat"), F.col("lon")) / 1000).alias("km"))


def cell_assign(spark, d):
    out = _messages(spark, d).select(grid.cell_at(F.col("lat"), F.col("lon"), RES).alias("h3_cell"), grid.cell_at(F.col("lat"), F.col("lon"), RES - 3).alias("coarse"))
    return out.groupBy("h3_cell", "coarse").agg(F.count("*").alias("n"))


def cell_parents(spark, d):
    """Messages per cell of three coarser resolutions: parents are cut from addresses, no place is looked at again."""
    out = _messages(spark, d).select(grid.cell_at(F.col("lat"), F.col("lon"), RES).alias("c")).groupBy("c").agg(F.count("*").alias("n"))
    levels = F.explode(F.array(*[F.struct(F.lit(r).alias("resolution"), grid.parent(F.col("c"), r).alias("cell")) for r in (8, 5, 0)]))
    return out.select("n", levels.alias("p")).groupBy("p.resolution", "p.cell").agg(F.sum("n").alias("n"), F.count("*").alias("n_cells"))


def cell_centre(spark, d):
    c = adapter.cities(spark, d).select(grid.cell_at(F.col("lat"), F.col("lon"), RES).alias("h3_cell")).distinct()
    c = c.withColumn("c", grid.centre(F.col("h3_cell")))
    return c.select("h3_cell", F.round("c.lat", 6).alias("lat"), F.round("c.lon", 6).alias("lon"))


def grid_disk(spark, d):
    return clusters.disks(_hot(spark, d), RES, K)


def cell_counts(spark, d):
    c = _counts(spark, d)
    n = [x for x in c.columns if x.startswith("n_")]
    return c.select(
        "h3_cell", *[F.col(x).cast("long").alias(x) for x in n], r3("total_duration_minutes").alias("total_duration_minutes"),
        r3("mean_duration_minutes").alias("mean_duration_minutes"), r3("cell_lat").alias("cell_lat"), r3("cell_lon").alias("cell_lon"),
    )


def cell_visits(spark, d):
    return _counts(spark, d).select("h3_cell", F.col("max_visits_per_mmsi").cast("long").alias("most"), r3("mean_visits_per_mmsi").alias("mean"))


def top_locode(spark, d):
    return _counts(spark, d).select("h3_cell", "top_destination_locode")


def hot_cells(spark, d):
    return _hot(spark, d).select("h3_cell", F.col("n_unique_mmsi").cast("long").alias("n_unique_mmsi"))


def adjacency(spark, d):
    return clusters.adjacency(_hot(spark, d), RES, K)


def components(spark, d):
    return clusters.components(_hot(spark, d), RES, K)


def connected_parts(spark, d):
    """Components of a graph of parts: chains of ten."""
    s = spark.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("src"))
    return connected_components(s.select("src", (F.col("src") - F.col("src") % 10 + F.greatest(F.col("src") % 10 - 1, F.lit(0))).alias("dst")))


def _shown_clusters(c: DataFrame) -> DataFrame:
    return c.select(
        *[F.col(x).cast("long").alias(x) for x in ("cluster_id", "n_cells", "n_events", "n_unique_mmsi_approx", "n_draught_changes")],
        F.array_join("h3_cells", ",").alias("cells"),
        *[r3(x).alias(x) for x in ("centroid_lat", "centroid_lon", "bbox_min_lat", "bbox_max_lat", "bbox_min_lon", "bbox_max_lon")],
    )


def cluster_stats(spark, d):
    return _shown_clusters(_clusters(spark, d))


def nearest_city(spark, d):
    c = spark.read.parquet(f"{d}/customer.parquet")
    k = F.col("c_custkey")
    places = c.select(k.alias("key"), ((k * 53) % 1701 / F.lit(10.0) - 85.0).alias("lat"), ((k * 211) % 3600 / F.lit(10.0) - 180.0).alias("lon"))
    out = enrich.nearest_city(places, adapter.cities(spark, d), "key", "lat", "lon")
    return out.select("key", r3("nearest_city_dist_km").alias("km"), "nearest_city", "country_iso2", "admin1")


def country_lookup(spark, d):
    c = adapter.cities(spark, d).select(F.col("cc").alias("country_iso2")).distinct()
    return enrich.country_name(c, adapter.countries(spark, d)).select("country_iso2", "country_name")


def jaccard(spark, d):
    c = _clusters(spark, d).select("cluster_id", F.col("h3_cells").alias("a"), F.slice("h3_cells", 1, 2).alias("b"))
    return c.select(F.col("cluster_id").cast("long").alias("cluster_id"), F.round(vessels.jaccard(F.col("a"), F.col("b")), 6).alias("score"))


def cells_match(spark, d):
    c = materialise(_clusters(spark, d), "clusters")
    out = matching.by_cells(c, adapter.existing_ports(spark, d, c), CFG.match.h3_jaccard_threshold)
    return out.select(F.col("cluster_id").cast("long").alias("cluster_id"), "harbour_id")


def centroid_match(spark, d):
    c = materialise(_clusters(spark, d), "clusters")
    out = matching.by_distance(c, adapter.existing_ports(spark, d, c), CFG.match.centroid_match_distance_meters)
    return out.select(F.col("cluster_id").cast("long").alias("cluster_id"), "harbour_id")


def port_id(spark, d):
    c = adapter.cities(spark, d)
    return c.select("name", vessels.port_id(F.col("name"), F.when(F.col("cc") < "K", F.col("cc"))).alias("harbour_id"))


def _ports(spark, d) -> DataFrame:
    c = materialise(_clusters(spark, d), "clusters")
    made = enrich.enrich(c, adapter.cities(spark, d), adapter.countries(spark, d), CFG.enrich, CFG.cells)
    return matching.identify(made, adapter.existing_ports(spark, d, c), CFG.match)


def ports(spark, d):
    out = _ports(spark, d)
    return out.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), "harbour_id", "matched_existing", "country_iso2", "country_name", F.round(F.col("nearest_city_dist_km").cast("double"), 1).alias("km"),
    )


def cluster_outline(spark, d):
    """Outlines; string work over rings, without SQL."""
    out = polygons.add_polygons(_clusters(spark, d), RES)
    return browse.with_bounds(out.select("cluster_id", "geometry_wkt"))


def geojson_export(spark, d):
    """The features of the final document, without SQL because they hold outlines."""
    return export.features(_ports(spark, d))


def browse_search_sort(spark, d):
    shown = browse.display(_ports(spark, d))
    out = browse.search(shown, "admin-1|nation_1")
    cols = [F.col(c).alias(c.lower()) for c in ("Country", "Events", "Vessels", "Cells")]
    return browse.ordered(out, "Events").select(F.col("_idx").cast("long").alias("idx"), *cols)


def ring_centroid_bounds(spark, d):
    n = spark.read.parquet(f"{d}/nation.parquet")
    k = F.col("n_nationkey").cast("double")
    pt = lambda x, y: F.array(k + F.lit(float(x)), k / 2 + F.lit(float(y)))
    ring = F.array(pt(0, 0), pt(4, 0), pt(4, 2), pt(0, 2), pt(0, 0))
    out = n.select("n_nationkey", ring_centroid(ring).alias("c"), bounds(ring).alias("b"))
    return out.select("n_nationkey", r3("c.lon").alias("lon"), r3("c.lat").alias("lat"), "b.*")


QUERIES = {
    f.__name__: f
    for f in (
        candidates, type5, rejected_messages, stop_sessions, stop_segments, session_window_segments, detection_method, asof_draught,
        ship_type_mode, parse_locode, classify_ship_type, positional_spread, haversine, cell_assign, cell_parents, cell_centre, grid_disk, cell_counts,
        cell_visits, top_locode, hot_cells, adjacency, components, connected_parts, cluster_stats, nearest_city, country_lookup, jaccard,
        cells_match, centroid_match, port_id, ports, cluster_outline, geojson_export, browse_search_sort, ring_centroid_bounds,
    )
}
