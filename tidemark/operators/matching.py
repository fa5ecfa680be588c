"""Phase 5: port ids, reused from an existing database where a cluster matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import MatchConfig
from tidemark.functions.geo import EARTH_RADIUS_M, haversine_meters
from tidemark.functions.vessels import jaccard, port_id
from tidemark.session import materialise


def by_cells(clusters: DataFrame, existing: DataFrame, threshold: float) -> DataFrame:
    """``(cluster_id, harbour_id)`` by overlap of cells.

    A cell belongs to the last database row that lists it.  The id with most of a
    cluster's cells is the candidate (ties: the earliest row); the first row with
    that id must then reach the Jaccard threshold.  ``existing`` has ``ordinal``.
    """
    listed = existing.where("h3_cells IS NOT NULL").select("ordinal", "harbour_id", F.explode_outer("h3_cells").alias("cell"))
    owner = listed.where("cell IS NOT NULL").groupBy("cell").agg(F.max(F.struct("ordinal", "harbour_id")).alias("o"))
    rows = existing.groupBy("harbour_id").agg(F.min(F.struct("ordinal", F.coalesce("h3_cells", F.array().cast("array<string>")).alias("cells"))).alias("r"))
    mine = clusters.select("cluster_id", F.explode_outer(F.array_distinct("h3_cells")).alias("cell")).where("cell IS NOT NULL")
    votes = mine.join(owner, "cell").groupBy("cluster_id", F.col("o.harbour_id").alias("harbour_id")).agg(F.count("*").alias("n"))
    votes = votes.join(rows, "harbour_id")
    best = votes.groupBy("cluster_id").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("r.ordinal").alias("ordinal"), "harbour_id")).alias("b"))
    both = best.select("cluster_id", "b.harbour_id").join(rows, "harbour_id").join(clusters.select("cluster_id", "h3_cells"), "cluster_id")
    return both.where((F.size("r.cells") > 0) & (jaccard(F.col("h3_cells"), F.col("r.cells")) >= threshold)).select("cluster_id", "harbour_id")


def by_distance(clusters: DataFrame, existing: DataFrame, meters: float) -> DataFrame:
    """``(cluster_id, harbour_id)``: the first database row, in its order, within the distance.

    An equi join on bands of latitude as wide as the distance, three to a cluster:
    nothing within reach lies elsewhere.
    """
    band = max(meters, 1.0) / EARTH_RADIUS_M * 57.29577951308232 * 1.0001
    at = lambda c: F.floor((F.col(c) + 90.0) / band).cast("long")
    known = existing.where("centroid_lat IS NOT NULL AND centroid_lon IS NOT NULL")
    known = known.select("ordinal", "harbour_id", F.col("centroid_lat").alias("lat"), F.col("centroid_lon").alias("lon"), at("centroid_lat").alias("band"))
    mine = clusters.select("cluster_id", "centroid_lat", "centroid_lon", F.explode(F.array(*[at("centroid_lat") + d for d in (-1, 0, 1)])).alias("band"))
    near = mine.join(known, "band").where(haversine_meters(F.col("centroid_lat"), F.col("centroid_lon"), F.col("lat"), F.col("lon")) <= meters)
    return near.groupBy("cluster_id").agg(F.min(F.struct("ordinal", "harbour_id"))["harbour_id"].alias("harbour_id"))


def assign_ids(enriched: DataFrame, existing: DataFrame | None = None, cfg: MatchConfig | None = None) -> DataFrame:
    """``enriched`` with ``harbour_id`` and ``matched_existing``.  Cells decide before distance; an empty id is no match."""
    cfg = cfg or MatchConfig()
    fresh = port_id(F.col("centroid_h3_r8"), F.col("country_iso2"))
    if existing is None:
        return enriched.withColumns({"harbour_id": fresh, "matched_existing": F.lit(False)})
    enriched = materialise(enriched, "enriched")  # read three times
    a = by_cells(enriched, existing, cfg.h3_jaccard_threshold).select(F.col("cluster_id").alias("_a"), F.col("harbour_id").alias("_a_id"))
    b = by_distance(enriched, existing, cfg.centroid_match_distance_meters).select(F.col("cluster_id").alias("_b"), F.col("harbour_id").alias("_b_id"))
    out = enriched.join(a, F.col("cluster_id") == F.col("_a"), "left").join(b, F.col("cluster_id") == F.col("_b"), "left")
    found = F.coalesce("_a_id", "_b_id")
    matched = F.coalesce(found != "", F.lit(False))
    out = out.withColumns({"harbour_id": F.when(matched, found).otherwise(fresh), "matched_existing": matched})
    return out.drop("_a", "_b", "_a_id", "_b_id")


def identify(enriched: DataFrame, existing: DataFrame | None = None, cfg: MatchConfig | None = None) -> DataFrame:
    """Ports in the 16 columns of the contract."""
    return schemas.conform(assign_ids(enriched, existing, cfg), schemas.PORTS)
