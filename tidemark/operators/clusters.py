"""Phase 3: hot cells that lie close together become clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import CellConfig, ClusterConfig
from tidemark.functions import grid
from tidemark.operators.components import connected_components
from tidemark.operators.scans import ranked
from tidemark.session import materialise


def disks(cells: DataFrame, resolution: int, k: int) -> DataFrame:
    """``(h3_cell, near)``: the cells within ``k`` rings of each; near a pentagon they are found ring by ring."""
    if k < 2:
        return cells.select("h3_cell", F.explode_outer(grid.disk(F.col("h3_cell"), resolution, k)).alias("near"))
    around = grid.near_pentagon(F.col("h3_cell"), resolution, k)
    flat = lambda c: c.select("h3_cell", F.explode_outer(grid.disk(F.col("h3_cell"), resolution, k)).alias("near"))
    # Hardly a set of cells has any near the twelve: then the plan is spared what grows rings.
    if cells.where(around).isEmpty():
        return flat(cells)
    grown = cells.where(around).select("h3_cell", F.col("h3_cell").alias("near"))
    for _ in range(k):
        grown = grown.select("h3_cell", F.explode_outer(grid.disk(F.col("near"), resolution, 1)).alias("near")).distinct()
    return flat(cells.where(~around)).unionByName(grown)


def adjacency(cells: DataFrame, resolution: int, k: int = 1) -> DataFrame:
    """``(src, dst)``: pairs of hot cells within ``k`` rings, both ways, without self loops."""
    near = disks(cells.select("h3_cell"), resolution, k).toDF("src", "dst")
    hot = cells.select(F.col("h3_cell").alias("dst"))
    return near.join(hot, "dst").where("src <> dst").select("src", "dst")


def components(cells: DataFrame, resolution: int, k: int = 1) -> DataFrame:
    """``(h3_cell, component)``; the component is its least cell.  A cell without neighbours is its own."""
    linked = connected_components(adjacency(cells, resolution, k))
    out = cells.select("h3_cell").join(linked, F.col("h3_cell") == F.col("node"), "left")
    return out.select("h3_cell", F.coalesce("component", "h3_cell").alias("component"))


def cluster_stats(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """Sums, weighted centroid and bounds per component.

    Vessels are summed over cells, so one that stops in several counts several
    times.  Means of longitude are planar and do not respect the antimeridian.
    """
    w = F.col("n_events")
    weight = F.when(F.sum(w) == 0, F.lit(1)).otherwise(F.sum(w))
    return cells.join(parts, "h3_cell").groupBy("component").agg(
        F.array_sort(F.collect_list("h3_cell")).alias("h3_cells"),
        F.count("*").alias("n_cells"),
        F.sum("n_events").alias("n_events"),
        F.sum("n_unique_mmsi").alias("n_unique_mmsi_approx"),
        F.sum("n_draught_changes").alias("n_draught_changes"),
        (F.sum(F.col("cell_lat") * w) / weight).alias("centroid_lat"),
        (F.sum(F.col("cell_lon") * w) / weight).alias("centroid_lon"),
        F.min("cell_lat").alias("bbox_min_lat"),
        F.max("cell_lat").alias("bbox_max_lat"),
        F.min("cell_lon").alias("bbox_min_lon"),
        F.max("cell_lon").alias("bbox_max_lon"),
    )


def numbered(stats: DataFrame, cfg: ClusterConfig) -> DataFrame:
    """Clusters that are large enough, numbered from 0 by their least cell."""
    kept = stats.where((F.col("n_cells") >= cfg.min_cells_per_cluster) & (F.col("n_events") >= cfg.min_events_per_cluster))
    kept = materialise(kept, "kept")
    rank = ranked(kept.select("component"), [F.col("component")], "cluster_id")
    return kept.join(rank, "component")


def form_clusters(cells: DataFrame, cfg: ClusterConfig | None = None, grid_cfg: CellConfig | None = None) -> DataFrame:
    """Clusters in the 13 columns of the contract."""
    cfg, grid_cfg = cfg or ClusterConfig(), grid_cfg or CellConfig()
    stats = cluster_stats(cells, components(cells, grid_cfg.h3_resolution, cfg.cluster_ring_size))
    coarse = grid.cell_at(F.col("centroid_lat"), F.col("centroid_lon"), grid_cfg.h3_resolution - 3)
    return schemas.conform(numbered(stats, cfg).withColumn("centroid_h3_r8", coarse), schemas.CLUSTERS)
