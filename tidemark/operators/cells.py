"""Phase 2: traffic per hexagonal cell."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import CellConfig
from tidemark.functions import grid
from tidemark.functions.vessels import SHIP_CLASSES, ship_class


def assign_cells(stops: DataFrame, cfg: CellConfig) -> DataFrame:
    return stops.withColumn("h3_cell", grid.cell_at(F.col("lat"), F.col("lon"), cfg.h3_resolution))


def draught_changed(cfg: CellConfig) -> Column:
    """Compared as 32-bit floats, which draughts are."""
    return F.coalesce(F.abs("draught_delta") >= F.lit(cfg.draught_change_threshold_m).cast("float"), F.lit(False))


def aggregate(stops: DataFrame, cfg: CellConfig) -> DataFrame:
    """One row per cell.

    Two levels: per cell and vessel, then per cell.  The first folds a busy vessel's
    stops before the second shuffle, and gives exact vessel counts without a
    distinct aggregate.
    """
    flagged = stops.withColumns({"_class": ship_class(F.col("ship_type")), "_changed": draught_changed(cfg)})
    classes = [name for name, _, _ in SHIP_CLASSES]
    real = F.col("destination_locode").isNotNull() & (F.col("destination_locode") != "")
    # Destinations keep their counts through both levels.
    by_code = flagged.where(real).groupBy("h3_cell", "destination_locode").agg(F.count("*").alias("n"))
    top = by_code.groupBy("h3_cell").agg(F.min(F.struct((-F.col("n")).alias("n"), "destination_locode"))["destination_locode"].alias("top_destination_locode"))
    per_vessel = flagged.groupBy("h3_cell", "mmsi").agg(
        F.count("mmsi").alias("visits"),
        F.sum(F.col("duration_minutes").cast("double")).alias("duration"),
        F.count("duration_minutes").alias("durations"),
        F.count_if("_changed").alias("changes"),
        *[F.count_if(F.col("_class") == c).alias(c) for c in classes],
    )
    cells = per_vessel.groupBy("h3_cell").agg(
        F.count("mmsi").alias("n_unique_mmsi"),
        F.sum("visits").alias("n_events"),
        F.sum("duration").alias("total_duration_minutes"),
        (F.sum("duration") / F.sum("durations")).alias("mean_duration_minutes"),
        F.sum("changes").alias("n_draught_changes"),
        F.max("visits").alias("max_visits_per_mmsi"),
        F.avg("visits").alias("mean_visits_per_mmsi"),
        *[F.sum(c).alias(f"n_{c}") for c in classes],
    )
    cells = cells.join(top, "h3_cell", "left").withColumn("_c", grid.centre(F.col("h3_cell")))
    return schemas.conform(cells.withColumns({"cell_lat": F.col("_c.lat"), "cell_lon": F.col("_c.lon")}), schemas.CELLS)


def hot_cells(cells: DataFrame, cfg: CellConfig) -> DataFrame:
    return cells.where(F.col("n_unique_mmsi") >= cfg.min_unique_mmsi)


def count_cells(stops: DataFrame, cfg: CellConfig | None = None) -> DataFrame:
    """Cells with enough vessels, in the 17 columns of the contract."""
    cfg = cfg or CellConfig()
    located = assign_cells(stops, cfg).where(F.col("h3_cell").isNotNull())
    return hot_cells(aggregate(located, cfg), cfg)
