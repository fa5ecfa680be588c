"""Stop segments from a stream of messages.

The same sessions as the batch operator: a watermark bounds the state, and a
segment is emitted once no message can join it any more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import StopConfig
from tidemark.functions.vessels import detection_method
from tidemark.operators.stops import MINUTE, _worthwhile, candidates
from tidemark.functions.geo import spread_meters


def stop_stream(messages: DataFrame, cfg: StopConfig | None = None, lateness: str = "1 hour") -> DataFrame:
    """Segments of a streaming (or batch) DataFrame of messages, in append mode."""
    cfg = cfg or StopConfig()
    gap = f"{int(cfg.max_gap_minutes * MINUTE)} microseconds"
    rows = candidates(messages, cfg).withWatermark("timestamp", lateness)
    out = rows.groupBy("mmsi", F.session_window("timestamp", gap).alias("w")).agg(
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
        F.min("timestamp").alias("timestamp_start"),
        F.max("timestamp").alias("timestamp_end"),
        ((F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(float(MINUTE))).alias("duration_minutes"),
        F.count(F.lit(1)).alias("n_messages"),
        spread_meters(F.col("lat"), F.col("lon")).alias("pos_variance_meters"),
        F.mode("nav_status", True).alias("nav_status"),
    )
    out = _worthwhile(out, cfg).drop("w")
    return out.withColumn("detection_method", detection_method(F.col("nav_status"), cfg.moored_nav_statuses))
