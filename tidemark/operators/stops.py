"""Phase 1: stop events from raw messages.

:func:`extract_stops` shuffles the messages once, by vessel and slice of time: position
and voyage (type 5) rows keep their roles as columns, and sessions, the two as-of lookups and
the segments' aggregates all follow on that exchange, whose results are merged over a vessel's slices.  The
other functions are its parts as operators of their own, one vessel to a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark import schemas
from tidemark.config import StopConfig
from tidemark.functions.geo import METERS_PER_DEGREE, spread_meters
from tidemark.functions.vessels import detection_method, parse_locode, positive
from tidemark.session import materialise

MINUTE = 60_000_000


def is_candidate(cfg: StopConfig) -> Column:
    """Slow, or moored by status.  A null speed is no evidence, a null status neither."""
    return (F.col("sog") < cfg.sog_threshold_knots) | F.col("nav_status").isin(*cfg.moored_nav_statuses)


def in_range(cfg: StopConfig) -> Column:
    """Places on the globe and identities in the given range, ends included."""
    return F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0) & F.col("mmsi").between(cfg.mmsi_min, cfg.mmsi_max)


def candidates(messages: DataFrame, cfg: StopConfig) -> DataFrame:
    """Position rows that may belong to a stop, whatever their message type."""
    return messages.where(is_candidate(cfg) & in_range(cfg)).select("mmsi", "timestamp", "lat", "lon", "sog", "nav_status")


def voyages(messages: DataFrame, cfg: StopConfig) -> DataFrame:
    """Type 5 rows."""
    kept = messages.where((F.col("msg_type") == 5) & F.col("mmsi").between(cfg.mmsi_min, cfg.mmsi_max))
    return kept.select("mmsi", "timestamp", "draught", "destination", "ship_type")


def sessions(rows: DataFrame, cfg: StopConfig) -> DataFrame:
    """``rows`` with ``segment``: a new one begins where the gap exceeds the limit."""
    by = Window.partitionBy("mmsi").orderBy("timestamp")
    gap = F.unix_micros("timestamp") - F.unix_micros(F.lag("timestamp").over(by))
    starts = F.when(gap > F.lit(int(cfg.max_gap_minutes * MINUTE)).cast("long"), 1).otherwise(0)
    rows = rows.withColumn("_new", starts)
    return rows.withColumn("segment", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def segments(rows: DataFrame, cfg: StopConfig) -> DataFrame:
    """One row per session that is long, dense and still enough."""
    out = sessions(rows, cfg).groupBy("mmsi", "segment").agg(*_segment_columns())
    return _worthwhile(out, cfg).drop("segment")


def _segment_columns() -> list[Column]:
    minutes = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / F.lit(float(MINUTE))
    return [
        F.avg("lat").alias("lat"),
        F.avg("lon").alias("lon"),
        F.min("timestamp").alias("timestamp_start"),
        F.max("timestamp").alias("timestamp_end"),
        minutes.alias("duration_minutes"),
        F.count(F.lit(1)).alias("n_messages"),
        spread_meters(F.col("lat"), F.col("lon")).alias("pos_variance_meters"),
        F.mode("nav_status", True).alias("nav_status"),
    ]


def _worthwhile(segs: DataFrame, cfg: StopConfig) -> DataFrame:
    return segs.where(
        (F.col("n_messages") >= cfg.min_messages_per_stop)
        & (F.col("duration_minutes") >= cfg.min_stop_duration_minutes)
        & (F.col("pos_variance_meters") <= cfg.positional_variance_max_meters)
    )


def session_window_segments(rows: DataFrame, cfg: StopConfig) -> DataFrame:
    """The same segments through ``session_window``, as a stream would have them."""
    # Rows exactly one gap apart share a session window, as they share a segment.
    gap = f"{int(cfg.max_gap_minutes * MINUTE)} microseconds"
    out = rows.groupBy("mmsi", F.session_window("timestamp", gap).alias("w")).agg(*_segment_columns())
    return _worthwhile(out, cfg).drop("w")


def label(stops: DataFrame, cfg: StopConfig) -> DataFrame:
    """``stops`` with ``detection_method``."""
    return stops.withColumn("detection_method", detection_method(F.col("nav_status"), cfg.moored_nav_statuses))


def asof(left: DataFrame, right: DataFrame, key: str, start: str, end: str, at: str, values: list[str], tolerance_us: int) -> DataFrame:
    """As-of join on both sides of an interval.

    Adds ``before``: the values of the last ``right`` row with ``start - tolerance <=
    at <= start``, and ``after``: those of the first with ``end <= at <= end +
    tolerance``; all ends included.  Rows of equal time are ordered by their values,
    nulls first, so ties give one answer.  ``left`` may have rows without partner;
    both structs are then null.

    The sides are stacked and read through two range frames: one exchange, sorted
    runs that spill, and no pairs.
    """
    mine = [c for c in left.columns if c != key]
    value = F.struct(F.unix_micros(at).alias("at"), *[F.col(v) for v in values])
    a = left.select(key, F.struct(*mine).alias("row"), F.unix_micros(start).alias("s"), F.unix_micros(end).alias("e"), F.lit(None).alias("v"))
    b = right.select(key, F.lit(None).alias("row"), F.unix_micros(at).alias("s"), F.unix_micros(at).alias("e"), value.alias("v"))
    both = a.unionByName(b)
    back = Window.partitionBy(key).orderBy("s").rangeBetween(-tolerance_us, 0)
    ahead = Window.partitionBy(key).orderBy("e").rangeBetween(0, tolerance_us)
    both = both.withColumn("before", F.max("v").over(back)).withColumn("after", F.min("v").over(ahead))
    return both.where("row IS NOT NULL").select(key, "row.*", "before", "after")


def ship_types(type5: DataFrame) -> DataFrame:
    """Each vessel's commonest positive ship type, the smallest if tied: counted by type before vessels meet."""
    known = type5.groupBy("mmsi", positive(F.col("ship_type")).alias("t")).agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("t").isNotNull(), F.struct("n", (-F.col("t")).alias("t"))))
    return known.groupBy("mmsi").agg((-best["t"]).cast(type5.schema["ship_type"].dataType).alias("ship_type"))


def with_voyages(stops: DataFrame, type5: DataFrame, cfg: StopConfig) -> DataFrame:
    """``stops`` with draughts at arrival and departure, destination and ship type."""
    tolerance = int(cfg.draught_lookup_hours * 60 * MINUTE)
    out = asof(stops, type5, "mmsi", "timestamp_start", "timestamp_end", "timestamp", ["draught", "destination"], tolerance)
    # The latest row counts, and only then whether its draught is known.
    arrival, departure = positive(F.col("before.draught")), positive(F.col("after.draught"))
    out = out.withColumns(
        {
            "draught_arrival": arrival,
            "draught_departure": departure,
            "draught_delta": departure - arrival,
            "destination_raw": F.col("before.destination"),
            "destination_locode": parse_locode(F.col("before.destination")),
        }
    )
    return out.drop("before", "after").join(ship_types(type5), "mmsi", "left")


#: Days of a vessel's messages that one task handles at a time.
SLICE_DAYS = 30.0


def _merged(parts: Column) -> Column:
    """A segment's statistics from its pieces ``struct<status, n, lat, lon, dlat, dlon>``: means, and sums of squared deviations about them."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(0.0).alias(k) for k in ("lat", "lon", "dlat", "dlon")])

    def plus(s: Column, p: Column) -> Column:
        n = s["n"] + p["n"]
        mean = lambda k: s[k] + (p[k] - s[k]) * p["n"] / n
        dev = lambda k: s[f"d{k}"] + p[f"d{k}"] + (p[k] - s[k]) * (p[k] - s[k]) * s["n"] * p["n"] / n
        return F.struct(n.alias("n"), mean("lat").alias("lat"), mean("lon").alias("lon"), dev("lat").alias("dlat"), dev("lon").alias("dlon"))

    return F.aggregate(F.array_sort(parts), zero, plus)


def _commonest(parts: Column) -> Column:
    """The status of most rows, the smallest if tied."""
    known = F.array_distinct(F.filter(F.transform(parts, lambda p: p["status"]), lambda s: s.isNotNull()))
    rows = lambda s: F.aggregate(F.filter(parts, lambda p: p["status"] == s), F.lit(0).cast("long"), lambda a, p: a + p["n"])
    return -F.array_max(F.transform(known, lambda s: F.struct(rows(s).alias("n"), (-s).alias("s"))))["s"]


def _pieces(messages: DataFrame, cfg: StopConfig, slice_us: int) -> DataFrame:
    """What each slice of a vessel's messages knows of its own segments, by status: a few rows for any number of messages.

    ``first``, ``last``: times of slow rows; ``before``, ``after``: the last voyage row at or before the first of them, the first
    at or after the last, as far as they lie in the slice; ``v_last``, ``v_first``: of all voyage rows of the slice up to now.
    """
    yes = lambda c: F.coalesce(c, F.lit(False))
    type5, slow = yes(F.col("msg_type") == 5), yes(is_candidate(cfg) & in_range(cfg))
    at = F.unix_micros("timestamp")
    rows = messages.where(F.col("mmsi").between(cfg.mmsi_min, cfg.mmsi_max)).select(
        "mmsi", "lat", "lon", "nav_status", at.alias("_at"), F.expr(f"floor(unix_micros(timestamp) / {slice_us})").alias("_slice"), slow.alias("_slow"),
        F.when(type5, F.struct(at.alias("at"), "draught", "destination")).alias("_v"),
    ).where(F.col("_slow") | F.col("_v").isNotNull())
    part, start = Window.partitionBy("mmsi", "_slice"), Window.unboundedPreceding
    up, down = part.orderBy("_at"), part.orderBy(F.col("_at").desc())
    last = F.max(F.when(F.col("_slow"), F.col("_at"))).over(up.rowsBetween(start, -1))
    rows = rows.withColumn("_before", F.max("_v").over(up.rangeBetween(start, 0)))
    rows = rows.withColumn("_new", F.when(F.col("_slow") & (F.col("_at") - last > int(cfg.max_gap_minutes * MINUTE)), 1).otherwise(0))
    rows = rows.withColumn("_seg", F.sum("_new").over(up.rowsBetween(start, 0)))
    rows = rows.withColumn("_after", F.min("_v").over(down.rangeBetween(start, 0)))
    when = lambda c: F.when(F.col("_slow"), F.col(c))
    square = lambda c: F.coalesce(F.var_pop(when(c)) * F.count(when(c)), F.lit(0.0))
    return rows.groupBy("mmsi", "_slice", "_seg", "nav_status").agg(
        F.count_if("_slow").alias("n"), F.avg(when("lat")).alias("lat"), F.avg(when("lon")).alias("lon"), square("lat").alias("dlat"), square("lon").alias("dlon"),
        F.min(when("_at")).alias("first"), F.max(when("_at")).alias("last"), F.min_by("_before", when("_at")).alias("before"), F.max_by("_after", when("_at")).alias("after"),
        F.max("_v").alias("v_last"), F.min("_v").alias("v_first"),
    )


def _joined(pieces: DataFrame, cfg: StopConfig) -> DataFrame:
    """Pieces of a vessel's segments put together over its slices, of which each gives one row to look through."""
    slices = pieces.groupBy("mmsi", "_slice").agg(
        F.min("first").alias("first"), F.max("last").alias("last"), F.max("_seg").alias("segs"), F.max("v_last").alias("v_last"), F.min("v_first").alias("v_first")
    )
    by, zero = Window.partitionBy("mmsi").orderBy("_slice"), F.lit(0).cast("long")
    past, ahead = by.rowsBetween(Window.unboundedPreceding, -1), by.rowsBetween(1, Window.unboundedFollowing)
    gap = F.col("first") - F.max("last").over(past) > int(cfg.max_gap_minutes * MINUTE)
    slices = slices.withColumn("_more", F.col("segs") + F.coalesce(gap, F.lit(False)).cast("int"))
    # A slice's first segment goes on with the last of the slice before unless there is a gap.
    slices = slices.select(
        F.col("mmsi").alias("s_mmsi"), F.col("_slice").alias("s_slice"), (F.coalesce(F.sum("_more").over(past), zero) + F.col("_more") - F.col("segs")).alias("s_start"),
        F.max("v_last").over(past).alias("s_before"), F.min("v_first").over(ahead).alias("s_after"),
    )
    both = pieces.where("n > 0").join(slices, F.expr("mmsi = s_mmsi AND _slice = s_slice"))
    both = both.withColumns({"segment": F.col("s_start") + F.col("_seg"), "before": F.coalesce("before", "s_before"), "after": F.coalesce("after", "s_after")})
    part = F.struct(F.col("first").alias("at"), F.col("nav_status").alias("status"), "n", "lat", "lon", "dlat", "dlon")
    segs = both.groupBy("mmsi", "segment").agg(
        F.collect_list(part).alias("_parts"), F.min("first").alias("first"), F.max("last").alias("last"), F.min_by("before", "first").alias("_before"), F.max_by("after", "last").alias("_after")
    )
    segs = segs.withColumn("_m", _merged(F.col("_parts")))
    side = lambda k: F.sqrt(F.col(f"_m.d{k}") / F.col("_m.n")) * METERS_PER_DEGREE
    north, east = side("lat"), side("lon") * F.abs(F.cos(F.radians("_m.lat")))
    return segs.select(
        "mmsi", "segment", "_m.lat", "_m.lon", F.timestamp_micros("first").alias("timestamp_start"), F.timestamp_micros("last").alias("timestamp_end"),
        ((F.col("last") - F.col("first")) / F.lit(float(MINUTE))).alias("duration_minutes"), F.col("_m.n").alias("n_messages"),
        F.sqrt(north * north + east * east).alias("pos_variance_meters"), _commonest(F.col("_parts")).alias("nav_status"), "_before", "_after",
    )


def extract_stops(messages: DataFrame, cfg: StopConfig | None = None, slice_days: float = SLICE_DAYS) -> DataFrame:
    """Stop events in the 16 columns of the contract.

    A vessel's messages are cut into slices of time, each of which is sorted and summarised by itself, so a vessel that sends
    a third of all messages is spread over as many tasks as it has slices.  Within a slice the last voyage at or
    before a row is a running maximum, the first at or after it a running minimum in the other direction.  The
    summaries (:func:`_pieces`), a few rows a segment, are written once; what they lack, the last row and the voyages of the slices before and after,
    comes from a window over one row a slice (:func:`_joined`).  Ship types are counted from voyage rows alone.
    """
    cfg = cfg or StopConfig()
    pieces = materialise(_pieces(messages, cfg, int(slice_days * 1440 * MINUTE)), "pieces")
    segs = label(_worthwhile(_joined(pieces, cfg), cfg), cfg)
    tolerance = int(cfg.draught_lookup_hours * 60 * MINUTE)
    before = F.when(F.col("_before.at") >= F.unix_micros("timestamp_start") - tolerance, F.col("_before"))
    after = F.when(F.col("_after.at") <= F.unix_micros("timestamp_end") + tolerance, F.col("_after"))
    arrival, departure = positive(before["draught"]), positive(after["draught"])
    types = ship_types(voyages(messages, cfg)).withColumnRenamed("mmsi", "t_mmsi")
    out = segs.join(types, F.expr("mmsi = t_mmsi"), "left").withColumns(
        {
            "draught_arrival": arrival,
            "draught_departure": departure,
            "draught_delta": departure - arrival,
            "destination_raw": before["destination"],
            "destination_locode": parse_locode(before["destination"]),
        }
    )
    return schemas.conform(out, schemas.STOPS)
