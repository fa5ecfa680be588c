"""Stop extraction, from hand-made messages."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import StopConfig
from tidemark.functions import vessels
from tidemark.operators import stops
from tidemark.streaming.sessions import stop_stream

T0 = datetime(2024, 1, 1)
SCHEMA = "mmsi long, timestamp timestamp, lat double, lon double, sog double, nav_status int, msg_type int, draught double, destination string, ship_type int"
CFG = StopConfig()


def pos(mmsi, minute, sog=0.1, nav=5, lat=53.54, lon=9.97):
    return (mmsi, T0 + timedelta(minutes=minute), lat, lon, sog, nav, 1, None, None, None)


def t5(mmsi, hour, draught, dest=None, ship=None):
    return (mmsi, T0 + timedelta(hours=hour), 10.0, 10.0, 9.0, 0, 5, draught, dest, ship)


@pytest.fixture(scope="module")
def found(spark):
    rows = [pos(123456789, 5 * i) for i in range(24)]  # moored
    rows += [pos(234567890, 5 * i, 8.0, 0) for i in range(24)]  # under way
    rows += [pos(345678901, 5 * i, 0.2, 0, 51.9, 4.47) for i in range(12)]  # slow
    rows += [pos(111111111, 5 * i, 0.3, 0, 50 + 0.01 * i) for i in range(20)]  # drifting
    rows += [pos(400000001, 15 * i) for i in range(3)]  # gaps equal to the limit
    rows += [(400000002, T0 + timedelta(minutes=15 * i, microseconds=i), 53.0, 9.0, 0.1, 5, 1, None, None, None) for i in range(3)]  # just over it
    rows += [pos(400000003, 10 * i, None, 1) for i in range(4)]  # no speed, but anchored
    rows += [pos(400000004, 10 * i, None, None) for i in range(4)]  # nothing known
    rows += [pos(400000005, m) for m in (0, 5, 30)] + [pos(400000005, m, 9.0, 0) for m in (10, 20)]  # gap over the limit between slow rows
    rows += [pos(400000006, m, 0.1, n) for m, n in ((0, 5), (10, 1), (20, 1), (30, 5))]  # tied status
    rows += [pos(99, 5 * i) for i in range(24)] + [pos(500000001, 5 * i, lat=91.0) for i in range(24)]  # out of range
    rows += [pos(600000001, 120 + 10 * i) for i in range(25)]  # 02:00 to 06:00
    rows += [t5(600000001, 1, 5.2, "DEHAM", 70), t5(600000001, 8, 4.1, "NLRTM", 70), t5(600000001, 14, 9.9, "XX", 71)]
    rows += [pos(600000002, 420 + 10 * i) for i in range(4)] + [t5(600000002, 1, 3.0), t5(600000002, 13.5, 3.0), t5(600000002, 13.51, 8.0)]
    rows += [pos(600000003, 120 + 10 * i) for i in range(4)] + [t5(600000003, 1, 6.0, "AAAAA"), t5(600000003, 1.5, 0.0, "BBBBB")]
    rows += [pos(600000004, 120 + 10 * i) for i in range(4)] + [t5(600000004, 1, 6.0, "AAAAA"), t5(600000004, 1, 7.0, "AAAAA")]
    df = spark.createDataFrame(rows, SCHEMA)
    return df, {r["mmsi"]: r for r in stops.extract_stops(df, CFG).collect()}


def test_which_vessels_stop(found):
    assert set(found[1]) == {123456789, 345678901, 400000001, 400000003, 400000006, 600000001, 600000002, 600000003, 600000004}


def test_moored_vessel(found):
    r = found[1][123456789]
    assert (r["duration_minutes"], r["n_messages"], r["detection_method"], r["nav_status"]) == (115.0, 24, "nav_status", 5)


def test_slow_vessel_is_labelled_by_speed(found):
    assert found[1][345678901]["detection_method"] == "sustained_speed"


def test_tied_status_is_the_smallest(found):
    assert found[1][400000006]["nav_status"] == 1


def test_draught_and_destination(found):
    r = found[1][600000001]
    assert [round(r[k], 3) for k in ("draught_arrival", "draught_departure", "draught_delta")] == [5.2, 4.1, -1.1]
    assert (r["destination_raw"], r["destination_locode"], r["ship_type"]) == ("DEHAM", "DEHAM", 70)


def test_lookups_include_their_ends_and_no_more(found):
    r = found[1][600000002]  # 07:00 to 07:30: exactly six hours from 01:00 and to 13:30
    assert (r["draught_arrival"], r["draught_departure"], r["draught_delta"]) == (3.0, 3.0, 0.0)


def test_latest_voyage_counts_even_without_draught(found):
    r = found[1][600000003]
    assert (r["draught_arrival"], r["destination_raw"]) == (None, "BBBBB")


def test_tied_voyages_have_one_answer(found):
    assert found[1][600000004]["draught_arrival"] == 7.0


def test_voyage_rows_that_are_slow_are_positions_too(spark):
    rows = [pos(123456789, 0), pos(123456789, 15), (123456789, T0 + timedelta(minutes=30), 53.54, 9.97, 0.0, 5, 5, 4.0, "DEHAM", 70)]
    r = stops.extract_stops(spark.createDataFrame(rows, SCHEMA), CFG).collect()
    assert [(x["n_messages"], x["draught_departure"]) for x in r] == [(3, 4.0)]


def test_session_windows_agree(found):
    rows = stops.candidates(found[0], CFG)
    a, b = stops.segments(rows, CFG), stops.session_window_segments(rows, CFG)
    cols = ["mmsi", "timestamp_start", "timestamp_end", "n_messages", "nav_status"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())


def test_stream_agrees_with_batch(spark, found, tmp_path):
    found[0].coalesce(1).write.parquet(str(tmp_path / "in"))
    late = spark.createDataFrame([pos(999999998, 60 * 24 * 30)], SCHEMA)  # moves the watermark past all sessions
    late.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = stop_stream(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")), CFG)
    q = stream.writeStream.format("memory").queryName("segs").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.processAllAvailable()
    q.stop()
    want = {r["mmsi"]: r["n_messages"] for r in found[1].values()}
    assert {r["mmsi"]: r["n_messages"] for r in spark.table("segs").collect()} == want


def test_empty_input(spark):
    assert stops.extract_stops(spark.createDataFrame([], SCHEMA), CFG).collect() == []


def test_locodes(spark):
    cases = {"DEHAM": "DEHAM", "DE HAM": "DEHAM", "EN ROUTE DEHAM": "DEHAM", "DEHAM-HAMBURG": "DEHAM", "HAMBURG": None, "": None, None: None, " nlrtm\n": "NLRTM"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "a string, b string")
    assert df.where(~vessels.parse_locode(F.col("a")).eqNullSafe(F.col("b"))).collect() == []


def test_ship_classes(spark):
    cases = [("70", "cargo"), ("85", "tanker"), ("60", "passenger"), ("30", "fishing"), ("36", "recreational"), ("52", "tug_pilot"), ("0", "other"), (None, "unknown"), ("x", "unknown")]
    df = spark.createDataFrame(cases, "a string, b string")
    assert df.where(vessels.ship_class(F.col("a")) != F.col("b")).collect() == []


def test_one_pass_equals_its_parts(spark):
    import random

    rng = random.Random(3)
    rows = []
    for v in range(12):
        for _ in range(80):
            minute = rng.randint(0, 900)  # times tie
            kind = rng.choice([1, 1, 1, 5])
            rows.append((100000000 + v, T0 + timedelta(minutes=minute), 53.5 + rng.random() / 1000, 9.9, rng.choice([0.1, 0.2, 3.0, None]), rng.choice([0, 1, 5, None]), kind, rng.choice([None, -1.0, 0.0, 4.5, 6.0]), rng.choice([None, "DEHAM", "NLRTM"]), rng.choice([None, 0, 70, 80])))
    m = spark.createDataFrame(rows, SCHEMA)
    cfg = StopConfig(draught_lookup_hours=1.0)
    parts = stops.with_voyages(stops.label(stops.segments(stops.candidates(m, cfg), cfg), cfg), stops.voyages(m, cfg), cfg)
    short = lambda df: sorted(str([round(x, 6) if isinstance(x, float) else x for x in r]) for r in df.collect())
    one = stops.extract_stops(m, cfg)
    assert short(one) == short(schemas.conform(parts, schemas.STOPS)) and one.count() > 10
    # Messages move once, by vessel and slice; what moves after that are the slices' summaries.
    plan = stops._pieces(m, cfg, 10**12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("days", [0.01, 0.3, 7.0])
def test_slices_do_not_show(spark, days):
    """Half of all messages are one vessel's; whatever the slices, its stops are those of one slice."""
    import random

    rng = random.Random(8)
    rows = []
    for k in range(3000):
        vessel = 100_000_001 if k % 2 else 100_000_001 + rng.randrange(1, 6)
        voyage = rng.random() < 0.15
        minute = rng.choice([rng.randrange(20_000), rng.randrange(40) * 500])
        status, speed = rng.choice([None, 1, 5, 8]), rng.choice([0.1, 0.2, 4.0, None])
        rows.append((vessel, 60 * minute - 300_000, 53.5 + rng.random() * 1e-4, 9.9 + rng.random() * 1e-4, speed, status, 5 if voyage else 1, rng.choice([None, 0.0, 4.5, 5.5]) if voyage else None, rng.choice(["DEHAM", None, "NLRTM"]) if voyage else None, rng.choice([70, 80, 0, None])))
    df = spark.createDataFrame(rows, "mmsi long, t long, lat double, lon double, sog double, nav_status int, msg_type int, draught double, destination string, ship_type int")
    df = df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t")
    cfg = StopConfig(max_gap_minutes=90.0, min_stop_duration_minutes=1.0, min_messages_per_stop=2)
    cut, whole = (sorted((tuple(round(x, 4) if isinstance(x, float) else x for x in r) for r in stops.extract_stops(df, cfg, d).collect()), key=str) for d in (days, 1e5))
    assert len(whole) > 100 and cut == whole
    # The plain operators, one vessel to a task, find the same segments.
    segs = stops.segments(stops.candidates(df, cfg), cfg)
    plain = sorted((r["mmsi"], r["timestamp_start"], r["timestamp_end"], r["n_messages"], r["nav_status"]) for r in stops.with_voyages(segs, stops.voyages(df, cfg), cfg).collect())
    assert plain == sorted((r["mmsi"], r["timestamp_start"], r["timestamp_end"], r["n_messages"], r["nav_status"]) for r in stops.extract_stops(df, cfg, days).collect())


def test_a_vessel_is_spread_over_tasks(spark):
    rows = [(100_000_001, k * 3600, 53.5, 9.9, 0.1, 5, 1, None, None, None) for k in range(2400)]
    df = spark.createDataFrame(rows, "mmsi long, t long, lat double, lon double, sog double, nav_status int, msg_type int, draught double, destination string, ship_type int")
    pieces = stops._pieces(df.withColumn("timestamp", F.timestamp_seconds("t")).drop("t"), StopConfig(), 10 * 86_400_000_000)
    assert [r["n"] for r in pieces.collect()] and sorted(r["n"] for r in pieces.groupBy("_slice").agg(F.sum("n").alias("n")).collect()) == [240] * 10
    assert "hashpartitioning(mmsi" in pieces._jdf.queryExecution().executedPlan().toString() and "_slice" in pieces._jdf.queryExecution().executedPlan().toString().split("hashpartitioning(mmsi")[1][:40]
