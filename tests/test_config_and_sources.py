import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark import config, session
from tidemark.cli import parser
from tidemark.plans import pipeline
from tidemark.sources import messages

RAW = {"phase1": {"sog_threshold_knots": 0.5, "moored_nav_statuses": [1, 5]}, "phase2": {"min_unique_mmsi": 5}, "phase3": {}, "data": {"raw_glob": "a"}, "gui": {"on": True}}


def test_environment_overrides():
    env = {"PHASE1__SOG_THRESHOLD_KNOTS": "0.7", "PHASE1__MOORED_NAV_STATUSES": "1,5,6", "PHASE2__MIN_UNIQUE_MMSI": "x", "GUI__ON": "no", "RAW_GLOB": "b", "DATA__RAW_GLOB": "c"}
    out = config.overridden(RAW, env)
    assert out["phase1"] == {"sog_threshold_knots": 0.7, "moored_nav_statuses": [1, 5, 6]}
    assert out["phase2"]["min_unique_mmsi"] == "x" and out["gui"]["on"] is False and out["data"]["raw_glob"] == "b"


def test_keys_absent_from_the_file_are_coerced_by_field():
    cfg = config.from_dict(config.overridden(RAW, {"PHASE3__MIN_EVENTS_PER_CLUSTER": "7", "PHASE2__DRAUGHT_CHANGE_THRESHOLD_M": "0.4"}))
    assert cfg.clusters.min_events_per_cluster == 7 and cfg.cells.draught_change_threshold_m == 0.4


def test_both_names_of_the_cluster_size_are_read():
    assert config.from_dict({"phase3": {"min_cells_per_harbour": 4}}).clusters.min_cells_per_cluster == 4


def test_files_and_credentials(tmp_path):
    (tmp_path / "c.yaml").write_text("phase1:\n  max_gap_minutes: 20\n")
    (tmp_path / ".env").write_text("PHASE1__MAX_GAP_MINUTES=25\nEXISTING_DB=db.parquet\n")
    cfg = config.load_config(str(tmp_path / "c.yaml"), {"EXISTING_DB": "real.parquet"}, str(tmp_path / ".env"))
    assert cfg.stops.max_gap_minutes == 25 and cfg.match.existing_db_path == "real.parquet"
    got = config.s3_options({"access_key_id": "file", "secret_access_key": "s", "endpoint_url": "http://x"}, {"AWS_ACCESS_KEY_ID": "env"})
    assert got["spark.hadoop.fs.s3a.access.key"] == "env" and got["spark.hadoop.fs.s3a.endpoint.region"] == "us-east-1"
    assert got["spark.hadoop.fs.s3a.path.style.access"] == "true"


def test_paths():
    assert messages.to_s3a("s3://b/x") == "s3a://b/x"
    assert messages.base_dir("data/raw/**/*.parquet") == ("data/raw/", "*.parquet")
    assert messages.base_dir("data/raw/2024*/a_?.parquet") == ("data/raw/", "a_?.parquet")


def test_reading_messages(spark, tmp_path):
    base = {"mmsi": [123456789], "timestamp": [pd.Timestamp("2024-01-01", tz="UTC")], "lat": [1.0], "lon": [2.0], "sog": [0.1], "nav_status": [5], "msg_type": [1]}
    for sub, extra in (("day=1", {"draught": [None]}), ("day=2", {"draught": [5.5], "ship_type": [70]})):
        (tmp_path / sub).mkdir()
        pd.DataFrame(base | extra).to_parquet(tmp_path / sub / "a.parquet", coerce_timestamps="us")
    (tmp_path / "day=1" / "stray.txt").write_text("no parquet")
    ddl = "mmsi long, timestamp timestamp, lat double, lon double, sog double, nav_status long, msg_type long, draught double, ship_type long"
    got = messages.read_messages(spark, f"{tmp_path}/**/*.parquet", schema=ddl)
    assert sorted((r["draught"] or 0, r["ship_type"] or 0, r["destination"]) for r in got.collect()) == [(0, 0, None), (5.5, 70, None)]
    assert got.dtypes == [("mmsi", "bigint"), ("lat", "double"), ("lon", "double"), ("sog", "double"), ("nav_status", "int"), ("msg_type", "int"), ("draught", "double"), ("destination", "string"), ("ship_type", "int"), ("timestamp", "timestamp")]


def test_renamed_columns_epoch_seconds_and_bad_numbers(spark):
    raw = spark.createDataFrame([("123456789", 1704067200, "x", 2.0, 0.1, 5, 1)], "id string, time long, lat string, lon double, sog double, nav_status int, msg_type int")
    r = messages.canonical(raw, config.Columns(mmsi="id", timestamp="time")).first()
    assert r["mmsi"] == 123456789 and r["lat"] is None and str(r["timestamp"]) == "2024-01-01 00:00:00"
    with pytest.raises(ValueError):
        messages.canonical(raw)


def test_rejected_and_required(spark):
    rows = spark.createDataFrame([(123456789, 1.0, 2.0), (5, 91.0, 2.0), (None, 1.0, 181.0)], "mmsi long, lat double, lon double")
    got = {r["mmsi"]: r["reasons"] for r in messages.rejected(rows).collect()}
    assert got == {5: ["mmsi", "lat"], None: ["mmsi", "lon"]}
    for key, name in ((5, "5"), (None, "null")):
        with pytest.raises(Exception, match=f"invalid stop of vessel {name}"):
            messages.require_valid(rows.where(rows["mmsi"].eqNullSafe(F.lit(key)))).collect()
    assert messages.require_valid(rows.where("mmsi > 5")).count() == 1


def test_scratch_folder(spark):
    assert session.is_local("local[4]") and not session.is_local("local-cluster[2,1,1024]") and not session.is_local("spark://h:7077")
    df = spark.range(10)
    assert session.measured(df) == 10 * session.ROW_BYTES + 10
    for limit, marked in ((10**6, True), (10, False)):
        plan = session.broadcast_within(df, limit)._jdf.queryExecution().logical().toString()
        assert ("broadcast" in plan) == marked
    out = session.materialise(df, "t")
    assert out.count() == 10 and spark.sparkContext.applicationId in out.inputFiles()[0]
    session.drop_scratch(spark)
    with pytest.raises(Exception, match="FAILED_READ_FILE|PATH_NOT_FOUND|does not exist"):
        out.collect()


def test_command_line():
    args = parser().parse_args(["phase5", "--existing-db", "x"])
    assert args.phase == "phase5" and args.existing_db == "x"


def test_phases_end_to_end(spark, tmp_path):
    from datetime import datetime, timedelta

    rows = [(100000000 + v, datetime(2024, 1, 1) + timedelta(minutes=5 * i), 53.54, 9.97, 0.1, 5, 1, 5.0, "DEHAM", 70) for v in range(1, 7) for i in range(10)]
    schema = "mmsi long, timestamp timestamp, lat double, lon double, sog double, nav_status int, msg_type int, draught double, destination string, ship_type int"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "raw"))
    cfg = config.from_dict({"data": {"raw_glob": f"{tmp_path}/raw/*.parquet", "interim_dir": f"{tmp_path}/interim", "output_dir": f"{tmp_path}/out"}})
    gaz = spark.createDataFrame([("Hamburg", "HH", "DE", 53.55, 9.99)], "name string, admin1 string, cc string, lat double, lon double")
    names = spark.createDataFrame([("DE", "Germany")], "iso2 string, name string")
    with pytest.raises(FileNotFoundError, match="phase1"):
        pipeline.run_phase2(spark, cfg)
    table, doc = pipeline.run_all(spark, cfg, gaz, names)
    (r,) = spark.read.parquet(table).collect()
    assert (r["n_events"], r["n_unique_mmsi_approx"], r["country_name"], r["nearest_city"], r["matched_existing"]) == (6, 6, "Germany", "Hamburg", False)
    assert r["harbour_id"].startswith("DE-") and r["geometry_wkt"].startswith("POLYGON")
    again = config.from_dict({"data": cfg.data, "phase5": {"existing_db_path": doc}})
    table, _ = pipeline.run_phase5(spark, again)
    (s,) = spark.read.parquet(table).collect()
    assert s["matched_existing"] and s["harbour_id"] == r["harbour_id"]
