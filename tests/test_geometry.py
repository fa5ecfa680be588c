"""Texts of geometries, centroids of all kinds, and the document written in parts."""

import json

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.geo import geometry_centroid
from tidemark.functions.wkt import geojson
from tidemark.plans.shapes import SHAPES, TEXTS
from tidemark.sinks import export


def test_texts(spark):
    df = spark.createDataFrame([(i, t and t.replace("#", "9")) for i, (t, _) in enumerate(TEXTS)], "i int, t string")
    got = {r["i"]: r["g"] for r in df.select("i", geojson(F.col("t")).alias("g")).collect()}
    assert got == {i: j and j.replace("#", "9") for i, (_, j) in enumerate(TEXTS)}
    assert all(json.loads(g) for g in got.values() if g)


def test_long_texts(spark):
    ring = ", ".join(f"{i} {i % 7}" for i in range(50_000)) + ", 0 0"
    df = spark.createDataFrame([(f"POLYGON (({ring}))",), (f"POLYGON (({ring}, 5 5))",)], "t string")
    good, open_ = (r[0] for r in df.select(geojson(F.col("t"))).collect())
    assert len(json.loads(good)["coordinates"][0]) == 50_001 and open_ is None


def test_centroids(spark):
    df = spark.createDataFrame([(i, g and g.replace("#", "0")) for i, (g, _) in enumerate(SHAPES)], "i int, g string")
    for r in df.select("i", geometry_centroid(F.col("g")).alias("c")).collect():
        want = SHAPES[r["i"]][1]
        assert (r["c"] is None) if want is None else all(abs(a - b) < 1e-12 for a, b in zip(r["c"], want, strict=True)), SHAPES[r["i"]]


def test_document_in_parts_with_a_broken_outline(spark, tmp_path):
    rows = [(i, "POLYGON (oops" if i == 3 else None if i == 4 else f"POLYGON (({i} 0, {i + 1} 0, {i} 1, {i} 0))", f"É-{i}") for i in range(200)]
    ports = schemas.conform(spark.createDataFrame(rows, "cluster_id int, geometry_wkt string, harbour_id string").repartition(9), schemas.PORTS)
    path = str(tmp_path / "p.geojson")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert export.write_geojson(ports, path) == {"n_features": 200, "n_unreadable": 1}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    text = (tmp_path / "p.geojson").read_text()
    doc = json.loads(text)
    assert [f["properties"]["harbour_id"] for f in doc["features"]] == [f"É-{i}" for i in range(200)]
    assert [k for k, f in enumerate(doc["features"]) if f["geometry"] is None] == [3, 4]
    assert text == json.dumps(doc, ensure_ascii=False, indent=2) + "\n"
    assert sorted(x.name for x in tmp_path.iterdir() if not x.name.startswith(".")) == ["p.geojson"]


def documents(rng, n):
    text = lambda: "".join(rng.choice(['a', '{', '}', '[', ']', '"', "\\", "é", ",", ":", " ", "\n"]) for _ in range(rng.randrange(12)))
    made = []
    for i in range(n):
        props = {"harbour_id": f"p{i}", "note": text(), "more": [{"x": text()}, []], "h3_cells": [text()], "centroid_lat": float(i), "centroid_lon": -float(i)}
        made.append({"type": "Feature", "geometry": {"type": "Point", "coordinates": [i, 1]}, "properties": props})
    made[n // 2]["properties"]["note"] = "long } " * 3000
    return {"type": "FeatureCollection", "name": text(), "crs": {"type": "name", "properties": {"name": text()}}, "features": made, "bbox": [0, 1, 2, 3], "after": {"x": {"y": {}}}}


def test_features_by_ranges_of_bytes(spark, tmp_path):
    import random

    from tidemark.sources import geojson as source

    rng = random.Random(6)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for k, (bytes_, style) in enumerate([("3000", {"indent": 2}), ("700", {"separators": (",", ":")}), ("128m", {"ensure_ascii": False})]):
            spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_)
            doc = documents(rng, 120)
            path = tmp_path / f"{k}.geojson"
            path.write_text(json.dumps(doc, **style) + "\n" * (k % 2))
            rows = source.features(spark, str(path)).orderBy("ordinal").collect()
            assert [json.loads(r["feature"]) for r in rows] == doc["features"]
            if bytes_ != "128m":
                assert len({r["ordinal"]["block"] for r in rows}) > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


def test_cut_and_empty_documents(spark, tmp_path):
    import pytest

    from tidemark.sources import geojson as source

    text = json.dumps(documents(__import__("random").Random(7), 5))
    for bad in (text[:-1], text[: len(text) // 2], text + "}", "[" + text, '{"features": [{"a": "x'):
        (tmp_path / "bad.geojson").write_text(bad)
        with pytest.raises(ValueError, match="no JSON document"):
            source.features(spark, str(tmp_path / "bad.geojson"))
    (tmp_path / "none.geojson").write_text('{"type": "FeatureCollection", "features": []}')
    assert source.features(spark, str(tmp_path / "none.geojson")).count() == 0
