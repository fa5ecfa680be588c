"""Cells, clusters, enrichment and matching."""

import json
import math
import uuid

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import CellConfig, ClusterConfig, MatchConfig
from tidemark.functions import grid, vessels
from tidemark.functions.geo import haversine_meters
from tidemark.operators import browse, cells, clusters, enrich, matching, polygons
from tidemark.operators.components import connected_components
from tidemark.sinks import export
from tidemark.sources import portdb

HOME = (53.54, 9.97)


def stop(mmsi, lat=HOME[0], lon=HOME[1], delta=None, ship=None, locode=None):
    return (mmsi, lat, lon, 60.0, delta, ship, locode)


def counts(spark, rows, **cfg):
    df = spark.createDataFrame(rows, "mmsi long, lat double, lon double, duration_minutes float, draught_delta float, ship_type short, destination_locode string")
    return cells.count_cells(df, CellConfig(**({"min_unique_mmsi": 1} | cfg))).collect()


def cell_rows(spark, places):
    """``places``: (cell, events)."""
    base = spark.createDataFrame(places, "h3_cell string, n_events int")
    c = base.withColumns({"n_unique_mmsi": F.lit(2), "n_draught_changes": F.lit(2), "_c": grid.centre(F.col("h3_cell"))})
    return schemas.conform(c.withColumns({"cell_lat": F.col("_c.lat"), "cell_lon": F.col("_c.lon")}), schemas.CELLS)


def cell_at(spark, lat, lon, res=11):
    return spark.range(1).select(grid.cell_at(F.lit(lat), F.lit(lon), res)).first()[0]


def disk(spark, cell, k=1):
    return sorted(spark.range(1).select(grid.disk(F.lit(cell), 11, k)).first()[0])


def test_cell_statistics(spark):
    rows = [stop(1, delta=1.2, ship=70, locode="DEHAM"), stop(1, delta=0.1, ship=80, locode="NLRTM"), stop(1, delta=-0.8, ship=None, locode="DEHAM"), stop(2, ship=60, locode="")]
    (r,) = counts(spark, rows)
    assert (r["n_unique_mmsi"], r["n_events"], r["n_draught_changes"], r["max_visits_per_mmsi"], r["mean_visits_per_mmsi"]) == (2, 4, 2, 3, 2.0)
    assert (r["n_cargo"], r["n_tanker"], r["n_passenger"], r["n_fishing"]) == (1, 1, 1, 0)
    assert (r["top_destination_locode"], r["total_duration_minutes"], r["mean_duration_minutes"]) == ("DEHAM", 240.0, 60.0)


def test_tied_locodes_give_the_first_by_name(spark):
    assert counts(spark, [stop(1, locode="NLRTM"), stop(2, locode="DEHAM")])[0]["top_destination_locode"] == "DEHAM"
    assert counts(spark, [stop(1), stop(2)])[0]["top_destination_locode"] is None


def test_thresholds_include_their_value(spark):
    assert counts(spark, [stop(1, delta=0.3)])[0]["n_draught_changes"] == 1
    rows = [stop(m) for m in (1, 2, 3)] + [stop(4, HOME[0] + 5, HOME[1] + 5)]
    assert [r["n_unique_mmsi"] for r in counts(spark, rows, min_unique_mmsi=3)] == [3]


def test_grid(spark):
    home = cell_at(spark, *HOME)
    assert [len(disk(spark, home, k)) for k in (0, 1, 2, 3)] == [1, 7, 19, 37]
    r = spark.range(1).select(grid.centre(F.lit(home)).alias("c")).select(haversine_meters(F.lit(HOME[0]), F.lit(HOME[1]), F.col("c.lat"), F.col("c.lon"))).first()[0]
    assert r < 40
    assert all(home in disk(spark, x) for x in disk(spark, home))
    assert spark.range(1).select(grid.cell_at(F.lit(None).cast("double"), F.lit(1.0), 11)).first()[0] is None


def test_grid_corner_has_five_neighbours(spark):
    v = grid.VERTICES[0]
    corner = cell_at(spark, math.degrees(math.asin(v[2])), math.degrees(math.atan2(v[1], v[0])))
    near = disk(spark, corner)
    assert len(near) == 6 and all(corner in disk(spark, x) for x in near)


def test_adjacency_and_components(spark):
    home = cell_at(spark, *HOME)
    far = cell_at(spark, 51.9, 4.47)
    c = cell_rows(spark, [(x, 10) for x in disk(spark, home)] + [(far, 10)])
    adj = clusters.adjacency(c, 11, 1)
    assert adj.where("src = dst").count() == 0
    assert adj.where(F.col("src") == home).count() == 6
    sizes = sorted(r["count"] for r in clusters.components(c, 11, 1).groupBy("component").count().collect())
    assert sizes == [1, 7]


def test_components_of_long_paths(spark):
    e = [(i, i + 1) for i in range(150)] + [(1000, 1001), (1001, 1002), (1002, 1000), (2000, 2000)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(e, "src long, dst long")).collect()}
    assert set(got[i] for i in range(151)) == {0} and got[1002] == 1000 and got[2000] == 2000
    assert connected_components(spark.createDataFrame([], "src long, dst long")).collect() == []


def test_clusters(spark):
    home, far, noise = cell_at(spark, *HOME), cell_at(spark, 51.9, 4.47), cell_at(spark, 1.29, 103.85)
    near = disk(spark, home)
    c = cell_rows(spark, [(x, 20 if x != home else 200) for x in near] + [(far, 5), (noise, 4)])
    got = clusters.form_clusters(c, ClusterConfig()).orderBy("cluster_id").collect()
    assert sorted(r["n_cells"] for r in got) == [1, 7] and [r["cluster_id"] for r in got] == [0, 1]
    big = max(got, key=lambda r: r["n_cells"])
    assert (big["n_events"], big["n_draught_changes"], big["n_unique_mmsi_approx"]) == (320, 14, 14)
    assert big["h3_cells"] == near and abs(big["centroid_lat"] - HOME[0]) < 1e-3
    assert big["bbox_min_lat"] < big["centroid_lat"] < big["bbox_max_lat"]


@pytest.mark.parametrize("k,sizes", [(0, [6]), (1, [18]), (2, [30])])
def test_outlines(spark, k, sizes):
    home = cell_at(spark, *HOME)
    df = spark.createDataFrame([(1, disk(spark, home, k))], "cluster_id int, h3_cells array<string>")
    edges = [tuple(r)[1:] for r in polygons.outline_edges(df, 11).collect()]
    found = polygons.rings(edges)
    assert sorted(len(r) - 1 for r in found) == sizes and all(polygons.area(r) > 0 for r in found)


def test_outline_with_a_hole_and_parts(spark):
    home = cell_at(spark, *HOME)
    ring = sorted(set(disk(spark, home, 2)) - set(disk(spark, home, 1)))
    df = spark.createDataFrame([(1, ring), (2, [home, cell_at(spark, 51.9, 4.47)]), (3, [])], "cluster_id int, h3_cells array<string>")
    got = {r["cluster_id"]: r["geometry_wkt"] for r in polygons.add_polygons(df, 11).collect()}
    assert got[1].startswith("POLYGON ((") and got[1].count("), (") == 1
    assert got[2].startswith("MULTIPOLYGON (((") and got[3] is None


def test_nearest_city_and_country(spark):
    gaz = spark.createDataFrame(
        [("Hamburg", "HH", "DE", 53.55, 9.99), ("Rotterdam", "ZH", "NL", 51.92, 4.48), ("Singapore", "SG", "SG", 1.29, 103.85), ("Suva", "C", "FJ", -18.14, 178.44)],
        "name string, admin1 string, cc string, lat double, lon double",
    )
    places = spark.createDataFrame([(1, 53.54, 9.97), (2, 51.9, 4.47), (3, 1.3, 103.8), (4, -18.0, -179.9), (5, 85.0, 0.0)], "key int, lat double, lon double")
    got = {r["key"]: r for r in enrich.nearest_city(places, gaz, "key", "lat", "lon").collect()}
    assert [got[i]["country_iso2"] for i in range(1, 6)] == ["DE", "NL", "SG", "FJ", "DE"]
    assert got[1]["nearest_city_dist_km"] < 3
    names = spark.createDataFrame([("DE", "Germany")], "iso2 string, name string")
    codes = spark.createDataFrame([("DE",), ("XX",), ("",), (None,)], "country_iso2 string")
    assert {r[0]: r[1] for r in enrich.country_name(codes, names).collect()} == {"DE": "Germany", "XX": "XX", "": "", None: ""}
    assert enrich.nearest_city(places, gaz.limit(0), "key", "lat", "lon").collect() == []


@pytest.mark.parametrize("n", [3, 60])
def test_nearest_city_over_the_whole_globe(spark, n):
    """Few cities far from most places, against all distances."""
    import random

    rng = random.Random(n)
    cities = [(f"c{i}", "a", "XX", round(rng.uniform(-90, 90), 3) if n > 3 else 50.0 + i, round(rng.uniform(-180, 180), 3) if n > 3 else 10.0 + i) for i in range(n)]
    cities += [("same", "a", "XX", *cities[0][3:]), ("b", "a", "XX", *cities[0][3:])]  # ties
    places = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(150)] + [(200, 90.0, 180.0), (201, -90.0, -180.0), (202, None, 3.0)]
    got = enrich.nearest_city(spark.createDataFrame(places, "k int, la double, lo double"), spark.createDataFrame(cities, "name string, admin1 string, cc string, lat double, lon double"), "k", "la", "lo")

    def far(p, c):
        a, b = (math.radians(x) for x in (p[1], c[3]))
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(c[4] - p[2]) / 2) ** 2
        return 12742.0 * math.asin(min(1.0, math.sqrt(h)))

    want = {p[0]: min((round(far(p, c), 6), c[0]) for c in cities) for p in places if p[1] is not None}
    assert {r["k"]: (round(r["nearest_city_dist_km"], 6), r["nearest_city"]) for r in got.collect()} == want


def _most_rows(spark, run) -> int:
    """The most rows that any step of the plans makes that ``run`` starts."""
    sc, store = spark.sparkContext._jsc.sc(), spark._jsparkSession.sharedState().statusStore()
    sc.listenerBus().waitUntilEmpty()
    before = store.executionsCount()
    run()
    sc.listenerBus().waitUntilEmpty()
    runs, most = store.executionsList(), 0
    for i in range(before, runs.size()):
        values, nodes = store.executionMetrics(runs.apply(i).executionId()), store.planGraph(runs.apply(i).executionId()).allNodes()
        for metrics in (nodes.apply(k).metrics() for k in range(nodes.size())):
            made = [m.accumulatorId() for m in (metrics.apply(j) for j in range(metrics.size())) if m.name() == "number of output rows"]
            most = max([most, *(int(values.apply(a).replace(",", "")) for a in made if values.contains(a))])
    return most


def test_nearest_city_meets_few_cities_where_they_are_dense(spark, monkeypatch):
    """A dense coast, places far around it, and rims of places and cities about a pole: no step makes a row for each pair."""
    import numpy as np

    rng = np.random.default_rng(5)
    n = 1500
    coast = lambda s: (np.round(53 + rng.random(n) * s, 5), np.round(9 + rng.random(n) * s, 5))
    rim = lambda lat: (np.full(n, lat), np.round(np.linspace(-180, 180, n, endpoint=False), 3))
    clat, clon = (np.concatenate(v) for v in zip(coast(0.2), rim(80.0), strict=True))
    plat, plon = (np.concatenate(v) for v in zip(coast(0.2), coast(9.0), rim(85.0), strict=True))
    gaz = spark.createDataFrame([(f"c{i:04}", "a", "XX", float(a), float(b)) for i, (a, b) in enumerate(zip(clat, clon, strict=True))], "name string, admin1 string, cc string, lat double, lon double")
    places = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(plat, plon, strict=True))], "k int, la double, lo double")
    got = []
    most = _most_rows(spark, lambda: got.extend(enrich.nearest_city(places, gaz, "k", "la", "lo").collect()))
    assert most <= 30 * 3 * n, most  # pairs of cubes; one by one, the rims alone are n * n
    met, compared = [], enrich._compared
    most_met = lambda c, pairs, level: pairs.join(c.withColumn("c", enrich._cube(level)), "c").groupBy("p").count().agg(F.max("count")).first()[0]
    monkeypatch.setattr(enrich, "_compared", lambda p, c, pairs, level: met.append(most_met(c, pairs, level)) or compared(p, c, pairs, level))
    enrich.nearest_city(places, gaz, "k", "la", "lo")
    assert max(met) <= enrich.CITIES
    a, b = np.radians(plat)[:, None], np.radians(clat)[None, :]
    h = np.sin((b - a) / 2) ** 2 + np.cos(a) * np.cos(b) * np.sin(np.radians(clon[None, :] - plon[:, None]) / 2) ** 2
    want = np.round(12742.0 * np.arcsin(np.sqrt(h)), 6)
    assert len(got) == 3 * n
    assert all(abs(r["nearest_city_dist_km"] - want[r["k"]].min()) < 2e-6 and abs(want[r["k"], int(r["nearest_city"][1:])] - want[r["k"]].min()) < 2e-6 for r in got)


def test_nearest_city_of_equal_places_and_without_numbers(spark):
    gaz = [("b", "2", "XX", 10.0, 20.0), ("b", "1", "YY", 10.0, 20.0), ("c", "a", "XX", 10.0, 22.0), ("a", "a", "XX", float("nan"), 1.0), ("0", "a", "XX", None, 1.0)]
    gaz = spark.createDataFrame(gaz, "name string, admin1 string, cc string, lat double, lon double")
    places = spark.createDataFrame([(1, 10.0, 21.0), (2, 10.0, 21.0), (3, 10.0, 381.0), (4, float("nan"), 0.0), (5, None, 0.0), (6, 10.0, 21.5)], "k int, la double, lo double")
    got = {r["k"]: (r["nearest_city"], r["admin1"]) for r in enrich.nearest_city(places, gaz, "k", "la", "lo").collect()}
    assert got == {1: ("b", "1"), 2: ("b", "1"), 3: ("b", "1"), 4: ("a", "a"), 6: ("c", "a")}


def test_centroids_are_of_whole_geometries_and_per_feature(spark, tmp_path):
    box = lambda x, y, s: [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]
    shapes = [
        ({"type": "Polygon", "coordinates": [box(0, 0, 4), box(1, 1, 1)]}, {}),
        ({"type": "MultiPolygon", "coordinates": [[box(0, 0, 1)], [box(10, 0, 3)]]}, {}),
        ({"type": "Point", "coordinates": [7.0, 8.0]}, {}),
        ({"type": "Point", "coordinates": [7.0, 8.0]}, {"centroid_lat": 1.0, "centroid_lon": 2.0}),
        (None, {}),
        ({"type": "Polygon", "coordinates": []}, {}),
    ]
    made = [{"type": "Feature", "geometry": g, "properties": {"harbour_id": f"h{i}"} | p} for i, (g, p) in enumerate(shapes)]
    (tmp_path / "mixed.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": made}))
    got = {r["ordinal"]: (r["centroid_lon"], r["centroid_lat"]) for r in portdb.load_port_db(spark, str(tmp_path / "mixed.geojson")).collect()}
    assert got[0] == pytest.approx(((4**3 / 2 - 1.5) / 15,) * 2) and got[1] == pytest.approx(((0.5 + 9 * 11.5) / 10, (0.5 + 9 * 1.5) / 10))
    assert got[2] == (7.0, 8.0) and got[3] == (2.0, 1.0) and got[4] == got[5] == (None, None)


def test_port_ids(spark):
    space = uuid.UUID(vessels.NAMESPACE)
    df = spark.createDataFrame([("cell", "DE"), ("cell", None), ("other", " nl ")], "c string, cc string")
    got = [r[0] for r in df.select(vessels.port_id(F.col("c"), F.col("cc"))).collect()]
    assert got == [f"DE-{uuid.uuid5(space, 'cell').hex[:8]}", f"ZZ-{uuid.uuid5(space, 'cell').hex[:8]}", f"NL-{uuid.uuid5(space, 'other').hex[:8]}"]


def test_jaccard(spark):
    cases = [(["a", "b"], ["a", "b"], 1.0), (["a"], ["b"], 0.0), (["a", "b"], ["b", "c"], 1 / 3), ([], [], 0.0)]
    df = spark.createDataFrame(cases, "a array<string>, b array<string>, w double")
    assert all(abs(r[0] - r[1]) < 1e-9 for r in df.select(vessels.jaccard(F.col("a"), F.col("b")), "w").collect())


DB = "ordinal long, harbour_id string, h3_cells array<string>, centroid_lat double, centroid_lon double"


def test_matching(spark):
    c = spark.createDataFrame(
        [(0, ["a", "b", "c"], 53.54, 9.97), (1, ["x"], 51.9, 4.47), (2, ["q", "r", "s", "t"], 1.29, 103.85), (3, ["zz"], 10.0, 10.0)],
        "cluster_id int, h3_cells array<string>, centroid_lat double, centroid_lon double",
    ).withColumns({"centroid_h3_r8": F.lit("cell"), "country_iso2": F.lit("DE")})
    db = spark.createDataFrame(
        [
            (0, "by-cells", ["a", "b", "c"], None, None),
            (1, "far", None, 52.5, 4.47),
            (2, "first-in-order", None, 51.903, 4.47),
            (3, "nearer", None, 51.9001, 4.47),
            (4, "too-few", ["q", "u", "v", "w"], None, None),  # overlap 1 of 7
            (5, "then-distance", None, 1.2901, 103.85),
            (6, "", ["zz"], None, None),
        ],
        DB,
    )
    got = {r["cluster_id"]: (r["harbour_id"], r["matched_existing"]) for r in matching.assign_ids(c, db, MatchConfig()).collect()}
    assert got[0] == ("by-cells", True) and got[1] == ("first-in-order", True) and got[2] == ("then-distance", True)
    assert not got[3][1] and got[3][0].startswith("DE-")
    assert all(not r["matched_existing"] for r in matching.assign_ids(c).collect())


def test_a_cell_belongs_to_the_last_row_and_votes_tie_to_the_first(spark):
    c = spark.createDataFrame([(0, ["a", "b"])], "cluster_id int, h3_cells array<string>")
    db = spark.createDataFrame([(0, "one", ["a"], None, None), (1, "two", ["b"], None, None), (2, "three", ["b"], None, None)], DB)
    assert [r["harbour_id"] for r in matching.by_cells(c, db, 0.3).collect()] == ["one"]


def port(spark, geometry):
    row = [("DE-1", 0, ["a"], 1, 10, 3, 2, 53.5, 9.9, "DE", "Germany", None, 1.23456, "HH", geometry, True)]
    return spark.createDataFrame(row, schemas.PORTS)


def test_geojson_round_trip(spark, tmp_path):
    ports = port(spark, "POLYGON ((0 0, 1 0, 1 1, 0 0))").unionByName(port(spark, None).withColumn("cluster_id", F.lit(1)))
    path = str(tmp_path / "p.geojson")
    export.write_geojson(ports, path)
    doc = json.load(open(path))
    a, b = doc["features"]
    assert doc["type"] == "FeatureCollection" and b["geometry"] is None
    assert a["geometry"] == {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]]]}
    assert a["properties"]["nearest_city"] == "" and a["properties"]["nearest_city_dist_km"] == 1.235 and a["properties"]["h3_cells"] == ["a"]
    back = portdb.load_port_db(spark, path).collect()
    assert [(r["ordinal"], r["harbour_id"], r["centroid_lat"]) for r in back] == [(0, "DE-1", 53.5), (1, "DE-1", 53.5)]
    export.write_geojson(ports.limit(0), path)
    assert json.load(open(path))["features"] == []


def test_port_db_errors_and_centroids(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        portdb.load_port_db(spark, str(tmp_path / "none.parquet"))
    with pytest.raises(ValueError):
        portdb.load_port_db(spark, str(tmp_path / "none.csv"))
    bad = tmp_path / "bad.geojson"
    bad.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": None, "properties": {"id": 1}}]}))
    with pytest.raises(ValueError):
        portdb.load_port_db(spark, str(bad))
    ok = tmp_path / "ok.geojson"
    square = {"type": "Polygon", "coordinates": [[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]]]}
    ok.write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "geometry": square, "properties": {"harbour_id": "a"}}]}))
    assert [(r["centroid_lat"], r["centroid_lon"]) for r in portdb.load_port_db(spark, str(ok)).collect()] == [(1.0, 1.0)]
    schemas.conform(port(spark, None), schemas.PORTS).write.parquet(str(tmp_path / "db.parquet"))
    assert portdb.load_port_db(spark, str(tmp_path / "db.parquet")).first()["harbour_id"] == "DE-1"
    with pytest.raises(FileNotFoundError, match="phase2"):
        portdb.require(spark, str(tmp_path / "h3_counts.parquet"), "phase2")


def test_browse(spark):
    ports = port(spark, "POLYGON ((0 0, 1 0, 1 3, 0 0))").unionByName(port(spark, None).withColumns({"cluster_id": F.lit(1), "country_name": F.lit("Norway"), "n_events": F.lit(99)}))
    shown = browse.display(ports)
    assert [r["Country"] for r in browse.ordered(shown, "Events").collect()] == ["Norway", "Germany"]
    assert [r["Country"] for r in browse.search(shown, "gERm|xx").collect()] == ["Germany"]
    assert browse.pick(shown, 1, "Events").first()["Country"] == "Germany"
    assert browse.search(shown, None).count() == 2
    assert tuple(browse.with_bounds(ports).where("cluster_id = 0").select("min_lon", "min_lat", "max_lon", "max_lat").first()) == (0.0, 0.0, 1.0, 3.0)
