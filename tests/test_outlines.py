"""Outlines over the antimeridian and around a pole, and sketches of what was written."""

import math

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import grid
from tidemark.operators import polygons
from tidemark.operators.clusters import disks
from tidemark.sinks import export


def total(made):
    return sum(polygons.area(r) if k == 0 else -abs(polygons.area(r)) for p in made for k, r in enumerate(p))


def test_squares_over_the_antimeridian():
    square = [(178.0, 0.0), (-178.0, 0.0), (-178.0, 2.0), (178.0, 2.0), (178.0, 0.0)]
    hole = [(179.0, 0.5), (179.0, 1.5), (-179.0, 1.5), (-179.0, 0.5), (179.0, 0.5)]
    made = polygons.on_map(polygons.polygons(polygons.unrolled([square, hole])))
    assert len(made) == 2 and all(-180 <= x <= 180 for p in made for r in p for x, _ in r)
    assert math.isclose(total(made), 8 - 2) and sorted(min(x for x, _ in p[0]) for p in made) == [-180.0, 178.0]
    other_way = [(x - 360 if x > 0 else x, y) for x, y in square]
    assert math.isclose(total(polygons.on_map([[other_way]])), 8)


def test_a_ring_around_a_pole():
    for sign in (1, -1):
        ring = [((lon + 180) % 360 - 180, sign * 80.0) for lon in range(0, 361, 10)][::sign]
        made = polygons.on_map(polygons.polygons(polygons.unrolled([ring])))
        assert math.isclose(total(made), 3600.0) and all(-180 <= x <= 180 and abs(y) <= 90 for p in made for r in p for x, y in r)


def test_clusters_there(spark):
    """Disks of cells at both places keep their area."""
    res, k = 5, 2
    places = spark.createDataFrame([(0, 10.0, 10.0), (1, 10.0, 179.999), (2, -10.0, -180.0)], "cluster_id int, lat double, lon double")
    home = places.select("cluster_id", grid.cell_at(F.col("lat"), F.col("lon"), res).alias("h3_cell"))
    cells = home.join(disks(home.select("h3_cell"), res, k), "h3_cell").groupBy("cluster_id").agg(F.collect_list("near").alias("h3_cells"))
    made = {r["cluster_id"]: r["geometry_wkt"] for r in polygons.add_polygons(cells, res).collect()}
    area = {}
    for i, text in made.items():
        parts = [[[tuple(map(float, q.split())) for q in r.split(", ")] for r in p.split("), (")] for p in text[text.index("((") :].strip("()").replace(")), ((", "|").split("|")]
        assert all(-180 <= x <= 180 for p in parts for r in p for x, _ in r)
        area[i] = total(parts)
    assert made[0].startswith("POLYGON") and made[1].startswith("MULTIPOLYGON") and made[2].startswith("MULTIPOLYGON")
    assert all(0.8 < area[i] / area[0] < 1.25 for i in (1, 2))


def test_sketches_of_runs(spark, tmp_path):
    path = str(tmp_path / "stops.parquet")
    for first in (0, 2000):  # half of the second run's vessels were in the first
        df = schemas.conform(spark.range(first, first + 12_000).select((F.col("id") % 4000 + first).alias("mmsi")), schemas.STOPS)
        assert export.write_table(df, path, schemas.STOPS, distinct="mmsi") == 12_000
    (r,) = export.metrics(spark, path).collect()
    exact = len({x % 4000 + f for f in (0, 2000) for x in range(f, f + 12_000)})
    assert (r["name"], r["runs"], r["n_rows"]) == ("mmsi", 2, 24_000) and abs(r["n_distinct"] / exact - 1) < 0.05
