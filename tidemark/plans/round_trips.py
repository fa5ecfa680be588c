"""Queries that go through files and outlines: sources, sinks, phases, port databases, geometries.

Files are written below the folder in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import dataclasses
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.config import Columns
from tidemark.functions.geo import ring_area
from tidemark.functions.wkt import geojson
from tidemark.operators import browse, polygons
from tidemark.plans import adapter, pipeline, queries
from tidemark.plans.shapes import SHAPES, TEXTS
from tidemark.session import materialise, work_dir
from tidemark.sinks import export
from tidemark.sources import messages, portdb


def _folder(spark: SparkSession) -> str:
    return f"{work_dir(spark)}/files-{uuid.uuid4().hex}"


def messages_read(spark, d):
    """Messages of two layouts: other names, text for numbers, epoch seconds, columns that one file lacks."""
    folder, m = _folder(spark), adapter.messages(spark, d)
    text = F.coalesce(F.col("sog").cast("string"), F.lit("n/a"))
    common = [F.col("mmsi").cast("string").alias("vessel"), F.unix_seconds("timestamp").alias("seconds"), "lat", "lon", text.alias("sog"), "nav_status", "msg_type"]
    m.where("msg_type = 5").select(*common, "draught", "destination", "ship_type").write.parquet(f"{folder}/year=1/voyages.parquet")
    m.where("msg_type <> 5").select(*common, F.lit("x").alias("not_asked_for")).write.parquet(f"{folder}/year=2/positions.parquet")
    out = messages.read_messages(spark, f"{folder}/*/*.parquet", Columns(mmsi="vessel", timestamp="seconds"))
    return out.select("mmsi", queries.us("timestamp", "t"), queries.r3("lat").alias("lat"), queries.r3("lon").alias("lon"), "sog", "nav_status", "msg_type", "draught", "destination", "ship_type")


def _shown(ports: DataFrame) -> DataFrame:
    return ports.select(
        *[F.col(c).cast("long").alias(c) for c in ("cluster_id", "n_cells", "n_events", "n_unique_mmsi_approx", "n_draught_changes")], "harbour_id", "matched_existing",
        "country_iso2", "country_name", "nearest_city", "admin1", F.array_join("h3_cells", ",").alias("cells"), queries.r3("centroid_lat").alias("lat"),
        queries.r3("centroid_lon").alias("lon"), F.round(F.col("nearest_city_dist_km").cast("double"), 1).alias("km"),
    )


def phases(spark, d):
    """The five phases one by one, each through the table that the one before wrote; no known ports."""
    folder = _folder(spark)
    raw = adapter.messages(spark, d)
    raw.write.parquet(f"{folder}/raw")
    settings = {"raw_glob": f"{folder}/raw/*.parquet", "interim_dir": f"{folder}/interim", "output_dir": f"{folder}/output"}
    settings["raw_schema"] = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in raw.schema)
    cfg = dataclasses.replace(adapter.CONFIG, data=settings)
    table, _ = pipeline.run_all(spark, cfg, adapter.cities(spark, d), adapter.countries(spark, d))
    return _shown(spark.read.parquet(table))


def port_databases(spark, d):
    """The final ports as Parquet and as GeoJSON, read back as databases of known ports."""
    folder, ports = _folder(spark), materialise(queries._ports(spark, d), "ports")
    export.write_table(ports, f"{folder}/ports.parquet", schemas.PORTS)
    export.write_geojson(ports, f"{folder}/ports.geojson")
    read = [portdb.load_port_db(spark, f"{folder}/ports.{kind}").withColumn("kind", F.lit(kind)) for kind in ("parquet", "geojson")]
    shown = [r.select("kind", "harbour_id", F.array_join("h3_cells", ",").alias("cells"), queries.r3("centroid_lat").alias("lat"), queries.r3("centroid_lon").alias("lon")) for r in read]
    return shown[0].unionByName(shown[1])


def geojson_properties(spark, d):
    """What a viewer reads from the GeoJSON of the final ports."""
    path, ports = f"{_folder(spark)}/ports.geojson", materialise(queries._ports(spark, d), "ports")
    export.write_geojson(ports, path)
    found = browse.read_features(spark, path)
    return _shown(found.select(F.col("_idx").alias("cluster_id"), "properties.*"))


def browse_pick(spark, d):
    """The third port of those ordered by their events."""
    out = browse.pick(browse.display(queries._ports(spark, d)), 2)
    return out.select(F.col("_idx").cast("long").alias("idx"), *[F.col(c).alias(c.lower()) for c in ("Country", "Events", "Vessels", "Cells")])


def outline_edges(spark, d):
    """Every directed edge of the outlines: the names of its corners, and the place of the first."""
    out = polygons.outline_edges(queries._clusters(spark, d), queries.RES)
    return out.select(F.col("cluster_id").cast("long").alias("cluster_id"), "key", "next", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"))


def outline_shape(spark, d):
    """Corners, area (in millionths of a square degree) and bounds of the outlines, from their text by way of GeoJSON."""
    made = polygons.add_polygons(queries._clusters(spark, d), queries.RES)
    doc = geojson(F.col("geometry_wkt"))
    poly = F.from_json(doc, "type string, coordinates array<array<array<double>>>")["coordinates"]
    multi = F.from_json(doc, "type string, coordinates array<array<array<array<double>>>>")["coordinates"]
    parts = F.when(F.col("geometry_wkt").startswith("POLYGON"), F.array(poly)).otherwise(multi)
    out = browse.with_bounds(made.select("cluster_id", "geometry_wkt", parts.alias("parts")))
    signed = F.transform("parts", lambda p: F.transform(p, lambda ring, i: ring_area(ring) * F.when(i == 0, 1.0).otherwise(-1.0)))
    corners = F.transform("parts", lambda p: F.transform(p, lambda ring: F.size(ring) - 1))
    total = lambda c, zero: F.aggregate(F.flatten(c), zero, lambda s, x: s + x)
    return out.select(
        F.col("cluster_id").cast("long").alias("cluster_id"), total(corners, F.lit(0)).cast("long").alias("n_corners"), F.round(total(signed, F.lit(0.0)) * 1e6, 3).alias("area"),
        *[F.round(c, 6).alias(c) for c in ("min_lon", "min_lat", "max_lon", "max_lat")],
    )


def geometry_text(spark, d):
    """Well-formed and broken texts of geometries of all kinds, one a customer, as GeoJSON."""
    k = F.col("c_custkey")
    text = F.get(F.array(*[F.lit(t).cast("string") for t, _ in TEXTS]), (k % len(TEXTS)).cast("int"))
    c = spark.read.parquet(f"{d}/customer.parquet")
    return c.select(k.alias("key"), geojson(F.replace(text, F.lit("#"), (k + 3).cast("string"))).alias("geometry"))


def geometry_centroid(spark, d):
    """Places of known ports, one a supplier, that are given as geometries of all kinds."""
    k = F.col("s_suppkey")
    n = spark.read.parquet(f"{d}/supplier.parquet")
    shape = F.get(F.array(*[F.lit(g).cast("string") for g, _ in SHAPES]), (k % len(SHAPES)).cast("int"))
    own = F.struct(F.concat(F.lit("p"), k.cast("string")).alias("harbour_id"), F.when(k % 8 == 1, F.lit(1.5)).alias("centroid_lat"))
    out = portdb.from_features(n.select(k.alias("ordinal"), own.alias("properties"), F.replace(shape, F.lit("#"), k.cast("string")).alias("geometry")))
    return out.select("ordinal", "harbour_id", queries.r3("centroid_lat").alias("lat"), queries.r3("centroid_lon").alias("lon"))


QUERIES = {f.__name__: f for f in (messages_read, phases, port_databases, geojson_properties, browse_pick, outline_edges, outline_shape, geometry_text, geometry_centroid)}
