"""Existing port databases: Parquet or GeoJSON, in the order of their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.geo import geometry_centroid
from tidemark.operators.scans import ranked
from tidemark.sources.geojson import features
from tidemark.sources.messages import to_s3a

WANTED = {"harbour_id": "string", "h3_cells": "array<string>", "centroid_lat": "double", "centroid_lon": "double"}


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to_s3a(path))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def require(spark: SparkSession, path: str, phase: str) -> str:
    """``path``, or an error that names the phase that makes it."""
    if not exists(spark, path):
        raise FileNotFoundError(f"{path} not found; run {phase} first")
    return path


def from_features(rows: DataFrame) -> DataFrame:
    """One row per feature (``ordinal``, ``properties``, ``geometry``).

    A feature without a centroid among its properties has that of its geometry, whatever its kind.
    """
    have = set(rows.schema["properties"].dataType.fieldNames())
    cols = [F.col(f"properties.{k}").cast(t).alias(k) if k in have else F.lit(None).cast(t).alias(k) for k, t in WANTED.items()]
    out = rows.select("ordinal", *cols, _geometry(rows).alias("_g"))
    out = out.withColumn("_c", geometry_centroid(F.col("_g")))
    place = {k: F.coalesce(k, f"_c.{n}") for k, n in (("centroid_lat", "lat"), ("centroid_lon", "lon"))}
    return out.withColumns(place).drop("_g", "_c")


def _geometry(rows: DataFrame) -> Column:
    """Its JSON text."""
    kind = rows.schema["geometry"].dataType.typeName() if "geometry" in rows.columns else "void"
    return F.col("geometry") if kind == "string" else F.to_json("geometry") if kind == "struct" else F.lit(None).cast("string")


def load_port_db(spark: SparkSession, path: str) -> DataFrame:
    """``ordinal, harbour_id, h3_cells, centroid_lat, centroid_lon``."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path.rsplit("/", 1)[-1] else ""
    if suffix not in ("parquet", "geojson", "json"):
        raise ValueError(f"port databases are .parquet or .geojson, not {path!r}")
    if not exists(spark, path):
        raise FileNotFoundError(f"port database not found: {path}")
    path = to_s3a(path)
    if suffix == "parquet":
        raw = spark.read.parquet(path)
        place = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index"))
        if "harbour_id" in raw.columns:
            cols = [F.col(k).cast(t).alias(k) if k in raw.columns else F.lit(None).cast(t).alias(k) for k, t in WANTED.items()]
            return raw.select(place.alias("ordinal"), *cols)
        have = raw.columns
    else:
        # Geometries stay text: those of different kinds have no type in common.
        fields = ", ".join(f"{k}: {t}" for k, t in WANTED.items())
        found = ranked(features(spark, path).withColumnRenamed("ordinal", "at"), [F.col("at")], "ordinal")
        one = F.from_json("feature", f"geometry string, properties struct<{fields}>", {"mode": "FAILFAST"})
        if found.where(F.get_json_object("feature", "$.properties.harbour_id").isNotNull()).isEmpty():
            keys = found.select(F.explode(F.json_object_keys(F.get_json_object("feature", "$.properties")))).distinct().collect()
            raise ValueError(f"port database lacks required column harbour_id; it has {sorted(r[0] for r in keys)}")
        return from_features(found.select("ordinal", one.alias("f")).select("ordinal", "f.*"))
    raise ValueError(f"port database lacks required column harbour_id; it has {sorted(have)}")
