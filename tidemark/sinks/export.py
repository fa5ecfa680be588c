"""Parquet between phases, and the GeoJSON of the final ports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.wkt import geojson
from tidemark.sources.messages import to_s3a


def path_join(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}"


def write_table(df: DataFrame, path: str, ddl: str, distinct: str | None = None) -> int:
    """Write in the schema of the contract; the number of rows is observed on the way, not counted again.

    With ``distinct`` a sketch of that column's different values is observed, too, and kept beside the table (see :func:`metrics`).
    """
    from pyspark.sql import Observation

    seen, spark = Observation(), df.sparkSession
    more = [F.hll_sketch_agg(F.col(distinct)).alias("sketch")] if distinct else []
    schemas.conform(df, ddl).observe(seen, F.count(F.lit(1)).alias("n"), *more).write.mode("overwrite").parquet(to_s3a(path))
    if distinct:
        row = spark.createDataFrame([(distinct, seen.get["n"], seen.get["sketch"])], "name string, n long, sketch binary")
        row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(to_s3a(path) + ".metrics")
    return seen.get["n"]


def metrics(spark: SparkSession, path: str) -> DataFrame:
    """``name, runs, n_rows, n_distinct`` of what was ever written at ``path``: sketches of runs are merged, so a value that comes again counts once."""
    rows = spark.read.parquet(to_s3a(path) + ".metrics")
    return rows.groupBy("name").agg(
        F.count("*").alias("runs"), F.sum("n").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct")
    )


def features(ports: DataFrame, *more: str) -> DataFrame:
    """``harbour_id, cluster_id`` and ``feature``, the text of one GeoJSON feature, and ``more`` columns.

    An outline that is no geometry becomes null.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    props = F.struct(
        "harbour_id", F.coalesce("h3_cells", F.array().cast("array<string>")).alias("h3_cells"), "n_cells", "n_events",
        "n_unique_mmsi_approx", "n_draught_changes", "centroid_lat", "centroid_lon", text("country_iso2"), text("country_name"),
        text("nearest_city"), F.round(F.col("nearest_city_dist_km").cast("double"), 3).alias("nearest_city_dist_km"), text("admin1"),
        "matched_existing",
    )
    made = F.concat(
        F.lit('{"type": "Feature", "geometry": '),
        F.coalesce(geojson(F.col("geometry_wkt")), F.lit("null")),
        F.lit(', "properties": '),
        F.to_json(props, {"ignoreNullFields": "false"}),
        F.lit("}"),
    )
    return ports.select("harbour_id", "cluster_id", made.alias("feature"), *more)


def _pretty(batches):
    """Features as members of a document: a comma, the indented text, and its last bracket left to the line's end."""
    import json

    import pyarrow as pa

    for batch in batches:
        text = [json.dumps(json.loads(x), ensure_ascii=False, indent=2).replace("\n", "\n    ") for x in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([",\n    " + t[:-1] for t in text], pa.string()), batch.column(1)], names=["value", "lost"])


def write_geojson(ports: DataFrame, path: str) -> dict[str, int]:
    """One FeatureCollection document at ``path``, indented by two, features by ``cluster_id``.

    Tasks format and write the features of ranges of ids, as text files that Spark commits like any other: a lost
    task is done again.  Then the files, which are in order, are strung together below a name of its own, which becomes ``path`` at once:
    their bytes are copied by the file system, a buffer at a time, and no feature is looked at again.

    Returns how many features there are, and how many have an outline that is no geometry and is written as null.
    """
    from pyspark.sql import Observation

    spark: SparkSession = ports.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(to_s3a(path))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts, whole = target.suffix(".parts"), target.suffix(".part")
    fs.delete(parts, True)
    seen = Observation()
    lost = F.col("geometry_wkt").isNotNull() & F.col("feature").startswith('{"type": "Feature", "geometry": null')
    rows = features(ports, "geometry_wkt").select("feature", lost.alias("lost"), "cluster_id")
    rows = rows.repartitionByRange("cluster_id").sortWithinPartitions("cluster_id").select("feature", "lost")
    made = rows.mapInArrow(_pretty, "value string, lost boolean").observe(seen, F.count(F.lit(1)).alias("n_features"), F.count_if("lost").alias("n_unreadable"))
    made.select("value").write.option("lineSep", "}").text(parts.toString())
    files = sorted(f.getPath().toString() for f in fs.listStatus(parts) if f.getPath().getName().startswith("part-") and f.getLen())
    out = fs.create(whole, True)
    try:
        out.write(bytearray(b'{\n  "type": "FeatureCollection",\n  "features": ['))
        for k, name in enumerate(files):
            source = fs.open(jvm.org.apache.hadoop.fs.Path(name))
            source.seek(int(k == 0))  # no comma before the first feature
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            source.close()
        out.write(bytearray(b"\n  ]\n}\n" if files else b"]\n}\n"))
    finally:
        out.close()
    fs.delete(target, False)
    fs.rename(whole, target)
    fs.delete(parts, True)
    return seen.get
