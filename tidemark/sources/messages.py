"""Raw position and voyage messages."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import Columns

OPTIONAL = ("draught", "destination", "ship_type")
KINDS = {
    "mmsi": "long", "lat": "double", "lon": "double", "sog": "double", "nav_status": "int", "msg_type": "int",
    "draught": "double", "destination": "string", "ship_type": "int",
}


def to_s3a(path: str) -> str:
    """``s3://`` as the scheme that Hadoop reads."""
    return re.sub(r"^s3n?://", "s3a://", path)


def base_dir(pattern: str) -> tuple[str, str]:
    """The folder before the first wildcard, and the file pattern after the last slash."""
    head = re.split(r"[*?\[{]", pattern, maxsplit=1)[0]
    folder = head[: head.rfind("/") + 1] or "."
    name = pattern.rsplit("/", 1)[-1]
    return folder, name if re.search(r"[*?\[{]", name) else "*.parquet"


def as_timestamp(c: Column, kind: T.DataType) -> Column:
    """UTC timestamps from timestamps with or without a zone, dates, texts, or whole epoch seconds."""
    if isinstance(kind, (T.IntegerType, T.LongType, T.ShortType)):
        return F.timestamp_seconds(c)
    if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)):
        return F.timestamp_micros((c * 1_000_000).cast("long"))
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(c)
    return c.cast("timestamp")


def canonical(raw: DataFrame, names: Columns | None = None) -> DataFrame:
    """The ten columns under their own names and types; optional ones that are absent are null."""
    names = names or Columns()
    out = []
    for own, kind in KINDS.items():
        src = getattr(names, own)
        if src in raw.columns:
            value = F.col(src) if raw.schema[src].dataType.simpleString() == {"long": "bigint"}.get(kind, kind) else F.col(src).try_cast(kind)
        elif own in OPTIONAL:
            value = F.lit(None).cast(kind)
        else:
            raise ValueError(f"the messages have no column {src!r}")
        out.append(value.alias(own))
    out.append(as_timestamp(F.col(names.timestamp), raw.schema[names.timestamp].dataType).alias("timestamp"))
    return raw.select(*out)


def read_messages(spark: SparkSession, pattern: str, names: Columns | None = None, schema: str | None = None) -> DataFrame:
    """All Parquet files that match, below the folder before the first wildcard.

    With ``schema``, files are read by it, so a column that is all null in one file
    (and thus of another type there) does no harm; without, schemas are merged.
    Only files that match the pattern's last part are read.  Folder names are data
    of their owner's, not partition columns.
    """
    folder, name = base_dir(to_s3a(pattern))
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", "true")
    return canonical(reader.parquet(folder), names)


def rejected(messages: DataFrame, mmsi_min: int = 100_000_000, mmsi_max: int = 999_999_999) -> DataFrame:
    """Messages that break a range, with ``reasons``.  Validation that reports instead of stopping the job."""
    checks = {
        "mmsi": F.col("mmsi").between(mmsi_min, mmsi_max),
        "lat": F.col("lat").between(-90.0, 90.0),
        "lon": F.col("lon").between(-180.0, 180.0),
    }
    bad = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    out = messages.withColumn("reasons", F.array_compact(F.array(*bad)))
    return out.where(F.size("reasons") > 0)


def require_valid(stops: DataFrame) -> DataFrame:
    """``stops``, failing the job at a record outside its ranges."""
    ok = F.col("mmsi").between(100_000_000, 999_999_999) & F.col("lat").between(-90.0, 90.0) & F.col("lon").between(-180.0, 180.0)
    message = F.concat(F.lit("invalid stop of vessel "), F.coalesce(F.col("mmsi").cast("string"), F.lit("null")))
    checked = F.when(F.coalesce(ok, F.lit(False)), F.col("mmsi")).otherwise(F.raise_error(message).cast("long"))
    return stops.withColumn("mmsi", checked)
