"""Session factory and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def spark_session(app_name: str = "tidemark", conf: dict[str, str] | None = None) -> SparkSession:
    """A UTC session.  Local with all cores unless a cluster manager set the master.

    Shuffle partitions are left to the deployment: AQE coalesces small ones and
    splits skewed ones, so a generous count is safe.
    """
    builder = SparkSession.builder.appName(app_name)
    if not os.environ.get("KUBERNETES_SERVICE_HOST") and not os.environ.get("SPARK_MASTER"):
        builder = builder.master("local[*]")
    builder = (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Only a session on one machine that names none (tests) gets a local folder; on a
    cluster, where each executor would write to its own disk, that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    have = spark.sparkContext._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get().rstrip("/")
    if not is_local(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def work_dir(spark: SparkSession) -> str:
    """This application's own part of the scratch folder."""
    return f"{scratch_dir(spark)}/tidemark/{spark.sparkContext.applicationId}"


#: Rows, about, for which a task of its own is worth while.
TASK_ROWS = 1 << 15


def dealt(df: DataFrame, rows: int | None) -> DataFrame:
    """``df``, whose last step handles some ``rows`` (None: not known), in one partition for ``TASK_ROWS`` of them, but at least one a core."""
    return df if rows is None else df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def materialise(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` once as Parquet under the shared folder and read it back.

    Cuts the lineage like ``checkpoint()`` does, but columnar and compressed, and
    any executor can read it after another is lost.  ``rows`` as in :func:`dealt`:
    each task that writes makes a folder and a file, and where the shared folder is a
    mounted one, each such folder costs a process that the executor forks (``chmod``).
    """
    spark, df = df.sparkSession, dealt(df, rows)
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str, rows: int | None = None, total: str = "count(*)") -> tuple[DataFrame, int]:
    """:func:`materialise`, and how many rows were written, or another ``total`` of them."""
    seen = Observation()
    out = materialise(df.observe(seen, F.expr(total).alias("n")), name, rows)
    return out, seen.get["n"] or 0


def drop_scratch(spark: SparkSession) -> None:
    """Delete everything this application wrote with :func:`materialise`, if anything.  Call once results are stored."""
    try:
        work_dir(spark)
    except ValueError:  # no folder, so nothing was written
        return
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Most bytes of a table that is sent to every executor.
BROADCAST_BYTES = 64 << 20
#: What a row of a broadcast hash table takes besides its values.
ROW_BYTES = 64


def measured(df: DataFrame) -> int:
    """About how many bytes ``df`` takes as a broadcast hash table: its values as text, and ``ROW_BYTES`` a row."""
    size = F.octet_length(F.concat_ws("", *[df[c].cast("string") for c in df.columns]))
    row = df.agg(F.count("*").alias("n"), F.sum(size).alias("b")).first()
    return row["n"] * ROW_BYTES + (row["b"] or 0)


def broadcast_within(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df``, marked for broadcast if it was measured to take ``limit`` bytes at most; otherwise its join shuffles.

    ``df`` is read for it, so it should be cheap to read: a materialised table.
    """
    return F.broadcast(df) if measured(df) <= limit else df
