"""Sharding by extendible hashing.

A row's shard is a prefix of its hash bits.  The directory starts with one bucket
and splits, bit by bit, only buckets that hold more than the byte limit, until
every shard fits.  The directory is built from a histogram over hash prefixes, so
the texts themselves are never shuffled to find it; histogram cells that are
still too large are counted again with more bits, and only those.

The hash is of the id and the text, so rows of one id, or of none, are dealt out like
others.  Rows that agree in both have one hash, which no bit can split.  If they are
more than a shard holds, they are told apart by their position among each other
(``_numbered``) and fill shards of their own, named by the hash and a number.  So
only a single row that is larger than the limit makes a shard beyond it, which is
marked ``oversized``.

Defined results: a null or empty text has 0 bytes; null ids and texts hash as the
empty string.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are read by
name; other columns may have any.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import BROADCAST_BYTES, broadcast_within, materialise

BITS = 60
LIMIT = 16 << 20
#: More bits a round than the mean shard needs.
SPARE = 3


def hash_of(key: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 digest of id and text, as a non-negative long."""
    both = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(both), 1, 15), 16, 10).cast("long")


def _size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _prefix(h: Column, bits: int) -> Column:
    return F.shiftright(h, BITS - bits)


def directory(rows: DataFrame, limit: int) -> list[tuple[DataFrame, int]]:
    """Leaves ``(cell, depth, shard_bytes, oversized)`` per round, with the bits of its cells.

    ``rows`` has ``h`` and ``n_bytes``.  A cell is a hash prefix of that many bits;
    it maps to the depth of the bucket that it lies in.
    """
    total = rows.agg(F.sum("n_bytes").alias("s")).first()["s"] or 0
    top, out, todo = 0, [], rows
    bits = min(BITS, SPARE + max(0, math.ceil(math.log2(max(1, total / limit)))))
    while True:
        cells = todo.groupBy(_prefix(F.col("h"), bits).alias("cell")).agg(
            F.sum("n_bytes").alias("b"), F.min("h").alias("lo"), F.max("h").alias("hi")
        )
        cells = materialise(cells, "cells")
        path = cells.select("*", F.explode(F.sequence(F.lit(top), F.lit(bits))).alias("depth"))
        path = path.withColumn("bucket", F.call_function("shiftright", F.col("cell"), (F.lit(bits) - F.col("depth")).cast("int")))
        buckets = path.groupBy("depth", "bucket").agg(F.sum("b").alias("b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        whole = (F.col("b") <= limit) | (F.col("lo") == F.col("hi"))
        fit = buckets.where(whole).select("depth", "bucket", F.col("b").alias("shard_bytes"), (F.col("b") > limit).alias("oversized"))
        leaf = path.select("cell", "depth", "bucket").join(fit, ["depth", "bucket"])
        leaf = leaf.groupBy("cell").agg(F.min(F.struct("depth", "shard_bytes", "oversized")).alias("x")).select("cell", "x.*")
        leaf = materialise(leaf, "directory")
        out.append((leaf, bits))
        left = cells.join(leaf, "cell", "left_anti").select(F.col("cell").alias("open_cell"))
        if bits == BITS or left.isEmpty():
            return out
        todo = todo.join(left, _prefix(F.col("h"), bits) == F.col("open_cell"), "left_semi")
        top, bits = bits + 1, min(BITS, bits + 8)


def _numbered(hot: DataFrame) -> DataFrame:
    """``hot`` with ``at``: each row's number, from 0, among the rows of its hash.

    Rows are numbered within the partition that they are read from, then each
    partition's count is added to those after it: no task sees all rows of a hash.
    """
    hot = materialise(hot.withColumn("mid", F.monotonically_increasing_id()), "hot").withColumn("pid", F.shiftright("mid", 33))
    own = Window.partitionBy("h", "pid").orderBy("mid")
    count = hot.groupBy(F.col("h").alias("h_"), F.col("pid").alias("pid_")).agg(F.count("*").alias("c"))
    before = Window.partitionBy("h_").orderBy("pid_").rowsBetween(Window.unboundedPreceding, -1)
    count = count.withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0)))
    both = hot.withColumn("own", F.row_number().over(own) - 1).join(count, (F.col("h") == F.col("h_")) & (F.col("pid") == F.col("pid_")))
    return both.withColumn("at", F.col("own") + F.col("before")).drop("mid", "pid", "own", "h_", "pid_", "c", "before")


def _placed(rows: DataFrame, limit: int, max_broadcast: int) -> DataFrame:
    """``rows``, which have ``h`` and ``n_bytes``, with ``shard, depth, shard_bytes, oversized``."""
    parts = []
    for leaf, bits in directory(materialise(rows.select("h", "n_bytes"), "sizes"), limit):
        parts.append(rows.join(broadcast_within(leaf, max_broadcast), _prefix(F.col("h"), bits) == F.col("cell")).drop("cell"))
    out = reduce(DataFrame.unionByName, parts)
    out = out.withColumns({"shard": F.expr(f"substring(lpad(bin(h), {BITS}, '0'), 1, depth)"), "depth": F.col("depth").cast("int")})
    hot = F.col("oversized") & (F.col("shard_bytes") > F.col("n_bytes"))  # several rows of one hash, so of one size
    if out.where(hot).isEmpty():
        return out
    room = F.greatest(F.expr(f"{limit} div n_bytes"), F.lit(1))
    each = _numbered(out.where(hot)).withColumn("room", room)
    piece = F.expr("at div room")
    last = F.expr("(shard_bytes div n_bytes - 1) div room")
    here = F.when(piece < last, F.col("room")).otherwise(F.expr("shard_bytes div n_bytes") - last * F.col("room")) * F.col("n_bytes")
    each = each.withColumns({"shard": F.concat("shard", F.lit("-"), piece.cast("string")), "shard_bytes": here, "oversized": F.col("n_bytes") > limit})
    return out.where(~hot).unionByName(each.drop("at", "room"))


def assign(docs: DataFrame, limit: int = LIMIT, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_bytes, shard`` (its bits), ``depth, shard_bytes, oversized`` per row."""
    rows = docs.select("doc_id", hash_of(F.col("doc_id"), F.col("text")).alias("h"), _size(F.col("text")).alias("n_bytes"))
    out = _placed(materialise(rows, "rows"), limit, max_broadcast)
    return out.select("doc_id", "n_bytes", "shard", "depth", "shard_bytes", "oversized")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, max_broadcast: int = BROADCAST_BYTES) -> None:
    """Write ``docs`` with one folder a shard, ``_tm_shard``.

    Rows travel once, by shard; shards hold at most ``limit`` bytes, so no task
    gets more than a few of them.
    """
    row = F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    rows = docs.select(row.alias("row"), hash_of(docs["doc_id"], docs["text"]).alias("h"), _size(docs["text"]).alias("n_bytes"))
    out = _placed(rows, limit, max_broadcast).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("shard").alias("_tm_shard"))
    out.repartition("_tm_shard").write.partitionBy("_tm_shard").parquet(path)


def query(spark, sf_dir: str) -> DataFrame:
    """op10 over ``documents``."""
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: A limit at which the smallest tables split many times, too.
SMALL_LIMIT = 64 << 10


def small_shards(spark, sf_dir: str) -> DataFrame:
    """The same over ``documents`` with shards of ``SMALL_LIMIT`` bytes."""
    return assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), SMALL_LIMIT)


def sql(limit: int) -> str:
    """DuckDB SQL for :func:`assign`."""
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS h FROM documents
), k AS (SELECT unnest(range(0, {BITS + 1})) AS depth
), b AS (
  SELECT depth, h >> CAST({BITS} - depth AS BIGINT) AS bucket, sum(n_bytes) AS b, count(DISTINCT h) AS n FROM d, k GROUP BY ALL
), f AS (
  SELECT rid, doc_id, n_bytes, h, min(struct_pack(depth := k.depth, b := b.b)) AS x
  FROM d, k JOIN b ON b.depth = k.depth AND b.bucket = d.h >> CAST({BITS} - k.depth AS BIGINT)
  WHERE b.b <= {limit} OR b.n = 1 GROUP BY ALL
), g AS (
  SELECT *, x.b > {limit} AND x.b > n_bytes AS hot, greatest({limit} // greatest(n_bytes, 1), 1) AS room,
    row_number() OVER (PARTITION BY h ORDER BY rid) - 1 AS nth, x.b // greatest(n_bytes, 1) AS rows_ FROM f
), p AS (SELECT *, nth // room AS piece, (rows_ - 1) // room AS last FROM g)
SELECT doc_id, n_bytes,
  substr(lpad(CAST(bin(h) AS VARCHAR), {BITS}, '0'), 1, CAST(x.depth AS INTEGER)) || CASE WHEN hot THEN '-' || CAST(CAST(piece AS BIGINT) AS VARCHAR) ELSE '' END AS shard,
  CAST(x.depth AS INTEGER) AS depth,
  CAST(CASE WHEN NOT hot THEN x.b WHEN piece < last THEN room * n_bytes ELSE (rows_ - last * room) * n_bytes END AS BIGINT) AS shard_bytes,
  CASE WHEN hot THEN n_bytes > {limit} ELSE x.b > {limit} END AS oversized FROM p
"""


SQL, SMALL_SQL = sql(LIMIT), sql(SMALL_LIMIT)
