"""Running aggregates of long sequences, without a task that sees a whole one.

A sequence (a vessel's messages, a conversation's turns) is cut into buckets that follow its
order.  Each bucket is summarised, the few summaries are scanned over the sequence, and
what came before is handed to the rows of the next bucket: a prefix scan in two levels.
A window over (key, bucket) holds one bucket's rows; a window over the key holds one row
a bucket.  So a key with a third of all rows is spread over as many tasks as it has buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import materialise


class Fold(NamedTuple):
    """An aggregate whose parts can be put together: ``F.sum``, ``F.max``, ``F.min`` or ``F.bit_xor`` of a Column.

    With ``before`` a row sees the rows before it only, otherwise itself, too.
    """

    agg: Callable[[Column], Column]
    value: Column
    before: bool = False


def _joined(fold: Fold, carried: Column, own: Column) -> Column:
    if fold.agg in (F.max, F.min):
        return (F.greatest if fold.agg is F.max else F.least)(carried, own)
    plus = own.bitwiseXOR(carried) if fold.agg is F.bit_xor else own + carried
    return F.when(carried.isNull(), own).when(own.isNull(), carried).otherwise(plus)


def running(df: DataFrame, key: list[str], bucket: Column, order: list[Column], folds: Mapping[str, Fold]) -> DataFrame:
    """``df`` with a column for each of ``folds``: the aggregate over its key's rows up to this one, in ``order``.

    ``bucket`` must not fall where ``order`` rises.  Keys must not be null.  Rows that tie in ``order`` come in
    any order.  A fold over no rows is null.
    """
    rows = df.withColumn("_bucket", bucket)
    whole = [f.agg(f.value).alias(f"_till_{name}") for name, f in folds.items()]
    parts = rows.groupBy(*key, "_bucket").agg(*whole)
    earlier = Window.partitionBy(*key).orderBy("_bucket")
    past = earlier.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*key, "_bucket", *[f.agg(F.col(f"_till_{name}")).over(past).alias(f"_till_{name}") for name, f in folds.items()], F.row_number().over(earlier).alias("_piece"))
    parts = parts.where("_piece > 1").select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate([*key, "_bucket"])], *[f"_till_{name}" for name in folds])
    inside = Window.partitionBy(*key, "_bucket").orderBy(*order)
    rows = rows.withColumns({name: f.agg(f.value).over(inside.rowsBetween(Window.unboundedPreceding, -1 if f.before else 0)) for name, f in folds.items()})
    met = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate([*key, "_bucket"])]
    done = {name: _joined(f, F.col(f"_till_{name}"), F.col(name)) for name, f in folds.items()}
    return rows.join(parts, met, "left").withColumns(done).select(*df.columns, *folds)


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's place, from 0, in ``order``, which should leave no ties.

    Rows are dealt into ranges of the order, whose bounds are sampled; each range is numbered by itself, and the
    sizes of the ranges before it are added.  The driver sees one number a range.  ``df`` is read twice, so it should be a table.
    """
    dealt = materialise(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranked")
    sizes = {r["_range"]: r["n"] for r in dealt.groupBy("_range").agg(F.count("*").alias("n")).collect()}
    before = [sum(n for k, n in sizes.items() if k < i) for i in range(max(sizes, default=-1) + 1)]
    start = F.get(F.expr(f"cast(array({', '.join(map(str, before))}) as array<bigint>)"), F.col("_range"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return dealt.withColumn(name, start + place).drop("_range")
