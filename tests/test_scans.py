"""Running aggregates in buckets against plain windows."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.operators.scans import Fold, ranked, running


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_running_is_a_window(spark, width):
    rng = random.Random(width)
    rows = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", i, rng.choice([None, rng.randrange(-50, 50)])) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, at long, v long")
    v = F.col("v")
    folds = {
        "total": Fold(F.sum, v), "most": Fold(F.max, v), "least": Fold(F.min, v), "bits": Fold(F.bit_xor, v),
        "last": Fold(F.max, F.when(v.isNotNull(), F.struct("at", "v")), before=True), "nth": Fold(F.sum, F.lit(1)),
    }
    w = Window.partitionBy("k").orderBy("at")
    plain = df.withColumns({n: f.agg(f.value).over(w.rowsBetween(Window.unboundedPreceding, -1 if f.before else 0)) for n, f in folds.items()})
    got = running(df, ["k"], F.expr(f"at div {width}"), [F.col("at")], folds)
    assert got.columns == plain.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert running(df.limit(0), ["k"], F.expr("at div 3"), [F.col("at")], folds).count() == 0


def test_no_window_over_the_rows_of_a_key_alone(spark):
    df = spark.range(10).select(F.lit("k").alias("k"), F.col("id").alias("at"))
    plan = running(df, ["k"], F.expr("at div 4"), [F.col("at")], {"n": Fold(F.sum, F.lit(1))})._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") == 2 and "Aggregate [k" in plan


def test_ranks_over_all_rows(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(20), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "v long, i long")
    order = [F.col("v").desc(), F.col("i")]
    out = ranked(df.repartition(7), order, "place")
    assert "Window [row_number" in out._jdf.queryExecution().toString() and out.columns == ["v", "i", "place"]
    want = {i: k for k, (_, i) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
    assert {r["i"]: r["place"] for r in out.collect()} == want
    assert ranked(df.limit(0), order, "place").count() == 0
