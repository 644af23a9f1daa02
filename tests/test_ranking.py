"""Exact quantiles and bucketed ranks against brute force."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from paylabel.operators.ranking import bucketed_rank, exact_quantiles


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=300))
def test_exact_quantiles_match_numpy(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    qs = [0.0, 0.2, 0.5, 0.8, 1.0]
    got = sorted((r.q_idx, r.value) for r in exact_quantiles(df, "x", qs).collect())
    want = np.quantile(np.array(xs), qs)
    assert [i for i, _ in got] == list(range(len(qs)))
    assert np.allclose([v for _, v in got], want, rtol=1e-12, atol=1e-9)


def test_bucketed_rank_equals_row_number(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    ranked = bucketed_rank(df, ["user_id"], F.date_trunc("hour", "ts"), [F.col("ts"), F.col("event_id")], out="r1")
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    brute = df.withColumn("r2", F.row_number().over(w))
    j = ranked.join(brute.select("event_id", "r2"), "event_id")
    assert j.count() == df.count()
    assert j.where(F.col("r1") != F.col("r2")).count() == 0


def test_global_bucketed_rank(spark):
    df = spark.range(0, 5000).withColumn("v", (F.col("id") * 7919) % 5003)
    ranked = bucketed_rank(df, [], F.floor(F.col("v") / 100), [F.col("v"), F.col("id")], out="pos")
    got = [r.v for r in ranked.orderBy("pos").select("v").collect()]
    assert got == sorted(got)
    assert ranked.agg(F.min("pos"), F.max("pos"), F.countDistinct("pos")).first() == (1, 5000, 5000)


def test_quantiles_of_tied_values(spark):
    df = spark.range(0, 20000).select(F.when(F.col("id") % 100 == 0, F.col("id").cast("double")).otherwise(F.lit(7.0)).alias("x"))
    xs = np.array([r.x for r in df.collect()])
    qs = [0.0, 0.004, 0.005, 0.5, 0.995, 0.9951, 1.0]
    got = [r.value for r in exact_quantiles(df, "x", qs).orderBy("q_idx").collect()]
    assert np.allclose(got, np.quantile(xs, qs))
    assert exact_quantiles(df.limit(0), "x", qs).count() == 0
