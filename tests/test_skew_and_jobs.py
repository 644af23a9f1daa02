"""Hot keys, column checks and the job surface."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from paylabel.operators import snapshots
from paylabel.operators.ranking import bucketed_rank
from paylabel.plans import context, jobs, stores, training
from paylabel.session import shared_path
from paylabel.sources import fixtures, io

SF = "/root/testdata/sf0.001"


def _hot(spark, sf=SF):
    """The stand-in with a third of all rows moved onto one sender."""
    t = fixtures.transactions(spark, sf)
    return t.withColumn("sender_id", F.when(F.substring("txn_id", -1, 1).isin("0", "3", "6"), F.lit("CUST_HOT")).otherwise(F.col("sender_id")))


def test_hot_sender_sequence_numbers_exact(spark):
    t = _hot(spark, "/root/testdata/sf0.01")
    ranked = snapshots.sender_history(t).select("txn_id", "seq_no")
    brute = t.withColumn("r", F.row_number().over(Window.partitionBy("sender_id").orderBy("txn_time_utc", "txn_id"))).select("txn_id", "r")
    j = ranked.join(brute, "txn_id")
    assert j.count() == t.count()
    assert j.where(F.col("seq_no") != F.col("r")).count() == 0
    hot = t.where(F.col("sender_id") == "CUST_HOT").count()
    assert hot > t.count() / 4


def test_hot_sender_state_matches_unskewed_formula(spark):
    t = _hot(spark)
    tt = snapshots.fit_category_vocab(t, "tranx_type")
    ch = snapshots.fit_category_vocab(t, "channel")
    ev = snapshots.event_features(t, tt, ch)
    st = snapshots.sender_state(ev, tt, ch)
    # one row per active (sender, day), hot sender included, every vector unit-length
    pairs = snapshots.active_pairs(ev, "sender_id")
    assert st.count() == pairs.count()
    norms = st.select(F.sqrt(F.aggregate("state", F.lit(0.0), lambda a, x: a + x * x)).alias("n"))
    assert norms.where(F.abs(F.col("n") - 1.0) > 1e-9).count() == 0
    hot_n = st.where(F.col("sender_id") == "CUST_HOT").agg(F.max("n_window_txns")).first()[0]
    assert hot_n > 50


def test_bucketed_rank_single_hot_bucket(spark):
    df = spark.range(0, 3000).withColumn("k", F.lit("hot")).withColumn("v", (F.col("id") * 31) % 3001)
    r = bucketed_rank(df, ["k"], F.lit(0), [F.col("v"), F.col("id")], out="rk")
    assert [x.v for x in r.orderBy("rk").select("v").collect()] == sorted(x.v for x in df.select("v").collect())


def test_require_columns(spark):
    df = spark.createDataFrame([("t1",)], "txn_id string")
    with pytest.raises(ValueError, match="Missing required columns"):
        context.require_columns(df)


def test_stratified_split_sizes(spark):
    t = training.label_lookup(fixtures.transactions(spark, SF).withColumn("label_l1", F.col("category")), io.scan_label_map(spark))
    v = t.where("label_idx >= 0")
    s = training.stratified_split(v, 0.2, 42)
    got = {(r.label_idx, r.split): r.n for r in s.groupBy("label_idx", "split").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {r.label_idx: r.n for r in v.groupBy("label_idx").agg(F.count(F.lit(1)).alias("n")).collect()}
    import math

    for lab, n in sizes.items():
        assert got.get((lab, "val"), 0) == math.ceil(n * 0.2)
    again = training.stratified_split(v, 0.2, 42)
    assert s.exceptAll(again).count() == 0  # repeatable


def test_jobs_surface(spark):
    data = {
        "transactions": fixtures.transactions(spark, SF),
        "recipient_entity": fixtures.recipient_entity(spark, SF),
        "merchant_profile": fixtures.merchant_profile(spark, SF),
        "person_profile": fixtures.person_profile(spark, SF),
    }
    paths = jobs.Paths(shared_path(spark, "jobs", unique=True))
    before = {r.item: r.present for r in jobs.check_inputs(spark, data, paths).collect()}
    assert before["transactions"] and not before["x_snd"]
    art = context.fit_ctx(data["transactions"])
    art.save(spark, f"{paths.artifacts}/ctx")
    context.fit_ctx_autoencoder(context.build_ctx(data["transactions"], art), 8, epochs=1).save(spark, f"{paths.artifacts}/ctx_encoder")
    ctx = jobs.build_ctx(spark, data, paths, "train")
    assert set(context.TRAIN_COLUMNS) <= set(ctx.columns)
    jobs.build_sender_store(spark, data, paths)
    jobs.build_recipient_store(spark, data, paths)
    after = {r.item: r.present for r in jobs.check_inputs(spark, data, paths).collect()}
    assert after["x_snd"] and after["x_rcv"] and after["ctx_artifacts"]
    # incremental: nothing new to build
    assert jobs.build_sender_store(spark, data, paths) is None
    assert stores.incremental_dates(spark, data["transactions"], paths.x_rcv).count() == 0
