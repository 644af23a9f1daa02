"""Requests streamed through the trained parts: batch = stream, exactly once, newest store per batch."""

import pytest
from pyspark.sql import functions as F

from paylabel.operators import cascade as cz
from paylabel.plans import jobs
from paylabel.session import shared_path
from paylabel.sources import fixtures, io
from paylabel.streaming.jobs import classified, classify_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def trained(spark):
    data = {
        "transactions": fixtures.transactions(spark, SF),
        "recipient_entity": fixtures.recipient_entity(spark, SF),
        "merchant_profile": fixtures.merchant_profile(spark, SF),
        "person_profile": fixtures.person_profile(spark, SF),
    }
    paths = jobs.Paths(shared_path(spark, "jobs", unique=True))
    jobs.run_training(spark, data, paths, emb_dim=8, hidden=(16,), epochs=1, text_dim=16, encoder_args={"ctx_epochs": 1, "sender_epochs": 1, "sender_hidden": 8})
    return data, paths


def requests(spark, t):
    rows = cz.requests_from_transactions(t).join(t.select("txn_id", "txn_time_utc"), "txn_id")
    return rows.withColumn("amount", F.when(F.substring("txn_id", -1, 1) == "3", F.lit(0.0)).otherwise(F.col("amount")))


def test_stream_equals_batch_and_counts_once(spark, trained):
    data, paths = trained
    req = requests(spark, data["transactions"])
    replies = fixtures.external_replies(spark, SF)
    base = shared_path(spark, "t", "stream", unique=True)
    req.repartition(6).write.parquet(f"{base}/landing")
    for _ in range(2):  # the second run finds nothing new
        classify_stream(spark, f"{base}/landing", req.schema, replies, paths, f"{base}/out", f"{base}/checkpoint", files_per_batch=2)
    decided, rejected = classified(spark, f"{base}/out")
    want, bad = jobs.classify_requests(spark, req, replies, paths)
    columns = ["txn_id", "decided_by", "final_label", F.round("final_confidence", 9).alias("c")]
    assert sorted(map(tuple, decided.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
    assert sorted(map(tuple, rejected.select("txn_id", "reject_reason").collect())) == sorted(map(tuple, bad.select("txn_id", "reject_reason").collect()))
    assert decided.count() + rejected.count() == req.count() and rejected.count() > 0


def test_a_store_published_meanwhile_serves_the_next_batch(spark, trained):
    data, paths = trained
    req = requests(spark, data["transactions"]).withColumn("sender_id", F.lit("NEWCOMER")).withColumn("amount", F.lit(5.0)).withColumn("message", F.lit("zzz")).withColumn("tranx_type", F.lit("UNKNOWN")).limit(40)
    replies = fixtures.external_replies(spark, SF).where("false")
    base = shared_path(spark, "t", "stream", unique=True)
    run = lambda: classify_stream(spark, f"{base}/landing", req.schema, replies, paths, f"{base}/out", f"{base}/checkpoint")
    req.where("txn_id < 'TXN_00000020'").write.parquet(f"{base}/landing")
    run()
    first = classified(spark, f"{base}/out")[0]
    assert first.where("decided_by = 'layer3_model'").count() == 0
    one = io.scan_cumulative(spark, paths.x_snd).limit(1).withColumn("sender_id", F.lit("NEWCOMER"))
    io.sink_upsert_cumulative(spark, one.checkpoint(eager=True), paths.x_snd, "sender_id")
    more = req.withColumn("txn_id", F.concat(F.lit("later"), "txn_id"))
    more.write.mode("append").parquet(f"{base}/landing")
    run()
    later = classified(spark, f"{base}/out")[0].where("txn_id LIKE 'later%'")
    known = io.scan_cumulative(spark, paths.x_rcv).select(F.col("recipient_canon_id").alias("recipient_entity_id")).distinct()
    assert later.where("decided_by = 'layer3_model'").count() == more.join(known, "recipient_entity_id").count() > 0
