"""Training run, saved artifacts, and requests scored from them."""

import pytest
from pyspark.sql import functions as F

from paylabel.operators import cascade as cz
from paylabel.plans import context, jobs, scoring, training
from paylabel.session import shared_path
from paylabel.sources import fixtures, io

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
    _, metrics = jobs.run_training(spark, data, paths, emb_dim=8, hidden=(16, 8), epochs=3, svd_dim=64, text_dim=16, encoder_args={"ctx_epochs": 2, "sender_epochs": 1, "sender_hidden": 8})
    return data, paths, metrics


def test_training_saves_all_artifacts(spark, trained):
    data, paths, metrics = trained
    assert metrics.first()["n"] > 0
    assert all(r.present for r in jobs.check_inputs(spark, data, paths).collect())
    jobs.run_inference_features(spark, data, paths)
    assert spark.read.parquet(f"{paths.ctx}_inference").where(F.size("ctx_emb") == 8).count() == data["transactions"].count()


def test_requests_are_scored_as_in_training(spark, trained):
    """Scores equal a plain join of the saved parts, row by row; unknown ids get none."""
    data, paths, _ = trained
    t = data["transactions"]
    req = cz.requests_from_transactions(t).join(t.select("txn_id", "txn_time_utc"), "txn_id")
    req = req.withColumn("sender_id", F.when(F.substring("txn_id", -1, 1) == "7", F.lit("NOBODY")).otherwise(F.col("sender_id")))
    got = {r.txn_id: list(r.prob) for r in jobs.score_requests(spark, req, paths).collect()}
    snd = {r.sender_id: r for r in io.scan_cumulative(spark, paths.x_snd).orderBy("snapshot_date").collect()}
    rcv = {r.recipient_canon_id: r for r in io.scan_cumulative(spark, paths.x_rcv).orderBy("snapshot_date").collect()}
    rows = {r.txn_id: r for r in req.collect()}
    assert set(got) == {k for k, r in rows.items() if r.sender_id in snd and r.recipient_entity_id in rcv} and got
    assert not any(k.endswith("7") for k in got)
    art = context.CtxArtifacts.load(spark, f"{paths.artifacts}/ctx")
    as_txn = scoring.request_transactions(req)
    emb = {r.txn_id: list(r.ctx_emb) for r in context.embed(context.build_ctx(as_txn, art), context.load_ctx_embedding(f"{paths.artifacts}/ctx_encoder")).collect()}
    some = sorted(got)[:40]
    feats = spark.createDataFrame(
        [(k, emb[k] + list(snd[rows[k].sender_id].snd_emb) + list(rcv[rows[k].recipient_entity_id].rcv_emb)) for k in some], "txn_id string, features array<double>"
    )
    want = training.class_probabilities(training.load_classifier(f"{paths.artifacts}/classifier"), feats)
    for r in want.collect():
        assert all(abs(a - b) < 1e-9 for a, b in zip(r.prob, got[r.txn_id])) and abs(sum(r.prob) - 1) < 1e-9


def test_every_request_is_decided_or_rejected(spark, trained):
    data, paths, _ = trained
    req = cz.requests_from_transactions(data["transactions"])
    extra = spark.createDataFrame(
        [("no-one", "zzz", 5.0, "UNK_x", "NOBODY", None), ("blank", " ", 5.0, "r", "s", None), ("free", "zzz", 0.0, "r", "s", None), ("defaults", "zzz", 5.0, "", "", "")],
        req.schema,
    )
    decided, rejected = jobs.classify_requests(spark, req.union(extra), fixtures.external_replies(spark, SF), paths)
    d = {r.txn_id: r for r in decided.collect()}
    bad = {r.txn_id: r.reject_reason for r in rejected.collect()}
    assert not set(d) & set(bad) and len(d) + len(bad) == req.count() + 4
    assert "blank" in bad and "free" in bad
    assert (d["no-one"].decided_by, d["no-one"].final_label, d["no-one"].final_confidence) == ("fallback_oth", "OTH", 0.0)
    assert d["defaults"].decided_by == "layer3_model" and d["defaults"].sender_id and d["defaults"].recipient_entity_id
    assert {r.decided_by for r in d.values()} >= {"layer1_rule", "layer3_model", "fallback_oth"}


def test_empty_store_is_an_error(spark, trained):
    _, paths, _ = trained
    nowhere = shared_path(spark, "jobs", "nowhere", unique=True)
    with pytest.raises(ValueError, match="is empty"):
        scoring.newest_vectors(spark, nowhere, "sender_id", "snd_emb")
    ctx = spark.read.parquet(f"{paths.ctx}_train")
    with pytest.raises(ValueError, match="is empty"):
        training.training_set(spark, ctx, paths.x_snd, nowhere, io.scan_label_map(spark), 4, 96)
