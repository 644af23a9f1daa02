"""User-level jobs: the pipeline stages as functions over a data folder.

``data`` is a dict of DataFrames with the reference's table names
(``transactions``, ``recipient_entity``, ``merchant_profile``,
``person_profile``); ``root`` is a shared folder for stores and artifacts.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel.plans import context, scoring, stores, training
from paylabel.plans.encoders import fit_next_event_models, fit_sender_encoder
from paylabel.operators import snapshots
from paylabel.operators.ranking import exact_quantiles
from paylabel.functions import features as fx
from paylabel.sources import io

REQUIRED_TABLES = ["transactions", "recipient_entity", "merchant_profile", "person_profile"]

#: Reported name and folder of each fitted artifact.
ARTIFACTS = {
    "ctx_artifacts": "ctx",
    "ctx_embedding": "ctx_encoder",
    "amount_quantiles": "amount_quantiles",
    "next_event_type": "next_event_y_type",
    "next_event_amount": "next_event_y_amount",
    "sender_encoder": "sender_encoder",
    "classifier": "classifier",
}


@dataclass
class Paths:
    root: str

    @property
    def artifacts(self) -> str:
        return f"{self.root}/artifacts"

    @property
    def ctx(self) -> str:
        return f"{self.root}/processed/ctx_emb"

    @property
    def x_snd(self) -> str:
        return f"{self.root}/feature_store/x_snd"

    @property
    def x_rcv(self) -> str:
        return f"{self.root}/feature_store/x_rcv"


def check_inputs(spark: SparkSession, data: dict[str, DataFrame | None], paths: Paths) -> DataFrame:
    """Presence report of the input tables and fitted artifacts."""
    rows = [(name, "table", data.get(name) is not None) for name in REQUIRED_TABLES]
    for item, folder in ARTIFACTS.items():
        rows.append((item, "artifact", io.path_exists(spark, f"{paths.artifacts}/{folder}")))
    rows.append(("x_snd", "store", bool(io.stored_dates(spark, paths.x_snd))))
    rows.append(("x_rcv", "store", bool(io.stored_dates(spark, paths.x_rcv))))
    return spark.createDataFrame(rows, "item string, kind string, present boolean")


def fit_encoders(
    spark: SparkSession,
    data: dict[str, DataFrame],
    paths: Paths,
    text_dim: int = 300,
    emb_dim: int = 128,
    ctx_epochs: int = 5,
    sender_epochs: int = 5,
    sender_hidden: int = 128,
    run_id: str | None = None,
) -> context.CtxArtifacts:
    """Fit context artifacts (scaler, vocabularies), the context auto-encoder, the recurrent
    sender encoder and its linear baseline; save them and the amount quantiles.

    Both trainings write a checkpoint after every epoch; a stopped run goes on from it under the same ``run_id``.
    """
    progress = f"{paths.root}/training/{run_id or uuid.uuid4().hex[:12]}"
    t = data["transactions"]
    art = context.fit_ctx(t, text_dim)
    art.save(spark, f"{paths.artifacts}/ctx")
    ctx = context.build_ctx(t, art)
    encoder = context.fit_ctx_autoencoder(ctx, emb_dim, epochs=ctx_epochs, checkpoint=f"{progress}/ctx_encoder")
    encoder.save(spark, f"{paths.artifacts}/ctx_encoder")
    ev = snapshots.event_features(t, art.tt_vocab, art.ch_vocab)
    q = exact_quantiles(ev, "amount_log", [0.2, 0.4, 0.6, 0.8])
    io.save_table(q, f"{paths.artifacts}/amount_quantiles")
    edges = [q.where(F.col("q_idx") == i).select("value").scalar() for i in range(4)]
    hist = snapshots.sender_history(ev.withColumn("amt_bin", fx.bin_by_edges("amount_log", edges)))
    ex = snapshots.next_event_examples(hist, ["amount_log", "hour_sin", "hour_cos", "tt_idx", "ch_idx"], ["tt_idx", "amt_bin"])
    ex = ex.checkpoint(eager=True)
    sender = fit_sender_encoder(
        ex, len(art.tt_vocab), len(art.ch_vocab), sender_hidden, sender_epochs, checkpoint=f"{progress}/sender_encoder"
    )
    sender.save(spark, f"{paths.artifacts}/sender_encoder")
    heads, losses = fit_next_event_models(ex, len(art.tt_vocab))
    for head, fitted in heads.items():
        io.save_model(fitted, f"{paths.artifacts}/next_event_{head}")
    io.save_table(losses, f"{paths.artifacts}/next_event_losses")
    return art


def build_ctx(spark: SparkSession, data: dict[str, DataFrame], paths: Paths, mode: str = "inference") -> DataFrame:
    art = context.CtxArtifacts.load(spark, f"{paths.artifacts}/ctx")
    out = context.build_ctx(data["transactions"], art, mode)
    out = context.embed(out, context.load_ctx_embedding(f"{paths.artifacts}/ctx_encoder"))
    io.sink_ctx(out, f"{paths.ctx}_{mode}")
    return spark.read.parquet(f"{paths.ctx}_{mode}")


def build_sender_store(spark, data, paths: Paths, lookback_days: int = 10, snapshot_date: str | None = None):
    art = context.CtxArtifacts.load(spark, f"{paths.artifacts}/ctx")
    spec = stores.SenderStoreSpec(art.tt_vocab, art.ch_vocab, lookback_days)
    return stores.build_sender_store(spark, data["transactions"], paths.x_snd, spec, snapshot_date)


def build_recipient_store(spark, data, paths: Paths, svd_dim: int = 64, hash_dim: int = 32, lookback_days: int = 10, snapshot_date: str | None = None):
    spec = stores.RecipientStoreSpec(svd_dim, hash_dim, lookback_days)
    return stores.build_recipient_store(
        spark, data["transactions"], data["recipient_entity"], data["merchant_profile"], data["person_profile"], paths.x_rcv, spec, snapshot_date
    )


def fit_classifier(
    spark: SparkSession,
    paths: Paths,
    lookback_days: int = 1,
    val_split: float = 0.2,
    split_method: str = "date",
    hidden: tuple[int, ...] = (512, 256),
    epochs: int = 8,
    patience: int = 3,
    svd_dim: int = 64,
    hash_dim: int = 32,
    run_id: str | None = None,
):
    art = context.CtxArtifacts.load(spark, f"{paths.artifacts}/ctx")
    ctx = spark.read.parquet(f"{paths.ctx}_train")
    snd_dim = len(snapshots.state_dims(art.tt_vocab, art.ch_vocab))
    ts = training.training_set(spark, ctx, paths.x_snd, paths.x_rcv, io.scan_label_map(spark), snd_dim, svd_dim + hash_dim, lookback_days, ctx_col="ctx_emb")
    ts = ts.where("is_valid")
    if split_method == "date":
        split = training.temporal_split(ts, val_split)
    elif split_method == "random":
        split = training.stratified_split(ts, val_split)
    else:
        raise ValueError(f"split_method must be 'date' or 'random', not {split_method!r}")
    split = split.checkpoint(eager=True)
    model, metrics = training.fit_classifier(
        split.where("split = 'train'"), split.where("split = 'val'"), 10, hidden, epochs=epochs, patience=patience,
        checkpoint=f"{paths.root}/training/{run_id or uuid.uuid4().hex[:12]}/classifier",
    )
    model.save(spark, f"{paths.artifacts}/classifier")
    return model, metrics


def run_inference_features(spark, data, paths: Paths):
    build_ctx(spark, data, paths, "inference")
    build_sender_store(spark, data, paths)
    build_recipient_store(spark, data, paths)


def score_requests(spark: SparkSession, requests: DataFrame, paths: Paths) -> DataFrame:
    """``txn_id, logits, prob`` of the requests whose sender and recipient are stored."""
    return scoring.score_requests(requests, scoring.load_scorer(spark, paths.artifacts, paths.x_snd, paths.x_rcv))


def classify_requests(spark: SparkSession, requests: DataFrame, replies: DataFrame, paths: Paths) -> tuple[DataFrame, DataFrame]:
    """``(decided, rejected)`` by rules, external replies and the trained model."""
    return scoring.classify_requests(requests, scoring.load_scorer(spark, paths.artifacts, paths.x_snd, paths.x_rcv), replies)


def run_training(spark, data, paths: Paths, text_dim: int = 300, emb_dim: int = 128, encoder_args: dict | None = None, **clf_args):
    fit_encoders(spark, data, paths, text_dim, emb_dim, **(encoder_args or {}))
    build_ctx(spark, data, paths, "train")
    build_sender_store(spark, data, paths)
    build_recipient_store(spark, data, paths)
    return fit_classifier(spark, paths, **clf_args)
