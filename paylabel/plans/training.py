"""Training-set assembly, splits, classifier fit and batch scoring."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.operators.ranking import bucketed_rank, exact_quantiles
from paylabel.plans import trainer
from paylabel.plans.context import require_columns
from paylabel.plans.networks import Classifier
from paylabel.session import shared_path
from paylabel.sources import io


def label_lookup(df: DataFrame, label_map: DataFrame, code_col: str = "label_l1") -> DataFrame:
    """Adds ``label_idx`` (-1 when the code is not in the taxonomy)."""
    lm = F.broadcast(label_map.select(F.col("code").alias(code_col), F.col("idx").alias("label_idx")))  # 10-row taxonomy
    return df.join(lm, code_col, "left").withColumn("label_idx", F.coalesce(F.col("label_idx"), F.lit(-1)))


def pit_join(
    df: DataFrame,
    snaps: DataFrame | None,
    key: str,
    emb_col: str,
    dim: int,
    snap_key: str | None = None,
) -> DataFrame:
    """Left equi-join on ``(key, _feature_date)``; a missing row gets a zero vector."""
    if snaps is None:
        return df.withColumn(emb_col, fx.zeros(dim)).withColumn(f"has_{emb_col}", F.lit(False))
    s = snaps.select(F.col(snap_key or key).alias(key), "_feature_date", F.col(emb_col))
    j = df.join(s, [key, "_feature_date"], "left")
    return j.withColumn(f"has_{emb_col}", F.col(emb_col).isNotNull()).withColumn(emb_col, fx.fill_missing_embedding(emb_col, dim))


def training_set(
    spark: SparkSession,
    ctx: DataFrame,
    snd_root: str,
    rcv_root: str,
    label_map: DataFrame,
    snd_dim: int,
    rcv_dim: int,
    lookback_days: int = 1,
    recipient_key: str = "raw",
    ctx_col: str = "ctx_vec",
) -> DataFrame:
    """Context ⟕ sender snapshot ⟕ recipient snapshot at ``txn_date - lookback``.

    ``recipient_key='raw'`` joins the raw ``recipient_entity_id`` (reference
    behaviour: merchant-only rows get zeros); ``'canonical'`` joins the
    canonical id when the context table carries ``recipient_canon_id``.
    Output adds ``features`` (``ctx_col`` ‖ snd ‖ rcv), ``label_idx``, ``is_valid``.  A store
    without any snapshot is an error, a date without one gives zeros.
    """
    require_columns(ctx)
    base = ctx.withColumn("_feature_date", fx.feature_date("txn_date", lookback_days))
    wanted = base.select("_feature_date").distinct()
    snd = io.scan_snapshots(spark, snd_root, wanted)
    rcv = io.scan_snapshots(spark, rcv_root, wanted)
    for tower, found in ((snd_root, snd), (rcv_root, rcv)):
        if found is None:
            raise ValueError(f"The feature store {tower} is empty. Build it before the training set.")
    j = pit_join(base, snd, "sender_id", "snd_emb", snd_dim)
    rkey = "recipient_canon_id" if recipient_key == "canonical" else "recipient_entity_id"
    j = pit_join(j, rcv, rkey, "rcv_emb", rcv_dim, snap_key="recipient_canon_id")
    j = label_lookup(j, label_map)
    return j.withColumn("features", fx.concat_vectors(ctx_col, "snd_emb", "rcv_emb")).withColumn(
        "is_valid", F.col("label_idx") >= 0
    )


# ----------------------------------------------------------------- splits


def temporal_cut(df: DataFrame, val_split: float = 0.2, date_col: str = "txn_date") -> DataFrame:
    """One row ``cut`` = linear quantile (1 - val_split) of the row dates, in days."""
    days = df.select(F.unix_date(F.col(date_col)).alias("_d"))
    q = exact_quantiles(days, "_d", [1.0 - val_split])
    return q.select(F.col("value").alias("cut"))


def temporal_split(df: DataFrame, val_split: float = 0.2, date_col: str = "txn_date") -> DataFrame:
    """Adds ``split``: ``train`` when the date is before the cut, else ``val``."""
    cut = temporal_cut(df, val_split, date_col).scalar()
    return df.withColumn("split", F.when(F.unix_date(F.col(date_col)).cast("double") < cut, "train").otherwise("val"))


#: Rows of one bucket of a label's rank, about.
RANK_BUCKET_ROWS = 4096


def stratified_split(df: DataFrame, val_split: float = 0.2, seed: int = 42, label_col: str = "label_idx", id_col: str = "txn_id") -> DataFrame:
    """Per label, the ``ceil(n·val_split)`` rows with the smallest ``md5(id#seed)`` go to ``val``.

    Exact and repeatable; the per-label rank is bucketed on the hash prefix, whose length
    grows with the largest label, so that a dominant label is ranked by many small tasks.
    """
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"#{seed}")))
    sizes = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n")).checkpoint(eager=True)
    largest = sizes.agg(F.max("_n")).first()[0] or 1
    digits = max(1, math.ceil(math.log(max(largest / RANK_BUCKET_ROWS, 1), 16)))
    ranked = bucketed_rank(df.withColumn("_h", h), [label_col], F.substring("_h", 1, digits), [F.col("_h"), F.col(id_col)], out="_rk")
    return (
        ranked.join(sizes, label_col)
        .withColumn("split", F.when(F.col("_rk") <= F.ceil(F.col("_n") * F.lit(val_split)), "val").otherwise("train"))
        .drop("_h", "_rk", "_n")
    )


# ---------------------------------------------------------------- model


def _confusion(net: Classifier, params: np.ndarray) -> Callable[[Iterator[bytes]], Iterator[np.ndarray]]:
    def run(blocks: Iterator[bytes]) -> Iterator[np.ndarray]:
        table = np.zeros((net.spec["classes"],) * 2)
        for raw in blocks:
            block = trainer.unpack(raw)
            np.add.at(table, (block["y"], net.outputs(params, block).argmax(axis=1)), 1)
        yield table

    return run


def epoch_metrics(net: Classifier, blocks: DataFrame) -> Callable[[np.ndarray], dict[str, float]]:
    """Validation accuracy and macro-F1 of a parameter vector, from one confusion table."""
    parts = trainer.block_parts(blocks)

    def of(params: np.ndarray) -> dict[str, float]:
        table = parts.mapPartitions(_confusion(net, params)).fold(np.zeros((net.spec["classes"],) * 2), np.add)  # classes x classes
        hit, given, said = table.diagonal(), table.sum(axis=1), table.sum(axis=0)
        seen = (given + said) > 0
        return {"accuracy": float(hit.sum() / max(table.sum(), 1)), "f1_macro": float((2 * hit[seen] / (given + said)[seen]).mean()) if seen.any() else 0.0}

    return of


def fit_classifier(
    train: DataFrame,
    val: DataFrame,
    n_classes: int,
    hidden: tuple[int, ...] = (512, 256),
    drops: tuple[float, ...] = (0.3, 0.2),
    epochs: int = 8,
    patience: int = 3,
    seed: int = 42,
    lr: float = 1e-3,
    batch_rows: int = trainer.BATCH_ROWS,
    id_col: str = "txn_id",
    checkpoint: str | None = None,
) -> tuple[trainer.Fitted, DataFrame]:
    """Layers with normalisation and dropout, trained by mini-batch Adam on data-parallel gradients.

    After every epoch the validation loss, accuracy and macro-F1 are taken; training stops after ``patience``
    epochs without a lower loss, and the parameters of the best epoch are kept.  Returns the model, whose
    ``extra["history"]`` holds all epochs, and the best state's metrics.
    """
    from paylabel.operators.metrics import evaluate

    spark = train.sparkSession
    d = train.select(F.size("features")).first()[0]
    root = shared_path(spark, "blocks", "classifier", unique=True)
    encode = trainer.vectors("features", "label_idx")
    rows = lambda df: df.select(F.col(id_col), "features", F.col("label_idx").cast("int").alias("label_idx"))
    single = lambda df: rows(df).withColumn("features", F.col("features").cast("array<float>"))  # noqa: E731  as blocks hold them
    steps = trainer.rounds_of(train.count(), batch_rows)
    tr = trainer.pack_blocks(single(train), f"{root}/train", encode, id_col, steps, seed)
    va = trainer.pack_blocks(single(val), f"{root}/val", encode, id_col, 1, seed)
    net = Classifier(d, n_classes, tuple(hidden), (tuple(drops) + (0.0,) * len(hidden))[: len(hidden)])
    state = trainer.fit(net, tr, va, epochs, lr, patience, seed, checkpoint, epoch_metrics(net, va))
    model = trainer.Fitted(net, state.best if state.best is not None else state.params, {"history": state.history})
    # every metric reads the scored rows: score them once
    scored = score_batch(model, rows(val), keep=["label_idx"]).select("label", "pred", "logits", "prob").checkpoint(eager=True)
    return model, evaluate(scored, n_classes)


def training_history(spark: SparkSession, model: trainer.Fitted) -> DataFrame:
    """One row per epoch: losses, validation accuracy and macro-F1."""
    rows = [(int(h["epoch"]), h["train_loss"], h["val_loss"], h["accuracy"], h["f1_macro"]) for h in model.extra["history"]]
    return spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double, accuracy double, f1_macro double")


def load_classifier(path: str) -> trainer.Fitted:
    return trainer.Fitted.load(SparkSession.getActiveSession(), path)


def class_probabilities(model: trainer.Fitted, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) with ``logits`` and ``prob`` for a table with ``features``; labels are not needed."""
    return model.apply(df, trainer.vectors("features"), ["features"], "logits", keep).withColumn("prob", fx.softmax("logits"))


def score_batch(model: trainer.Fitted, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``logits``, ``prob``, ``pred`` and ``confidence`` for a feature table."""
    out = class_probabilities(model, df, keep)
    return out.withColumn("pred", fx.argmax("prob")).withColumn("confidence", F.array_max("prob")).withColumn(
        "label", F.col("label_idx").cast("int")
    )
