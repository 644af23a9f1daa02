"""Per-transaction context features and their fitted artifacts."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.functions.textvec import with_hashed_sentence_vector
from paylabel.operators.snapshots import fit_category_vocab
from paylabel.plans import trainer
from paylabel.plans.networks import AutoEncoder
from paylabel.session import shared_path

NUMERIC = ["amount_log", "hour_sin", "hour_cos"]


@dataclass
class CtxArtifacts:
    means: list[float]
    stds: list[float]
    tt_vocab: list[str]
    ch_vocab: list[str]
    text_dim: int = 16

    @property
    def dim(self) -> int:
        return len(NUMERIC) + len(self.tt_vocab) + len(self.ch_vocab) + self.text_dim

    def save(self, spark: SparkSession, path: str) -> None:
        spark.createDataFrame([(json.dumps(asdict(self)),)], "artifact string").coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "CtxArtifacts":
        return CtxArtifacts(**json.loads(spark.read.json(path).first()["artifact"]))


def numeric_features(txn: DataFrame) -> DataFrame:
    return txn.select(
        "*",
        fx.amount_log().alias("amount_log"),
        fx.hour_sin().alias("hour_sin"),
        fx.hour_cos().alias("hour_cos"),
    )


def scaler_stats(txn: DataFrame) -> DataFrame:
    """One row: mean and population std per numeric feature (std 0 -> 1)."""
    num = numeric_features(txn)
    aggs = []
    for c in NUMERIC:
        aggs.append(F.avg(c).alias(f"{c}_mean"))
        aggs.append(F.stddev_pop(c).alias(f"{c}_std"))
    stats = num.agg(*aggs)
    return stats.select(
        *[F.col(f"{c}_mean") for c in NUMERIC],
        *[F.when(F.col(f"{c}_std") == 0, F.lit(1.0)).otherwise(F.col(f"{c}_std")).alias(f"{c}_std") for c in NUMERIC],
    )


def fit_ctx(txn: DataFrame, text_dim: int = 16) -> CtxArtifacts:
    row = scaler_stats(txn).first()
    return CtxArtifacts(
        means=[float(row[f"{c}_mean"]) for c in NUMERIC],
        stds=[float(row[f"{c}_std"]) for c in NUMERIC],
        tt_vocab=fit_category_vocab(txn, "tranx_type"),
        ch_vocab=fit_category_vocab(txn, "channel"),
        text_dim=text_dim,
    )


def ctx_vector(art: CtxArtifacts, text_vec: str = "_text_vec") -> F.Column:
    """[scaled numerics ‖ type one-hot ‖ channel one-hot ‖ text vector column]."""
    scaled = F.array(*[(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(NUMERIC, art.means, art.stds)])
    return fx.concat_vectors(
        scaled,
        fx.one_hot(fx.fill_unknown("tranx_type"), art.tt_vocab),
        fx.one_hot(fx.fill_unknown("channel"), art.ch_vocab),
        F.col(text_vec),
    )


def with_ctx_vector(txn: DataFrame, art: CtxArtifacts) -> DataFrame:
    """The transactions' columns and ``ctx_vec``."""
    num = with_hashed_sentence_vector(numeric_features(txn), "msg_content", art.text_dim, "_text_vec")
    return num.select(*txn.columns, ctx_vector(art).alias("ctx_vec"))


def build_ctx(txn: DataFrame, art: CtxArtifacts, mode: str = "inference") -> DataFrame:
    """Context table: ``txn_id, ctx_vec`` (+ training columns in ``mode='train'``)."""
    num = with_ctx_vector(txn, art)
    cols = [F.col("txn_id").cast("string").alias("txn_id"), F.col("ctx_vec")]
    if mode == "train":
        cols += [fx.txn_date().alias("txn_date"), "sender_id", "recipient_entity_id"]
        if "category" in txn.columns:
            cols.append(F.col("category").alias("label_l1"))
    elif mode != "inference":
        raise ValueError(f"mode must be 'train' or 'inference', got {mode!r}")
    return num.select(*cols)


TRAIN_COLUMNS = ["txn_id", "sender_id", "recipient_entity_id", "txn_date", "label_l1"]


def require_columns(df: DataFrame, columns: list[str] = TRAIN_COLUMNS) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}. Build the context table with mode='train'.")
    return df


def fit_ctx_embedding(ctx: DataFrame, k: int = 128):
    """PCA of the context vectors: the optimal linear auto-encoder under MSE.

    Returns ``(model, reconstruction_mse_df)``; k is clipped to the input width.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    d = ctx.select(F.size("ctx_vec").alias("d")).first()["d"]
    kk = min(k, d)
    vec = ctx.select("txn_id", array_to_vector("ctx_vec").alias("x"))
    model = PCA(k=kk, inputCol="x", outputCol="z").fit(vec)
    pc = model.pc.toArray()  # d x k, a fitted artifact of bounded size
    z = model.transform(vec).select("txn_id", vector_to_array("x").alias("x"), vector_to_array("z").alias("z"))
    recon = F.array(*[F.aggregate(F.zip_with("z", F.array(*[F.lit(float(pc[i, j])) for j in range(kk)]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b) for i in range(d)])
    mse = z.select(F.avg(F.aggregate(F.zip_with("x", recon, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda a, b: a + b) / F.lit(float(d))).alias("mse"))
    return model, mse


def held_out(id_col: str = "txn_id", one_in: int = 10) -> F.Column:
    """Rows kept for validation, by a hash of their id."""
    return F.pmod(F.xxhash64(id_col, F.lit(7)), F.lit(one_in)) == 0


def fit_ctx_autoencoder(
    ctx: DataFrame,
    code: int = 128,
    hidden: int = 256,
    epochs: int = 5,
    lr: float = 1e-3,
    patience: int = 3,
    drop: float = 0.2,
    batch_rows: int = trainer.BATCH_ROWS,
    seed: int = 42,
    checkpoint: str | None = None,
) -> trainer.Fitted:
    """The context encoder: a normalised, non-linear auto-encoder trained on the context vectors.

    A tenth of the rows is held out; ``extra["history"]`` holds the losses of every epoch, the
    parameters are those of the best one.
    """
    spark = ctx.sparkSession
    d = ctx.select(F.size("ctx_vec").alias("d")).first()["d"]
    root = shared_path(spark, "blocks", "ctx", unique=True)
    # blocks hold single precision: half as much travels and waits to be packed
    rows, encode = ctx.select("txn_id", F.col("ctx_vec").cast("array<float>").alias("ctx_vec")), trainer.vectors("ctx_vec")
    steps = trainer.rounds_of(rows.count(), batch_rows)
    train = trainer.pack_blocks(rows.where(~held_out()), f"{root}/train", encode, "txn_id", steps, seed)
    val = trainer.pack_blocks(rows.where(held_out()), f"{root}/val", encode, "txn_id", 1, seed)
    net = AutoEncoder(d, code, hidden, drop)
    state = trainer.fit(net, train, val, epochs, lr, patience, seed, checkpoint)
    return trainer.Fitted(net, state.best if state.best is not None else state.params, {"history": state.history})


def load_ctx_embedding(path: str) -> trainer.Fitted:
    return trainer.Fitted.load(SparkSession.getActiveSession(), path)


def embed(ctx: DataFrame, model) -> DataFrame:
    """Adds ``ctx_emb``, the fitted embedding of ``ctx_vec``."""
    from pyspark.ml.functions import array_to_vector, vector_to_array

    if isinstance(model, trainer.Fitted):
        return model.apply(ctx, trainer.vectors("ctx_vec"), ["ctx_vec"], "ctx_emb")
    return model.transform(ctx.withColumn("x", array_to_vector("ctx_vec"))).withColumn("ctx_emb", vector_to_array("z")).drop("x", "z")


def fit_word2vec(docs: DataFrame, text_col: str = "msg_content", dim: int = 16, min_count: int = 1, seed: int = 42):
    """Word2Vec fitted on the memo corpus; its ``getVectors()`` is a word-vector table
    for ``sentence_vector_from_table`` (the join form never broadcasts the vocabulary)."""
    from pyspark.ml.feature import Word2Vec

    from paylabel.functions.textvec import tokens

    corpus = docs.select(tokens(text_col).alias("tok"))
    w2v = Word2Vec(vectorSize=dim, minCount=min_count, inputCol="tok", outputCol="vec", seed=seed, maxIter=1)
    return w2v.fit(corpus)
