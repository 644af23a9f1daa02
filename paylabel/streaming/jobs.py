"""Structured Streaming forms of the two online surfaces.

* ``stream_score`` — transaction files arriving in a folder are scored by the
  cascade in micro-batches (``foreachBatch``: each batch runs the exact batch
  cascade against the static stores and replies, so batch = stream).
* ``classify_stream`` — the same surface on the trained parts: newest stored vectors,
  classifier, decisions and rejects as two sinks.
* ``stream_daily_edges`` — per-day sender -> recipient activity: each micro-batch
  stores its own sums under its id and a reader merges them, so all days and late
  rows count.

Both run with ``trigger(availableNow=True)`` so they drain what is present and
stop; on a cluster the same code runs with a processing-time trigger.
Checkpoints live under the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylabel.functions import features as fx
from paylabel.operators import cascade as cz
from paylabel.plans import scoring
from paylabel.plans.jobs import Paths
from paylabel.session import shared_path
from paylabel.sources import fixtures, io


def _stage_transactions(spark: SparkSession, sf: str, tag: str) -> tuple[str, object]:
    """Write the transaction stand-in as the stream's landing folder."""
    landing = shared_path(spark, "streams", tag, "landing", unique=True)
    t = fixtures.transactions(spark, sf)
    t.write.mode("overwrite").parquet(landing)
    return landing, t.schema


def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    landing, schema = _stage_transactions(spark, sf, "score")
    out = shared_path(spark, "streams", "score", "out", unique=True)
    ckpt = shared_path(spark, "streams", "score", "ckpt", unique=True)
    lm = io.scan_label_map(spark)
    codes = [r.code for r in lm.orderBy("idx").collect()]
    replies = fixtures.external_replies(spark, sf)

    def handle(batch: DataFrame, batch_id: int) -> None:
        req = cz.validate_requests(cz.requests_from_transactions(batch)).where("is_valid").drop("is_valid", "reject_reason")
        # fixed linear scorer as the model layer (a fitted PipelineModel plugs in here)
        feats = [fx.amount_log() / F.lit(10.0), fx.hour_sin(), fx.hour_cos()]
        scores = cz.linear_scores(batch, feats, 10).select("txn_id", "prob")

        def score_fn(rest: DataFrame) -> DataFrame:
            return scores.join(rest.select("txn_id"), "txn_id", "left_semi")

        decided = cz.cascade_classify(req, lm, codes, replies, score_fn)
        # a retried batch rewrites its own folder: the sink stays exactly-once
        decided.select("txn_id", "final_label", "final_confidence", "decided_by").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    q = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(landing)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.parquet(out).drop("batch")


def classify_stream(
    spark: SparkSession, landing: str, schema: T.StructType, replies: DataFrame, paths: Paths, out: str, checkpoint: str, files_per_batch: int = 4
) -> None:
    """Requests arriving as files, decided with the trained parts; drains what is there.

    Every micro-batch looks up the newest stored vectors anew, so a store published while the stream runs serves
    the next batch.  Decisions and rejects are two sinks; a batch writes each under its own id, so
    a repeated batch replaces what it wrote and every request counts once in exactly one of them.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        scorer = scoring.load_scorer(spark, paths.artifacts, paths.x_snd, paths.x_rcv)
        decided, rejected = scoring.classify_requests(batch, scorer, replies)
        decided = decided.select("txn_id", "decided_by", "final_label", "final_confidence")
        decided.write.mode("overwrite").parquet(f"{out}/decided/batch={batch_id}")
        rejected.write.mode("overwrite").parquet(f"{out}/rejected/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def classified(spark: SparkSession, out: str) -> tuple[DataFrame, DataFrame]:
    """``(decided, rejected)``: what the stream has written so far."""
    decided = "txn_id string, decided_by string, final_label string, final_confidence double, batch int"
    rejected = "txn_id string, reject_reason string, batch int"
    return spark.read.schema(decided).parquet(f"{out}/decided"), spark.read.schema(rejected).parquet(f"{out}/rejected")


def daily_edges(events: DataFrame) -> DataFrame:
    """Per (day, sender, recipient): amount sum and row count of the rows given."""
    t = events.withColumn("day", fx.txn_date()).withColumn("recipient_canon_id", fx.canonical_recipient())
    return t.groupBy("day", "sender_id", "recipient_canon_id").agg(F.sum("amount").alias("amount_sum"), F.count(F.lit(1)).alias("n"))


def stream_daily_edges(spark: SparkSession, sf: str) -> DataFrame:
    """All days, late rows included: every micro-batch adds its own sums, a reader merges them by key.

    A batch overwrites the partition of its own id, so a repeated batch counts once; no state
    is kept, so no row is ever too late.
    """
    landing, schema = _stage_transactions(spark, sf, "edges")
    out = shared_path(spark, "streams", "edges", "out", unique=True)
    ckpt = shared_path(spark, "streams", "edges", "ckpt", unique=True)

    def add(batch: DataFrame, batch_id: int) -> None:
        daily_edges(batch).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(landing)
    q = stream.writeStream.foreachBatch(add).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    kind = "day date, sender_id string, recipient_canon_id string, amount_sum double, n long, batch int"
    merged = spark.read.schema(kind).parquet(out).groupBy("day", "sender_id", "recipient_canon_id")
    merged = merged.agg(F.sum("amount_sum").alias("amount_sum"), F.sum("n").alias("n"))
    return merged.select(
        F.col("day").cast("string").alias("day"), "sender_id", "recipient_canon_id", fx.round6("amount_sum").alias("amount_sum"), "n"
    )
