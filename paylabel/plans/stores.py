"""Incremental, date-partitioned sender and recipient feature stores."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.operators import graph, snapshots
from paylabel.sources import io

FEATURE_VERSION = "v1"


@dataclass
class SenderStoreSpec:
    tt_vocab: list[str]
    ch_vocab: list[str]
    lookback_days: int = 10
    half_life_days: float = 2.0

    @property
    def dim(self) -> int:
        return len(snapshots.state_dims(self.tt_vocab, self.ch_vocab))


@dataclass
class RecipientStoreSpec:
    svd_dim: int = 64
    hash_dim: int = 32
    lookback_days: int = 10

    @property
    def dim(self) -> int:
        return self.svd_dim + self.hash_dim


def transaction_dates(txn: DataFrame) -> DataFrame:
    return txn.select(fx.txn_date().alias("snapshot_date")).where(F.col("snapshot_date").isNotNull()).distinct()


def incremental_dates(spark: SparkSession, txn: DataFrame, store_root: str, snapshot_date: str | None = None) -> DataFrame:
    """Dates to build: all transaction dates not yet stored; an explicit date overrides."""
    if snapshot_date is not None:
        return spark.range(1).select(F.to_date(F.lit(snapshot_date)).alias("snapshot_date"))
    have = spark.createDataFrame([(d,) for d in io.stored_dates(spark, store_root)], "d string").select(
        F.to_date("d").alias("snapshot_date")
    )
    return transaction_dates(txn).join(have, "snapshot_date", "left_anti")


def todo_range(todo: DataFrame):
    """(first, last) date to build, or ``None`` when there is nothing to do (one job)."""
    lo, hi = todo.agg(F.min("snapshot_date"), F.max("snapshot_date")).first()
    return None if lo is None else (lo, hi)


def restrict_to_windows(txn: DataFrame, bounds, lookback_days: int) -> DataFrame:
    """Only the transactions that can fall in a window of a date to build.

    The bound is a predicate on the raw timestamp column, so it reaches the
    parquet scan as a pushed filter; an incremental run over one new date
    reads ``lookback_days + 1`` days, not the whole history.
    """
    lo, hi = bounds
    start = F.lit(str(lo - timedelta(days=lookback_days))).cast("timestamp_ntz")
    end = F.lit(str(hi + timedelta(days=1))).cast("timestamp_ntz")
    return txn.where((F.col("txn_time_utc") >= start) & (F.col("txn_time_utc") < end))


def _finish(spark: SparkSession, states: DataFrame, store_root: str, key: str, emb_col: str, todo: DataFrame) -> DataFrame | None:
    out = snapshots.with_snapshot_metadata(states.withColumnRenamed("state", emb_col), FEATURE_VERSION).withColumn(
        "date", F.date_format("snapshot_date", "yyyy-MM-dd")
    )
    io.sink_daily_snapshot(out, store_root)
    # read back what was just written: the cumulative upsert starts from the written
    # partitions instead of recomputing the snapshot plan
    new_dates = [r[0] for r in todo.select(F.date_format("snapshot_date", "yyyy-MM-dd")).collect()]  # one row per date built
    written = spark.read.schema(out.schema).parquet(io.daily_root(store_root)).where(F.date_format("date", "yyyy-MM-dd").isin(new_dates))
    io.sink_upsert_cumulative(spark, written.drop("date"), store_root, key=key)
    return written


def build_sender_store(
    spark: SparkSession, txn: DataFrame, store_root: str, spec: SenderStoreSpec, snapshot_date: str | None = None
) -> DataFrame | None:
    todo = incremental_dates(spark, txn, store_root, snapshot_date).checkpoint(eager=True)
    bounds = todo_range(todo)
    if bounds is None:
        return None
    txn = restrict_to_windows(txn, bounds, spec.lookback_days)
    events = snapshots.event_features(txn, spec.tt_vocab, spec.ch_vocab)
    states = snapshots.sender_state(events, spec.tt_vocab, spec.ch_vocab, spec.lookback_days, spec.half_life_days)
    states = states.join(F.broadcast(todo), "snapshot_date", "left_semi")  # one row per date
    return _finish(spark, states.select("sender_id", "snapshot_date", "n_window_txns", "state"), store_root, "sender_id", "snd_emb", todo)


def build_recipient_store(
    spark: SparkSession,
    txn: DataFrame,
    entity: DataFrame,
    merchant: DataFrame,
    person: DataFrame,
    store_root: str,
    spec: RecipientStoreSpec,
    snapshot_date: str | None = None,
) -> DataFrame | None:
    todo = incremental_dates(spark, txn, store_root, snapshot_date).checkpoint(eager=True)
    bounds = todo_range(todo)
    if bounds is None:
        return None
    txn = restrict_to_windows(txn, bounds, spec.lookback_days)
    # read once, by the factorisation, which writes them in its own form
    edges = graph.interaction_edges(txn, spec.lookback_days).join(F.broadcast(todo), "snapshot_date", "left_semi")
    active = graph.active_recipients(txn).join(F.broadcast(todo), "snapshot_date", "left_semi").checkpoint(eager=True)
    ids = active.select("recipient_canon_id").distinct()
    meta = graph.recipient_metadata(entity, merchant, person)
    hashed = graph.hashed_recipients(ids, meta, spec.hash_dim)
    states = graph.recipient_state(edges, hashed, spec.svd_dim, active)
    return _finish(spark, states, store_root, "recipient_canon_id", "rcv_emb", todo)
