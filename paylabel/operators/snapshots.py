"""Point-in-time snapshots of sender behaviour and the sequence operators.

Everything here is keyed by ``(id, snapshot_date)``.  The reference loops over
dates on the driver and, per date, filters an 11-day window; here one job
covers all dates: each event (or, better, each per-day pre-aggregate) is
expanded to the snapshot dates whose window contains it (``d .. d+L``) and
inner-joined with the ``(id, date)`` pairs that were active — an equi-join,
no range predicate, no loop.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.operators.ranking import bucketed_rank

MAX_VOCAB = 10_000


# --------------------------------------------------------------- fitting


def fit_category_vocab(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values after the ``UNKNOWN`` fill (an encoder fit).

    The vocabulary of an enumerated column is a model artifact of bounded
    size; it is brought to the driver like any fitted model, after a size
    check.
    """
    vals = df.select(fx.fill_unknown(column).alias("v")).distinct()
    rows = vals.limit(MAX_VOCAB + 1).collect()
    if len(rows) > MAX_VOCAB:
        raise ValueError(f"{column}: more than {MAX_VOCAB} categories; not an enumerated column")
    return sorted(r.v for r in rows)


def category_index_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """``(column, value, idx)`` with 1-based idx in sorted order, as a DataFrame."""
    parts = None
    for c in columns:
        d = df.select(F.lit(c).alias("column"), fx.fill_unknown(c).alias("value")).distinct()
        parts = d if parts is None else parts.unionByName(d)
    w = Window.partitionBy("column").orderBy("value")
    return parts.withColumn("idx", F.row_number().over(w).cast("int"))


# -------------------------------------------------------------- features


def event_features(txn: DataFrame, tt_vocab: list[str], ch_vocab: list[str]) -> DataFrame:
    """Per-transaction sequence features (amount_log, hour sin/cos, type/channel idx)."""
    return txn.select(
        "txn_id",
        "sender_id",
        "txn_time_utc",
        fx.txn_date().alias("txn_date"),
        fx.amount_log().alias("amount_log"),
        fx.hour_sin().alias("hour_sin"),
        fx.hour_cos().alias("hour_cos"),
        fx.seconds_of_day().alias("sod"),
        fx.category_index(fx.fill_unknown("tranx_type"), tt_vocab).alias("tt_idx"),
        fx.category_index(fx.fill_unknown("channel"), ch_vocab).alias("ch_idx"),
    )


def state_dims(tt_vocab: list[str], ch_vocab: list[str]) -> list[str]:
    return (
        ["count", "amount_log", "hour_sin", "hour_cos"]
        + [f"tt={v}" for v in tt_vocab]
        + [f"ch={v}" for v in ch_vocab]
    )


def _event_vector_cols(tt_vocab: list[str], ch_vocab: list[str]) -> list[Column]:
    cols = [F.lit(1.0), F.col("amount_log"), F.col("hour_sin"), F.col("hour_cos")]
    cols += [F.when(F.col("tt_idx") == i + 1, 1.0).otherwise(0.0) for i in range(len(tt_vocab))]
    cols += [F.when(F.col("ch_idx") == i + 1, 1.0).otherwise(0.0) for i in range(len(ch_vocab))]
    return cols


# ------------------------------------------------------------ J1 / J2


def active_pairs(df: DataFrame, id_col: str, date_col: str = "txn_date") -> DataFrame:
    """Distinct ``(id, snapshot_date)`` of ids with at least one event that day."""
    return df.where(F.col(id_col).isNotNull()).select(id_col, F.col(date_col).alias("snapshot_date")).distinct()


def semi_active(df: DataFrame, id_col: str, snapshot_date: Column, lookback_days: int, date_col: str = "txn_date") -> DataFrame:
    """History rows in ``[D-L, D]`` of ids active on ``D`` (single date)."""
    active = df.where(F.col(date_col) == snapshot_date).select(id_col).distinct()
    window = df.where(F.col(date_col).between(F.date_sub(snapshot_date, lookback_days), snapshot_date))
    return window.join(active, on=id_col, how="left_semi")


def expand_to_snapshots(df: DataFrame, lookback_days: int, date_col: str = "txn_date") -> DataFrame:
    """Each row once per snapshot date whose window holds it: ``D in [d, d+L]``."""
    d = F.col(date_col)
    return df.withColumn("snapshot_date", F.explode(F.sequence(d, F.date_add(d, lookback_days))))


def snapshot_expand(df: DataFrame, id_col: str, lookback_days: int, date_col: str = "txn_date") -> DataFrame:
    """J2: rows of every (active id, date) window, for all dates in one job."""
    pairs = active_pairs(df, id_col, date_col)
    return expand_to_snapshots(df, lookback_days, date_col).join(pairs, on=[id_col, "snapshot_date"], how="inner")


# ----------------------------------------------------------- sender state


def sender_state(
    events: DataFrame,
    tt_vocab: list[str],
    ch_vocab: list[str],
    lookback_days: int = 10,
    half_life_days: float = 2.0,
) -> DataFrame:
    """One L2-normalised state vector per (sender active on D, D).

    The state is a continuous-time recurrent fold of the ordered history,
    ``h <- h * 2^(-dt/half_life) + x``, read at the end of day D.  Unrolled it
    is a weighted sum ``Σ 2^(-age_j/half_life) x_j`` (age in days to the end of
    D), which is decomposable: events are first summed per (sender, day) with
    the intra-day part of the weight, only those day rows are expanded to the
    ``L+1`` snapshot dates and re-weighted by whole days.  All sums are plain
    aggregates, so partial aggregation absorbs hot senders; the whole job is
    one scan and two shuffles, of day rows: they are expanded where all
    days of a sender lie, and summed there.

    Columns: ``sender_id, snapshot_date, n_window_txns, state``.
    """
    dims = len(state_dims(tt_vocab, ch_vocab))
    k = math.log(2.0) / half_life_days
    intra = F.exp(-F.lit(k) * (F.lit(86400.0) - F.col("sod").cast("double")) / F.lit(86400.0))
    vec = _event_vector_cols(tt_vocab, ch_vocab)
    daily = (
        events.where(F.col("sender_id").isNotNull())
        .withColumn("_w", intra)
        .groupBy("sender_id", "txn_date")
        .agg(F.count(F.lit(1)).alias("n_day"), *[F.sum(c * F.col("_w")).alias(f"s{i}") for i, c in enumerate(vec)])
    )
    # (sender, D) is active iff one of its expanded day rows is day D itself, so
    # the active-pair join becomes a filter after one partially aggregated shuffle
    expanded = expand_to_snapshots(daily.repartition("sender_id"), lookback_days)
    whole = F.exp(-F.lit(k) * F.datediff("snapshot_date", "txn_date").cast("double"))
    agg = (
        expanded.groupBy("sender_id", "snapshot_date")
        .agg(
            F.max((F.col("txn_date") == F.col("snapshot_date")).cast("int")).alias("_active"),
            F.sum("n_day").alias("n_window_txns"),
            *[F.sum(F.col(f"s{i}") * whole).alias(f"h{i}") for i in range(dims)],
        )
        .where(F.col("_active") == 1)
    )
    return agg.select(
        "sender_id",
        "snapshot_date",
        "n_window_txns",
        fx.l2_normalize(F.array(*[F.col(f"h{i}") for i in range(dims)])).alias("state"),
    )


def with_snapshot_metadata(df: DataFrame, version: str = "v1") -> DataFrame:
    return df.withColumn("feature_version", F.lit(version)).withColumn("updated_at", F.current_timestamp())


# ------------------------------------------------------------ sequences


def sender_history(events: DataFrame) -> DataFrame:
    """Events with their exact per-sender sequence number (ordered by time, txn_id).

    The history stays a table keyed by ``(sender_id, seq_no)``: an unbounded
    per-sender list is never built.  Ranks are minute-bucketed (see
    ``bucketed_rank``) so a hot sender is ranked by many tasks.
    """
    return bucketed_rank(
        events,
        ["sender_id"],
        F.date_trunc("minute", F.col("txn_time_utc")),
        [F.col("txn_time_utc"), F.col("txn_id")],
        out="seq_no",
    )


def next_event_examples(
    history: DataFrame,
    feature_cols: list[str],
    target_cols: list[str],
    maxlen: int = 100,
    chunk: int = 4096,
) -> DataFrame:
    """For every event i >= 2 of a sender: its previous <= ``maxlen`` events and targets.

    The sliding row frame is evaluated per ``(sender, chunk of seq_no)``; each
    chunk also receives the last ``maxlen`` rows of the chunk before it as
    read-only halo rows, so every frame is complete while no task holds more
    than ``chunk + maxlen`` rows of one sender.  Senders with one event give
    no example.  Output: ``sender_id, seq_no, txn_id, hist (array<struct>),
    hist_len`` + targets.
    """
    seq = F.col("seq_no")
    own = F.floor((seq - 1) / chunk)
    in_halo = ((seq - 1) % chunk) >= (chunk - maxlen)
    tagged = history.select(
        "*",
        F.explode(
            F.when(in_halo, F.array(F.struct(own.alias("c"), F.lit(False).alias("halo")), F.struct((own + 1).alias("c"), F.lit(True).alias("halo"))))
            .otherwise(F.array(F.struct(own.alias("c"), F.lit(False).alias("halo"))))
        ).alias("_ch"),
    )
    w = Window.partitionBy("sender_id", F.col("_ch.c")).orderBy("seq_no").rowsBetween(-maxlen, -1)
    step = F.struct(*[F.col(c) for c in ["seq_no", *feature_cols]])
    out = tagged.withColumn("hist", F.collect_list(step).over(w)).where(~F.col("_ch.halo") & (seq >= 2))
    return out.select("sender_id", "seq_no", "txn_id", *target_cols, "hist", F.size("hist").alias("hist_len"))


def pad_sequences(hist: Column, field: str, maxlen: int, fill: float = 0.0) -> Column:
    """One feature of a history, right-padded with ``fill`` to ``maxlen``."""
    return fx.pad_right(F.transform(hist, lambda s: s[field].cast("double")), maxlen, fill)


# ------------------------------------------------------- store readers


def latest_per_key(df: DataFrame, key: str, keep: str = "last", date_col: str = "snapshot_date") -> DataFrame:
    """One row per key: newest snapshot (``keep='last'``) or oldest (``'first'``)."""
    # an aggregate, so that each task passes on one row per key instead of all embeddings
    pick = F.max_by if keep == "last" else F.min_by
    return df.groupBy(key).agg(pick(F.struct(*df.columns), F.struct(date_col)).alias("_row")).select("_row.*")
