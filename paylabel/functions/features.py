"""Column expressions for transaction features (all JVM-side, codegen friendly)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def amount_log(amount: str | Column = "amount") -> Column:
    return F.log1p(col(amount).cast("double"))


def hour_of(ts: str | Column = "txn_time_utc") -> Column:
    return F.hour(col(ts))


def hour_sin(ts: str | Column = "txn_time_utc") -> Column:
    return F.sin(F.lit(2 * math.pi) * hour_of(ts) / F.lit(24.0))


def hour_cos(ts: str | Column = "txn_time_utc") -> Column:
    return F.cos(F.lit(2 * math.pi) * hour_of(ts) / F.lit(24.0))


def txn_date(ts: str | Column = "txn_time_utc") -> Column:
    return F.to_date(col(ts))


def feature_date(date: str | Column, lookback_days: int) -> Column:
    return F.date_sub(col(date), lookback_days)


def seconds_of_day(ts: str | Column = "txn_time_utc") -> Column:
    t = col(ts)
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def fill_unknown(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(UNKNOWN))


def fill_text(c: str | Column) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(""))


def nonblank(c: str | Column) -> Column:
    """Null when empty, else the value (``''`` counts as missing)."""
    return F.nullif(col(c).cast("string"), F.lit(""))


def canonical_recipient(
    entity: str | Column = "recipient_entity_id",
    merchant: str | Column = "merchant_id",
    bank: str | Column = "to_bank_code",
    account: str | Column = "to_account_number_hash",
) -> Column:
    """Entity id, else ``MER_`` + merchant id, else ``UNK_<bank>_<account>``."""
    e, m = nonblank(entity), nonblank(merchant)
    return (
        F.when(e.isNotNull(), e)
        .when(m.isNotNull(), F.concat(F.lit("MER_"), m))
        .otherwise(F.concat(F.lit("UNK_"), fill_text(bank), F.lit("_"), fill_text(account)))
    )


# ---------------------------------------------------------------- vectors


def zeros(n: int) -> Column:
    return F.array_repeat(F.lit(0.0), n)


def fill_missing_embedding(v: str | Column, n: int) -> Column:
    return F.coalesce(col(v), zeros(n))


def concat_vectors(*vs: str | Column) -> Column:
    return F.concat(*[col(v) for v in vs])


def dot_sum(v: str | Column) -> Column:
    return F.aggregate(col(v), F.lit(0.0), lambda a, x: a + x)


def l2_norm(v: str | Column) -> Column:
    return F.sqrt(F.aggregate(col(v), F.lit(0.0), lambda a, x: a + x * x))


def l2_normalize(v: str | Column, eps: float = 1e-9) -> Column:
    """v / max(||v||, eps); the norm is folded once and applied in the finish step."""
    vv = col(v)
    return F.aggregate(
        vv, F.lit(0.0), lambda a, x: a + x * x, lambda ss: F.transform(vv, lambda x: x / F.greatest(F.sqrt(ss), F.lit(eps)))
    )


def checksum(v: str | Column) -> Column:
    """Σ (i+1)·v[i]; an order-sensitive fingerprint used by oracle checks."""
    return F.aggregate(
        F.zip_with(col(v), F.sequence(F.lit(1), F.size(col(v))), lambda x, i: x * i),
        F.lit(0.0),
        lambda a, x: a + x,
    )


def one_hot(c: str | Column, vocab: list[str]) -> Column:
    """Dense 0/1 vector over ``vocab``; unknown values give all zeros."""
    return F.array(*[F.when(col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for v in vocab])


def category_index(c: str | Column, vocab: list[str], unknown: str = "parity") -> Column:
    """1-based position in ``vocab`` (0 is padding).

    ``unknown='parity'`` gives an unseen value index 1, as the reference's
    arg-max over an all-zero one-hot does; ``unknown='own'`` gives it
    ``len(vocab) + 1``.
    """
    pos = F.array_position(F.array(*[F.lit(v) for v in vocab]), col(c)).cast("int")
    fallback = F.lit(1) if unknown == "parity" else F.lit(len(vocab) + 1)
    return F.when(pos > 0, pos).otherwise(fallback)


def standardize(c: str | Column, mean: Column, std: Column) -> Column:
    return (col(c) - mean) / std


def bin_by_edges(x: str | Column, edges: list[Column]) -> Column:
    """Right-closed bins: ``x <= e0 -> 0``, ..., else ``len(edges)``; NaN/null -> last."""
    out = None
    for i, e in enumerate(edges):
        cond = col(x) <= e
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out.otherwise(F.lit(len(edges)))


def _online_max_sum(acc: Column, x: Column) -> Column:
    """One step of the streaming (max, Σexp(x - max)) fold."""
    m = F.greatest(acc["m"], x)
    return F.struct(m.alias("m"), (acc["s"] * F.exp(acc["m"] - m) + F.exp(x - m)).alias("s"))


def _max_sum_init() -> Column:
    return F.struct(F.lit(float("-inf")).alias("m"), F.lit(0.0).alias("s"))


def softmax(logits: str | Column) -> Column:
    """exp(x - max) / Σ exp(x - max) in one fold per row.

    The fold keeps a running max and a rescaled running sum; its finish step
    maps the array, so nothing is re-evaluated per element.
    """
    lg = col(logits)
    return F.aggregate(lg, _max_sum_init(), _online_max_sum, lambda acc: F.transform(lg, lambda x: F.exp(x - acc["m"]) / acc["s"]))


def log_softmax_at(logits: str | Column, idx: str | Column) -> Column:
    """log p[idx] computed stably from logits (log-sum-exp from the same fold)."""
    lg = col(logits)
    return F.aggregate(
        lg, _max_sum_init(), _online_max_sum, lambda acc: F.element_at(lg, col(idx) + 1) - (acc["m"] + F.log(acc["s"]))
    )


def argmax(v: str | Column) -> Column:
    """0-based index of the largest element (first on ties)."""
    return (F.array_position(col(v), F.array_max(col(v))) - 1).cast("int")


def pad_right(v: str | Column, maxlen: int, fill=0.0) -> Column:
    """Right-pad to ``maxlen`` with ``fill`` (a fixed width instead of per-batch)."""
    n = F.greatest(F.lit(maxlen) - F.size(col(v)), F.lit(0))
    return F.concat(col(v), F.array_repeat(F.lit(fill), n))


def round6(c: str | Column) -> Column:
    """Round for cross-engine comparison; ``+ 0.0`` folds ``-0.0`` into ``0.0``."""
    return F.round(col(c), 6) + F.lit(0.0)
