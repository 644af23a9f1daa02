"""Sender x recipient interaction graph, its factorisation, recipient snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.functions.hashing import hash_tokens, profile_tokens
from paylabel.operators.factorise import factorise
from paylabel.session import written


def with_canonical_recipient(txn: DataFrame) -> DataFrame:
    return txn.withColumn("recipient_canon_id", fx.canonical_recipient())


def interaction_edges(txn: DataFrame, lookback_days: int = 10, materialize: bool = True) -> DataFrame:
    """``(snapshot_date, sender_id, recipient_canon_id, weight=log1p(Σ amount))``.

    For every date D and recipient active on D: the amounts each sender paid it
    in ``[D-L, D]``.  Amounts are first summed per (sender, recipient, day).  A day row
    learns by one join on (recipient, day) the dates whose windows count it, and is expanded to
    them only where all rows of its sender and recipient lie, so that the expanded rows
    are summed in place.  Null senders make a recipient active but
    give no edge (as grouping keys they would form a group of their own).
    """
    t = with_canonical_recipient(txn).withColumn("txn_date", fx.txn_date())
    daily = t.groupBy("sender_id", "recipient_canon_id", "txn_date").agg(F.sum(F.col("amount").cast("double")).alias("amt"))
    if materialize:
        # the pre-aggregate feeds both the day rows and the active pairs: write it once
        # (far smaller than the raw rows) instead of scanning the raw table twice
        daily = written(daily, "daily")
    pairs = daily.where(F.col("txn_date").isNotNull()).select("recipient_canon_id", F.col("txn_date").alias("snapshot_date")).distinct()
    day = F.explode(F.sequence(F.date_sub("snapshot_date", lookback_days), F.col("snapshot_date"))).alias("txn_date")
    # at most lookback_days + 1 dates per recipient and day
    counted = pairs.select("recipient_canon_id", "snapshot_date", day).groupBy("recipient_canon_id", "txn_date").agg(F.collect_list("snapshot_date").alias("dates"))
    rows = daily.where(F.col("sender_id").isNotNull()).join(counted, on=["recipient_canon_id", "txn_date"], how="inner")
    expanded = rows.repartition("sender_id", "recipient_canon_id").select("sender_id", "recipient_canon_id", F.explode("dates").alias("snapshot_date"), "amt")
    return expanded.groupBy("snapshot_date", "sender_id", "recipient_canon_id").agg(
        F.log1p(F.coalesce(F.sum("amt"), F.lit(0.0))).alias("weight")
    )


def active_recipients(txn: DataFrame) -> DataFrame:
    """``(recipient_canon_id, snapshot_date)`` of every recipient paid on the date, by whomever."""
    t = with_canonical_recipient(txn).withColumn("snapshot_date", fx.txn_date())
    return t.where(F.col("snapshot_date").isNotNull()).select("recipient_canon_id", "snapshot_date").distinct()


def copay_graph(edges: DataFrame, id_col: str = "recipient_canon_id", group_col: str = "sender_id") -> DataFrame:
    """Per recipient its place in the co-payment graph ``AᵀA`` (senders x recipients ``A``).

    ``self_weight`` is the recipient's diagonal entry and ``strength`` its row sum,
    ``Aᵀ(A·1)``: two sums and a join on the payer.  The matrix itself, one entry per pair of
    recipients, is never formed, and no payer is capped.
    """
    payers = edges.groupBy(group_col).agg(F.sum("weight").alias("_paid"))
    return edges.join(payers, group_col).groupBy(id_col).agg(
        F.sum(F.col("weight") * F.col("weight")).alias("self_weight"), F.sum(F.col("weight") * F.col("_paid")).alias("strength")
    )


# -------------------------------------------------------------- metadata


def recipient_metadata(entity: DataFrame, merchant: DataFrame, person: DataFrame) -> DataFrame:
    """entity ⟕ merchant(mcc) ⟕ person(age, province, occupation), one row per entity.

    Duplicate profile rows are reduced to one value per attribute (``min``) so
    the result stays one row per entity.
    """
    ent = entity.groupBy("recipient_entity_id").agg(F.min("entity_type").alias("entity_type"))
    mer = merchant.groupBy("recipient_entity_id").agg(F.min("mcc").alias("mcc"))
    per = person.groupBy("recipient_entity_id").agg(
        F.min("age_band").alias("age_band"),
        F.min("province_code").alias("province_code"),
        F.min("occupation_band").alias("occupation_band"),
    )
    return ent.join(mer, "recipient_entity_id", "left").join(per, "recipient_entity_id", "left")


def merchant_bridge(merchant: DataFrame, key: str = "recipient_canon_id") -> DataFrame:
    """Canonical ``MER_<merchant_id>`` ids -> the merchant's entity id."""
    return merchant.select(
        F.concat(F.lit("MER_"), F.col("merchant_id")).alias(key), F.col("recipient_entity_id").alias("_entity")
    ).dropDuplicates([key])


def hashed_recipients(
    ids: DataFrame,
    meta: DataFrame,
    hash_dim: int = 32,
    key: str = "recipient_canon_id",
    bridge: DataFrame | None = None,
) -> DataFrame:
    """Signed hashed metadata per recipient id; ids without metadata get ``['none']``.

    By default metadata is looked up with the canonical id itself (reference
    behaviour: ``MER_``/``UNK_`` ids find nothing).  With ``bridge`` (see
    ``merchant_bridge``) merchant-only recipients use their entity's metadata.
    """
    m = meta.withColumnRenamed("recipient_entity_id", "_entity").withColumn("_known", F.lit(True))
    lookup = ids.withColumn("_entity", F.col(key))
    if bridge is not None:
        lookup = ids.join(bridge, key, "left").withColumn("_entity", F.coalesce(F.col("_entity"), F.col(key)))
    j = lookup.join(m, on="_entity", how="left").withColumn("_known", F.coalesce(F.col("_known"), F.lit(False)))
    return j.select(*ids.columns, profile_tokens().alias("tokens")).withColumn("hash_vec", hash_tokens(F.col("tokens"), hash_dim))


# ------------------------------------------------------------------- SVD


def recipient_svd(edges: DataFrame, svd_dim: int = 64) -> DataFrame:
    """``snapshot_date, recipient_canon_id, svd_vec``: right singular vectors times the root of
    their singular values, ``svd_dim`` wide; dates of any size share one job (see ``factorise``)."""
    return factorise(edges, svd_dim).vectors


def singular_values(edges: DataFrame, svd_dim: int = 64) -> DataFrame:
    """``snapshot_date, rank, singular_value``: every date's ``svd_dim`` leading ones (all, if fewer), descending."""
    return factorise(edges, svd_dim).values


def recipient_state(edges: DataFrame, hashed: DataFrame, svd_dim: int = 64, active: DataFrame | None = None) -> DataFrame:
    """``[svd ‖ hash]`` normalised jointly, per active recipient and date.

    ``active`` names recipients that may have no edge (paid by unknown senders only): their
    graph part is zero.
    """
    svd = recipient_svd(edges, svd_dim)
    if active is not None:
        zero = F.array_repeat(F.lit(0.0), svd_dim)
        svd = active.join(svd, ["recipient_canon_id", "snapshot_date"], "left").withColumn("svd_vec", F.coalesce("svd_vec", zero))
    j = svd.join(hashed.select("recipient_canon_id", "hash_vec"), "recipient_canon_id", "inner")
    return j.select(
        "recipient_canon_id",
        "snapshot_date",
        fx.l2_normalize(fx.concat_vectors("svd_vec", "hash_vec")).alias("state"),
    )


def snapshot_stats(df: DataFrame, id_col: str) -> DataFrame:
    """Per date: active ids and the number of window rows feeding them."""
    return df.groupBy("snapshot_date").agg(
        F.countDistinct(id_col).alias("n_active"), F.count(F.lit(1)).alias("n_window_rows")
    )
