"""Registered queries: one per operator of the survey, each with its oracle.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole input.  Jobs that maintain a feature store write it under the session's
shared checkpoint folder (a fresh sub-folder per call) and read it back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylabel import oracle as O
from paylabel.functions import features as fx
from paylabel.functions import subword
from paylabel.functions.replies import confidence_gate, extract_json_reply
from paylabel.functions.rules import KEYWORD_RULES, apply_rules, type_rule
from paylabel.functions.text import keyword_match, strip_accents
from paylabel.functions.textvec import hashed_word_table, sentence_vector_from_table, tokens
from pyspark.ml.functions import vector_to_array
from paylabel.operators import recurrence
from paylabel.operators.factorise import factorise
from paylabel.operators import cascade as cz
from paylabel.operators import graph, metrics, snapshots
from paylabel.operators.ranking import bucketed_rank, exact_quantiles
from paylabel.plans import context, scoring, stores, training
from paylabel.session import shared_path
from paylabel.sources import fixtures, io

r6 = fx.round6
Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Q) -> Q:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def ds(d: Column | str) -> Column:
    return (F.col(d) if isinstance(d, str) else d).cast("string")


# ------------------------------------------------------------------ shared


def txn(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.transactions(spark, sf)


def feat(spark: SparkSession, sf: str) -> DataFrame:
    t = txn(spark, sf)
    return t.select(
        "*",
        fx.txn_date().alias("txn_date"),
        fx.amount_log().alias("amount_log"),
        fx.hour_of().alias("hr"),
        fx.hour_sin().alias("hour_sin"),
        fx.hour_cos().alias("hour_cos"),
        fx.fill_unknown("tranx_type").alias("tt"),
        fx.fill_unknown("channel").alias("ch"),
        fx.canonical_recipient().alias("recipient_canon_id"),
    )


def vocabs(spark: SparkSession, sf: str) -> tuple[list[str], list[str]]:
    t = txn(spark, sf)
    return snapshots.fit_category_vocab(t, "tranx_type"), snapshots.fit_category_vocab(t, "channel")


def sender_spec(spark: SparkSession, sf: str) -> stores.SenderStoreSpec:
    tt, ch = vocabs(spark, sf)
    return stores.SenderStoreSpec(tt_vocab=tt, ch_vocab=ch)


def sender_states(spark: SparkSession, sf: str) -> DataFrame:
    spec = sender_spec(spark, sf)
    ev = snapshots.event_features(txn(spark, sf), spec.tt_vocab, spec.ch_vocab)
    return snapshots.sender_state(ev, spec.tt_vocab, spec.ch_vocab, spec.lookback_days, spec.half_life_days)


#: Width of the context encoder's output.
EMB_DIM = 128

#: Stores that queries only read: built once per application and input.
_BUILT: dict[tuple[str, str, str], tuple] = {}


def built_sender_store(spark: SparkSession, sf: str, tag: str) -> tuple[str, stores.SenderStoreSpec]:
    key = (spark.sparkContext.applicationId, sf, "x_snd")
    if key not in _BUILT:
        root = shared_path(spark, "stores", tag, "x_snd", unique=True)
        spec = sender_spec(spark, sf)
        stores.build_sender_store(spark, txn(spark, sf), root, spec)
        _BUILT[key] = root, spec
    return _BUILT[key]


def built_recipient_store(spark: SparkSession, sf: str, tag: str) -> tuple[str, stores.RecipientStoreSpec]:
    key = (spark.sparkContext.applicationId, sf, "x_rcv")
    if key not in _BUILT:
        root = shared_path(spark, "stores", tag, "x_rcv", unique=True)
        spec = stores.RecipientStoreSpec()
        stores.build_recipient_store(
            spark,
            txn(spark, sf),
            fixtures.recipient_entity(spark, sf),
            fixtures.merchant_profile(spark, sf),
            fixtures.person_profile(spark, sf),
            root,
            spec,
        )
        _BUILT[key] = root, spec
    return _BUILT[key]


def label_map(spark: SparkSession) -> DataFrame:
    return io.scan_label_map(spark)


def label_codes(spark: SparkSession) -> list[str]:
    # the taxonomy is a fixed 10-row artifact
    return [r.code for r in label_map(spark).orderBy("idx").collect()]


def stub_scored(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows with deterministic linear scores (oracle-reproducible)."""
    f = feat(spark, sf)
    f = training.label_lookup(f.withColumn("label_l1", F.col("category")), label_map(spark)).where(F.col("label_idx") >= 0)
    s = cz.linear_scores(f, [F.col("amount_log") / F.lit(10.0), F.col("hour_sin"), F.col("hour_cos")], 10)
    return s.withColumn("pred", fx.argmax("prob")).withColumn("label", F.col("label_idx"))


def ctx_art(spark: SparkSession, sf: str, text_dim: int = 16) -> context.CtxArtifacts:
    return context.fit_ctx(txn(spark, sf), text_dim=text_dim)


#: Width of the sentence vectors that the models are trained on.
TEXT_DIM = 300


def edges_all_period(spark: SparkSession, sf: str) -> DataFrame:
    f = feat(spark, sf)
    return f.groupBy("sender_id", "recipient_canon_id").agg(F.log1p(F.sum("amount")).alias("weight"))


# ======================================================== 2.1 sources/sinks

_TS = "strftime(txn_time_utc, '%Y-%m-%d %H:%M:%S.%f')"


@register(
    "scan_parquet",
    O.with_("txn")
    + f"""SELECT txn_id, sender_id, {_TS} AS txn_time_utc, amount, currency, tranx_type, channel, category,
       msg_content, recipient_entity_id, recipient_alias_raw, to_account_number_hash, to_bank_code,
       merchant_id, geo_cell_h3_8 FROM txn""",
)
def q_scan_parquet(spark, sf):
    t = txn(spark, sf)
    return t.withColumn("txn_time_utc", F.date_format("txn_time_utc", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@register("scan_by_suffix", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def q_scan_by_suffix(spark, sf):
    return io.scan_by_suffix(spark, f"{sf}/events.parquet").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register(
    "scan_raw_bundle",
    O.with_("txn", "ent", "mer", "per")
    + """SELECT 'transactions' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT txn_id) AS BIGINT) AS n_keys FROM txn
UNION ALL SELECT 'recipient_entity', count(*), count(DISTINCT recipient_entity_id) FROM ent
UNION ALL SELECT 'merchant_profile', count(*), count(DISTINCT merchant_id) FROM mer
UNION ALL SELECT 'person_profile', count(*), count(DISTINCT person_id) FROM per""",
)
def q_scan_raw_bundle(spark, sf):
    b = fixtures.raw_bundle(spark, sf)
    keys = {"transactions": "txn_id", "recipient_entity": "recipient_entity_id", "merchant_profile": "merchant_id", "person_profile": "person_id"}
    out = None
    for name, df in b.items():
        part = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.countDistinct(keys[name]).alias("n_keys"))
        out = part if out is None else out.unionByName(part)
    return out


_ACTIVE_SND = "SELECT DISTINCT sender_id, CAST(txn_time_utc AS DATE) AS d FROM txn"


@register(
    "scan_snapshots",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})", "fd AS (SELECT DISTINCT CAST(txn_time_utc AS DATE) - 1 AS d FROM txn)")
    + "SELECT CAST(fd.d AS VARCHAR) AS feature_date, CAST(count(*) AS BIGINT) AS n_rows FROM ap JOIN fd USING (d) GROUP BY fd.d",
)
def q_scan_snapshots(spark, sf):
    root, _ = built_sender_store(spark, sf, "scan_snapshots")
    wanted = txn(spark, sf).select(F.date_sub(fx.txn_date(), 1).alias("d")).distinct()
    snaps = io.scan_snapshots(spark, root, wanted)
    return snaps.groupBy(ds("_feature_date").alias("feature_date")).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "scan_cumulative",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})") + "SELECT sender_id, CAST(count(*) AS BIGINT) AS n_rows FROM ap GROUP BY sender_id",
)
def q_scan_cumulative(spark, sf):
    root, _ = built_sender_store(spark, sf, "scan_cumulative")
    cum = io.scan_cumulative(spark, root)
    return cum.select(F.col("sender_id").cast("string").alias("sender_id"), "snd_emb").groupBy("sender_id").agg(F.count(F.lit(1)).alias("n_rows"))


@register("scan_display_names", O.with_("ent") + "SELECT recipient_entity_id, primary_display_name FROM ent")
def q_scan_display_names(spark, sf):
    return io.scan_display_names(spark, fixtures.recipient_entity(spark, sf))


@register(
    "sink_daily_snapshot",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})") + "SELECT CAST(d AS VARCHAR) AS date, CAST(count(*) AS BIGINT) AS n_rows FROM ap GROUP BY d",
)
def q_sink_daily_snapshot(spark, sf):
    root, _ = built_sender_store(spark, sf, "sink_daily")
    return spark.read.parquet(io.daily_root(root)).groupBy(ds("date").alias("date")).agg(F.count(F.lit(1)).alias("n_rows"))


def _two_batch_store(spark: SparkSession, sf: str, tag: str, last_day: bool = False) -> tuple[str, DataFrame, str]:
    """Build the first 15 days (or all but the last), then the rest incrementally.  Returns (root, batch2_dates, cut)."""
    t = txn(spark, sf)
    spec = sender_spec(spark, sf)
    at = F.date_sub(F.max(fx.txn_date()), 1) if last_day else F.date_add(F.min(fx.txn_date()), 14)
    cut = t.agg(at.cast("string").alias("c")).first()["c"]
    root = shared_path(spark, "stores", tag, "x_snd", unique=True)
    stores.build_sender_store(spark, t.where(fx.txn_date() <= F.lit(cut).cast("date")), root, spec)
    todo = stores.incremental_dates(spark, t, root)
    return root, todo, cut


_B12 = f"""ap AS ({_ACTIVE_SND}),
cut AS (SELECT min(d) + 14 AS c FROM ap),
b1 AS (SELECT ap.* FROM ap, cut WHERE d <= c),
b2 AS (SELECT ap.* FROM ap, cut WHERE d > c)"""
# the last day alone as second batch: senders that are idle on it keep their stored rows
_B_LAST = _B12.replace("min(d) + 14", "max(d) - 1")


@register("incremental_dates", O.with_("txn", _B12) + "SELECT DISTINCT CAST(d AS VARCHAR) AS snapshot_date FROM b2")
def q_incremental_dates(spark, sf):
    _, todo, _ = _two_batch_store(spark, sf, "incremental")
    return todo.select(ds("snapshot_date").alias("snapshot_date"))


@register("date_difference", O.with_("txn", _B12) + "SELECT DISTINCT CAST(d AS VARCHAR) AS snapshot_date FROM b2")
def q_date_difference(spark, sf):
    root, _, _ = _two_batch_store(spark, sf, "datediff")
    all_dates = stores.transaction_dates(txn(spark, sf)).select(ds("snapshot_date").alias("snapshot_date"))
    have = spark.createDataFrame([(d,) for d in io.stored_dates(spark, root)], "snapshot_date string")
    return all_dates.exceptAll(have)


_UPSERT_SQL = O.with_("txn", _B_LAST) + """SELECT sender_id, CAST(d AS VARCHAR) AS snapshot_date FROM b2
UNION ALL SELECT sender_id, CAST(d AS VARCHAR) FROM b1 WHERE sender_id NOT IN (SELECT sender_id FROM b2)"""


@register("sink_upsert_cumulative", _UPSERT_SQL)
def q_sink_upsert_cumulative(spark, sf):
    root, _, _ = _two_batch_store(spark, sf, "upsert", last_day=True)
    stores.build_sender_store(spark, txn(spark, sf), root, sender_spec(spark, sf))
    return io.scan_cumulative(spark, root).select("sender_id", ds("snapshot_date").alias("snapshot_date"))


@register(
    "upsert_anti",
    O.with_("txn", _B_LAST) + "SELECT sender_id, CAST(d AS VARCHAR) AS snapshot_date FROM b1 WHERE sender_id NOT IN (SELECT sender_id FROM b2)",
)
def q_upsert_anti(spark, sf):
    root, _, cut = _two_batch_store(spark, sf, "anti", last_day=True)
    existing = io.scan_cumulative(spark, root)
    spec = sender_spec(spark, sf)
    ev = snapshots.event_features(txn(spark, sf), spec.tt_vocab, spec.ch_vocab)
    new_keys = snapshots.active_pairs(ev, "sender_id").where(F.col("snapshot_date") > F.lit(cut).cast("date")).select("sender_id")
    kept = existing.join(new_keys.distinct(), "sender_id", "left_anti")
    return kept.select("sender_id", ds("snapshot_date").alias("snapshot_date"))


@register(
    "union_upsert",
    O.with_("txn", _B_LAST)
    + """SELECT part, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'kept' AS part FROM b1 WHERE sender_id NOT IN (SELECT sender_id FROM b2)
  UNION ALL SELECT 'new' FROM b2) x GROUP BY part""",
)
def q_union_upsert(spark, sf):
    root, _, cut = _two_batch_store(spark, sf, "union_upsert", last_day=True)
    stores.build_sender_store(spark, txn(spark, sf), root, sender_spec(spark, sf))
    cum = io.scan_cumulative(spark, root)
    part = F.when(F.col("snapshot_date") > F.lit(cut).cast("date"), "new").otherwise("kept")
    return cum.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))


@register(
    "latest_per_key",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})") + "SELECT sender_id, CAST(max(d) AS VARCHAR) AS snapshot_date FROM ap GROUP BY sender_id",
)
def q_latest_per_key(spark, sf):
    root, _ = built_sender_store(spark, sf, "latest")
    cum = io.scan_cumulative(spark, root)
    return snapshots.latest_per_key(cum, "sender_id").select("sender_id", ds("snapshot_date").alias("snapshot_date"))


# ======================================================= 2.2 projections


@register("amount_log", O.with_("txn", "feat") + f"SELECT txn_id, {O.r6('amount_log')} AS amount_log FROM feat")
def q_amount_log(spark, sf):
    return feat(spark, sf).select("txn_id", r6("amount_log").alias("amount_log"))


@register(
    "hour_cyclic",
    O.with_("txn", "feat") + f"SELECT txn_id, CAST(hr AS INT) AS hour, {O.r6('hour_sin')} AS hour_sin, {O.r6('hour_cos')} AS hour_cos FROM feat",
)
def q_hour_cyclic(spark, sf):
    return feat(spark, sf).select("txn_id", F.col("hr").cast("int").alias("hour"), r6("hour_sin").alias("hour_sin"), r6("hour_cos").alias("hour_cos"))


@register("txn_date", O.with_("txn", "feat") + "SELECT txn_id, CAST(txn_date AS VARCHAR) AS txn_date FROM feat")
def q_txn_date(spark, sf):
    return feat(spark, sf).select("txn_id", ds("txn_date").alias("txn_date"))


@register("feature_date", O.with_("txn", "feat") + "SELECT txn_id, CAST(txn_date - 1 AS VARCHAR) AS feature_date FROM feat")
def q_feature_date(spark, sf):
    return feat(spark, sf).select("txn_id", ds(fx.feature_date("txn_date", 1)).alias("feature_date"))


@register("fill_unknown_category", O.with_("txn", "feat") + "SELECT txn_id, tt AS tranx_type, ch AS channel FROM feat")
def q_fill_unknown_category(spark, sf):
    return txn(spark, sf).select("txn_id", fx.fill_unknown("tranx_type").alias("tranx_type"), fx.fill_unknown("channel").alias("channel"))


@register("fill_text", O.with_("txn") + "SELECT txn_id, coalesce(CAST(msg_content AS VARCHAR), '') AS msg_content FROM txn")
def q_fill_text(spark, sf):
    return txn(spark, sf).select("txn_id", fx.fill_text("msg_content").alias("msg_content"))


@register("canonical_recipient", O.with_("txn", "feat") + "SELECT txn_id, recipient_canon_id FROM feat")
def q_canonical_recipient(spark, sf):
    return txn(spark, sf).select("txn_id", fx.canonical_recipient().alias("recipient_canon_id"))


@register(
    "lookback_filter",
    O.with_("txn", "feat")
    + "SELECT txn_id, CAST(txn_date AS VARCHAR) AS txn_date FROM feat WHERE txn_date BETWEEN (SELECT max(txn_date) FROM feat) - 10 AND (SELECT max(txn_date) FROM feat)",
)
def q_lookback_filter(spark, sf):
    f = feat(spark, sf)
    d = f.agg(F.max("txn_date")).scalar()
    return f.where(F.col("txn_date").between(F.date_sub(d, 10), d)).select("txn_id", ds("txn_date").alias("txn_date"))


@register(
    "mode_projection",
    O.with_("txn") + "SELECT txn_id, CAST(CAST(txn_time_utc AS DATE) AS VARCHAR) AS txn_date, sender_id, recipient_entity_id, category AS label_l1 FROM txn",
)
def q_mode_projection(spark, sf):
    art = ctx_art(spark, sf)
    c = context.build_ctx(txn(spark, sf), art, mode="train")
    return c.select("txn_id", ds("txn_date").alias("txn_date"), "sender_id", "recipient_entity_id", "label_l1")


_CTX_NUM_SQL = O.with_("txn", "feat", O.VOCAB, O.SCALED, O.CTXLONG)


@register(
    "select_prefix",
    _CTX_NUM_SQL
    + f"""SELECT txn_id, CAST(4 + (SELECT nt + nc FROM nv) - 1 AS INT) AS n_cols, {O.r6('sum((dim + 1) * v)')} AS checksum
FROM ctxl GROUP BY txn_id""",
)
def q_select_prefix(spark, sf):
    art = ctx_art(spark, sf)
    f = context.numeric_features(txn(spark, sf))
    scaled = F.array(*[(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(context.NUMERIC, art.means, art.stds)])
    v = fx.concat_vectors(scaled, fx.one_hot(fx.fill_unknown("tranx_type"), art.tt_vocab), fx.one_hot(fx.fill_unknown("channel"), art.ch_vocab))
    n = 3 + len(art.tt_vocab) + len(art.ch_vocab)
    wide = f.select("txn_id", *[F.element_at(v, i + 1).alias(f"ctx_emb_{i + 1}") for i in range(n)], F.lit(1).alias("other"))
    picked = [c for c in wide.columns if c.startswith("ctx_emb_")]
    back = F.array(*[F.col(c) for c in picked])
    return wide.select("txn_id", F.lit(len(picked)).alias("n_cols"), r6(fx.checksum(back)).alias("checksum"))


_RCV_ACTIVE = "SELECT DISTINCT recipient_canon_id, txn_date AS d FROM feat"


@register(
    "rename_key",
    O.with_("txn", "feat", f"ra AS ({_RCV_ACTIVE})") + "SELECT recipient_canon_id AS recipient_entity_id, CAST(d AS VARCHAR) AS snapshot_date FROM ra",
)
def q_rename_key(spark, sf):
    root, _ = built_recipient_store(spark, sf, "rename")
    r = spark.read.parquet(io.daily_root(root)).withColumnRenamed("recipient_canon_id", "recipient_entity_id")
    return r.select("recipient_entity_id", ds("snapshot_date").alias("snapshot_date"))


@register(
    "snapshot_metadata",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})") + "SELECT sender_id, CAST(d AS VARCHAR) AS snapshot_date, 'v1' AS feature_version FROM ap",
)
def q_snapshot_metadata(spark, sf):
    root, _ = built_sender_store(spark, sf, "meta")
    return spark.read.parquet(io.daily_root(root)).select("sender_id", ds("snapshot_date").alias("snapshot_date"), "feature_version")


@register(
    "valid_label_filter",
    O.with_("txn", "lm") + "SELECT t.txn_id, lm.idx AS label_idx FROM txn t JOIN lm ON t.category = lm.code",
)
def q_valid_label_filter(spark, sf):
    t = training.label_lookup(txn(spark, sf).withColumn("label_l1", F.col("category")), label_map(spark))
    return t.where(F.col("label_idx") >= 0).select("txn_id", "label_idx")


@register(
    "validate_requests",
    O.with_("txn")
    + """SELECT txn_id,
       CASE WHEN coalesce(trim(msg_content), '') = '' THEN 'message must not be empty'
            WHEN amount IS NULL OR amount <= 0 THEN 'amount must be greater than 0'
            WHEN recipient_entity_id IS NULL THEN 'recipient_entity_id is required' END AS reject_reason,
       NOT (coalesce(trim(msg_content), '') = '' OR amount IS NULL OR amount <= 0 OR recipient_entity_id IS NULL) AS is_valid
FROM txn""",
)
def q_validate_requests(spark, sf):
    return cz.validate_requests(cz.requests_from_transactions(txn(spark, sf))).select("txn_id", "reject_reason", "is_valid")


@register(
    "fill_request_defaults",
    O.with_("txn", "feat")
    + """SELECT txn_id, sender_id, coalesce(nullif(recipient_entity_id, ''), (SELECT min(recipient_canon_id) FROM feat)) AS recipient_entity_id,
       coalesce(nullif(tranx_type, ''), 'transfer_in') AS model_tranx_type, 'MOBILE' AS model_channel FROM txn""",
)
def q_fill_request_defaults(spark, sf):
    sroot, _ = built_sender_store(spark, sf, "defaults")
    rroot, _ = built_recipient_store(spark, sf, "defaults")
    d_snd = io.scan_cumulative(spark, sroot).agg(F.min("sender_id")).scalar()
    d_rcv = io.scan_cumulative(spark, rroot).agg(F.min("recipient_canon_id")).scalar()
    req = cz.fill_request_defaults(cz.requests_from_transactions(txn(spark, sf)), d_snd, d_rcv)
    return req.select("txn_id", "sender_id", "recipient_entity_id", "model_tranx_type", "model_channel")


@register(
    "first_occurrence_active",
    O.with_("txn", f"ap AS ({_ACTIVE_SND})") + "SELECT sender_id, CAST(d AS VARCHAR) AS snapshot_date FROM ap",
)
def q_first_occurrence_active(spark, sf):
    return snapshots.active_pairs(feat(spark, sf), "sender_id").select("sender_id", ds("snapshot_date").alias("snapshot_date"))


# ============================================================== 2.3 joins


@register(
    "semi_active",
    O.with_("txn", "feat", "mx AS (SELECT max(txn_date) AS d FROM feat)")
    + """SELECT txn_id FROM feat, mx WHERE txn_date BETWEEN mx.d - 10 AND mx.d
AND sender_id IN (SELECT sender_id FROM feat, mx WHERE txn_date = mx.d)""",
)
def q_semi_active(spark, sf):
    f = feat(spark, sf)
    d = f.agg(F.max("txn_date")).scalar()
    return snapshots.semi_active(f, "sender_id", d, 10).select("txn_id")


@register(
    "snapshot_expand",
    O.with_("txn", "feat", "ap AS (SELECT DISTINCT sender_id, txn_date AS d FROM feat)")
    + """SELECT ap.sender_id, CAST(ap.d AS VARCHAR) AS snapshot_date, f.txn_id FROM ap
JOIN feat f ON f.sender_id = ap.sender_id AND f.txn_date BETWEEN ap.d - 10 AND ap.d""",
)
def q_snapshot_expand(spark, sf):
    x = snapshots.snapshot_expand(feat(spark, sf), "sender_id", 10)
    return x.select("sender_id", ds("snapshot_date").alias("snapshot_date"), "txn_id")


_PIT_SND_SQL = O.with_("txn", "feat", O.VOCAB, O.SND) + f"""SELECT f.txn_id, CAST(f.txn_date - 1 AS VARCHAR) AS feature_date,
       k.ck IS NOT NULL AS has_snd_emb, {O.r6('coalesce(k.ck, 0.0)')} AS snd_checksum
FROM feat f LEFT JOIN sndck k ON k.sender_id = f.sender_id AND k.snapshot_date = f.txn_date - 1"""


def _pit_sender(spark: SparkSession, sf: str) -> DataFrame:
    root, spec = built_sender_store(spark, sf, "pit")
    base = feat(spark, sf).withColumn("_feature_date", fx.feature_date("txn_date", 1))
    wanted = base.select("_feature_date").distinct()
    snaps = io.scan_snapshots(spark, root, wanted)
    return training.pit_join(base, snaps, "sender_id", "snd_emb", spec.dim)


@register("pit_join_sender", _PIT_SND_SQL)
def q_pit_join_sender(spark, sf):
    j = _pit_sender(spark, sf)
    return j.select("txn_id", ds("_feature_date").alias("feature_date"), "has_snd_emb", r6(fx.checksum("snd_emb")).alias("snd_checksum"))


@register(
    "fill_missing_embedding",
    O.with_("txn", "feat", O.VOCAB, O.SND)
    + f"""SELECT f.txn_id, k.ck IS NULL AS was_missing, CAST(4 + (SELECT nt + nc FROM nv) AS INT) AS snd_dim,
       {O.r6('coalesce(k.ck, 0.0)')} AS snd_checksum
FROM feat f LEFT JOIN sndck k ON k.sender_id = f.sender_id AND k.snapshot_date = f.txn_date - 1""",
)
def q_fill_missing_embedding(spark, sf):
    j = _pit_sender(spark, sf)
    return j.select("txn_id", (~F.col("has_snd_emb")).alias("was_missing"), F.size("snd_emb").alias("snd_dim"), r6(fx.checksum("snd_emb")).alias("snd_checksum"))


@register(
    "pit_join_recipient",
    O.with_("txn", "feat", f"ra AS ({_RCV_ACTIVE})")
    + """SELECT f.txn_id, CAST(f.txn_date - 1 AS VARCHAR) AS feature_date, ra.d IS NOT NULL AS has_rcv_emb
FROM feat f LEFT JOIN ra ON ra.recipient_canon_id = f.recipient_entity_id AND ra.d = f.txn_date - 1""",
)
def q_pit_join_recipient(spark, sf):
    root, spec = built_recipient_store(spark, sf, "pit_rcv")
    base = feat(spark, sf).withColumn("_feature_date", fx.feature_date("txn_date", 1))
    snaps = io.scan_snapshots(spark, root, base.select("_feature_date").distinct())
    j = training.pit_join(base, snaps, "recipient_entity_id", "rcv_emb", spec.dim, snap_key="recipient_canon_id")
    return j.select("txn_id", ds("_feature_date").alias("feature_date"), "has_rcv_emb")


_META_SQL = """meta AS (
  SELECT e.recipient_entity_id, e.entity_type, m.mcc, p.age_band, p.province_code, p.occupation_band
  FROM (SELECT recipient_entity_id, min(entity_type) AS entity_type FROM ent GROUP BY 1) e
  LEFT JOIN (SELECT recipient_entity_id, min(mcc) AS mcc FROM mer GROUP BY 1) m USING (recipient_entity_id)
  LEFT JOIN (SELECT recipient_entity_id, min(age_band) AS age_band, min(province_code) AS province_code,
                    min(occupation_band) AS occupation_band FROM per GROUP BY 1) p USING (recipient_entity_id))"""


@register("recipient_metadata", O.with_("ent", "mer", "per", _META_SQL) + "SELECT * FROM meta")
def q_recipient_metadata(spark, sf):
    return graph.recipient_metadata(
        fixtures.recipient_entity(spark, sf), fixtures.merchant_profile(spark, sf), fixtures.person_profile(spark, sf)
    ).select("recipient_entity_id", "entity_type", "mcc", "age_band", "province_code", "occupation_band")


@register(
    "label_lookup",
    O.with_("txn", "lm") + "SELECT t.txn_id, t.category AS label_l1, coalesce(lm.idx, -1) AS label_idx FROM txn t LEFT JOIN lm ON t.category = lm.code",
)
def q_label_lookup(spark, sf):
    t = training.label_lookup(txn(spark, sf).withColumn("label_l1", F.col("category")), label_map(spark))
    return t.select("txn_id", "label_l1", "label_idx")


@register(
    "label_decode",
    O.with_("txn", "feat", "lm", O.STUB)
    + "SELECT am.txn_id, am.pred AS pred_idx, coalesce(lm.code, 'unknown') AS pred_code FROM am LEFT JOIN lm ON lm.idx = am.pred",
)
def q_label_decode(spark, sf):
    f = cz.linear_scores(feat(spark, sf), [F.col("amount_log") / F.lit(10.0), F.col("hour_sin"), F.col("hour_cos")], 10)
    p = f.select("txn_id", fx.argmax("prob").alias("pred_idx"))
    lm = F.broadcast(label_map(spark).select(F.col("idx").alias("pred_idx"), F.col("code").alias("pred_code")))
    return p.join(lm, "pred_idx", "left").select("txn_id", "pred_idx", F.coalesce("pred_code", F.lit("unknown")).alias("pred_code"))


@register(
    "name_lookup",
    O.with_("txn", "feat", "ent")
    + """SELECT r.recipient_canon_id AS code, coalesce(e.primary_display_name, r.recipient_canon_id) AS display_name
FROM (SELECT DISTINCT recipient_canon_id FROM feat) r LEFT JOIN ent e ON e.recipient_entity_id = r.recipient_canon_id""",
)
def q_name_lookup(spark, sf):
    root, _ = built_recipient_store(spark, sf, "names")
    ids = io.scan_cumulative(spark, root).select(F.col("recipient_canon_id").alias("code")).distinct()
    names = io.scan_display_names(spark, fixtures.recipient_entity(spark, sf)).withColumnRenamed("recipient_entity_id", "code")
    return ids.join(names, "code", "left").select("code", F.coalesce("primary_display_name", "code").alias("display_name"))


@register(
    "embedding_lookup",
    O.with_("txn", "feat")
    + """SELECT t.txn_id, s.sender_id IS NOT NULL AS snd_found, r.recipient_canon_id IS NOT NULL AS rcv_found,
       CASE WHEN s.sender_id IS NOT NULL AND r.recipient_canon_id IS NOT NULL THEN 'success' ELSE 'fail' END AS status
FROM txn t
LEFT JOIN (SELECT DISTINCT sender_id FROM feat) s ON s.sender_id = t.sender_id
LEFT JOIN (SELECT DISTINCT recipient_canon_id FROM feat) r ON r.recipient_canon_id = t.recipient_entity_id""",
)
def q_embedding_lookup(spark, sf):
    sroot, _ = built_sender_store(spark, sf, "emb_lookup")
    rroot, _ = built_recipient_store(spark, sf, "emb_lookup")
    s = snapshots.latest_per_key(io.scan_cumulative(spark, sroot), "sender_id").select("sender_id", F.lit(True).alias("snd_found"))
    r = snapshots.latest_per_key(io.scan_cumulative(spark, rroot), "recipient_canon_id").select(
        F.col("recipient_canon_id").alias("recipient_entity_id"), F.lit(True).alias("rcv_found")
    )
    req = cz.requests_from_transactions(txn(spark, sf))
    j = req.join(s, "sender_id", "left").join(r, "recipient_entity_id", "left")
    sf_, rf_ = F.coalesce("snd_found", F.lit(False)), F.coalesce("rcv_found", F.lit(False))
    return j.select("txn_id", sf_.alias("snd_found"), rf_.alias("rcv_found"), F.when(sf_ & rf_, "success").otherwise("fail").alias("status"))


@register(
    "star_enrich",
    O.with_("txn", "cust", "ent", "mer", "per", "alias")
    + """SELECT t.txn_id, c.kyc_tier, c.segment, e.entity_type, m.mcc, p.age_band AS person_age_band,
       CAST(coalesce(a.n_aliases, 0) AS BIGINT) AS n_aliases
FROM txn t
LEFT JOIN cust c ON c.sender_id = t.sender_id
LEFT JOIN ent e ON e.recipient_entity_id = t.recipient_entity_id
LEFT JOIN mer m ON m.merchant_id = t.merchant_id
LEFT JOIN per p ON p.recipient_entity_id = e.recipient_entity_id
LEFT JOIN (SELECT recipient_entity_id, count(*) AS n_aliases FROM alias GROUP BY 1) a ON a.recipient_entity_id = e.recipient_entity_id""",
)
def q_star_enrich(spark, sf):
    t = txn(spark, sf)
    cust = fixtures.customer_profile(spark, sf).select("sender_id", "kyc_tier", "segment")
    ent = fixtures.recipient_entity(spark, sf).select("recipient_entity_id", "entity_type")
    mer = fixtures.merchant_profile(spark, sf).select("merchant_id", "mcc")
    per = fixtures.person_profile(spark, sf).select("recipient_entity_id", F.col("age_band").alias("person_age_band"))
    ali = fixtures.recipient_alias(spark, sf).groupBy("recipient_entity_id").agg(F.count(F.lit(1)).alias("n_aliases"))
    j = (
        t.join(cust, "sender_id", "left")
        .join(ent, "recipient_entity_id", "left")
        .join(mer, "merchant_id", "left")
        .join(per, "recipient_entity_id", "left")
        .join(ali, "recipient_entity_id", "left")
    )
    return j.select(
        "txn_id", "kyc_tier", "segment", "entity_type", "mcc", "person_age_band",
        F.when(F.col("entity_type").isNotNull(), F.coalesce("n_aliases", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_aliases"),
    )


# ======================================================= 2.4 aggregations


@register(
    "interaction_edges",
    O.with_("txn", "feat", f"ra AS ({_RCV_ACTIVE})")
    + f"""SELECT CAST(ra.d AS VARCHAR) AS snapshot_date, f.sender_id, f.recipient_canon_id, {O.r6('ln(1 + sum(f.amount))')} AS weight
FROM ra JOIN feat f ON f.recipient_canon_id = ra.recipient_canon_id AND f.txn_date BETWEEN ra.d - 10 AND ra.d
WHERE f.sender_id IS NOT NULL GROUP BY ra.d, f.sender_id, f.recipient_canon_id""",
)
def q_interaction_edges(spark, sf):
    e = graph.interaction_edges(txn(spark, sf), 10)
    return e.select(ds("snapshot_date").alias("snapshot_date"), "sender_id", "recipient_canon_id", r6("weight").alias("weight"))


@register(
    "distinct_ids",
    O.with_("txn", "feat")
    + """SELECT 'senders' AS kind, CAST(count(DISTINCT sender_id) AS BIGINT) AS n FROM feat
UNION ALL SELECT 'recipients', count(DISTINCT recipient_canon_id) FROM feat
UNION ALL SELECT 'dates', count(DISTINCT txn_date) FROM feat""",
)
def q_distinct_ids(spark, sf):
    f = feat(spark, sf)
    parts = [
        f.select("sender_id").distinct().agg(F.lit("senders").alias("kind"), F.count(F.lit(1)).alias("n")),
        f.select("recipient_canon_id").distinct().agg(F.lit("recipients").alias("kind"), F.count(F.lit(1)).alias("n")),
        f.select("txn_date").distinct().agg(F.lit("dates").alias("kind"), F.count(F.lit(1)).alias("n")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "dedup_rows",
    O.with_("ent", "mer", "per")
    + """SELECT 'entity' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM (SELECT DISTINCT recipient_entity_id, entity_type FROM ent) x
UNION ALL SELECT 'merchant', count(*) FROM (SELECT DISTINCT recipient_entity_id, mcc FROM mer) x
UNION ALL SELECT 'person', count(*) FROM (SELECT DISTINCT recipient_entity_id, age_band, province_code, occupation_band FROM per) x""",
)
def q_dedup_rows(spark, sf):
    parts = [
        ("entity", fixtures.recipient_entity(spark, sf).select("recipient_entity_id", "entity_type")),
        ("merchant", fixtures.merchant_profile(spark, sf).select("recipient_entity_id", "mcc")),
        ("person", fixtures.person_profile(spark, sf).select("recipient_entity_id", "age_band", "province_code", "occupation_band")),
    ]
    out = None
    for name, df in parts:
        p = df.dropDuplicates().agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        out = p if out is None else out.unionByName(p)
    return out


@register(
    "date_range_stats",
    O.with_("txn", "feat")
    + """SELECT CAST(min(txn_date) AS VARCHAR) AS min_txn_date, CAST(max(txn_date) AS VARCHAR) AS max_txn_date,
       CAST(min(txn_date) - 1 AS VARCHAR) AS min_feature_date, CAST(max(txn_date) - 1 AS VARCHAR) AS max_feature_date,
       CAST(count(*) AS BIGINT) AS n_rows FROM feat""",
)
def q_date_range_stats(spark, sf):
    f = feat(spark, sf).withColumn("fd", fx.feature_date("txn_date", 1))
    return f.agg(
        ds(F.min("txn_date")).alias("min_txn_date"),
        ds(F.max("txn_date")).alias("max_txn_date"),
        ds(F.min("fd")).alias("min_feature_date"),
        ds(F.max("fd")).alias("max_feature_date"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@register(
    "label_distribution",
    O.with_("txn", "lm")
    + f"""SELECT t.category AS code, lm.name, CAST(count(*) AS BIGINT) AS n,
       {O.r6('100.0 * count(*) / (SELECT count(*) FROM txn)')} AS pct
FROM txn t LEFT JOIN lm ON lm.code = t.category GROUP BY t.category, lm.name""",
)
def q_label_distribution(spark, sf):
    t = txn(spark, sf)
    total = t.agg(F.count(F.lit(1))).scalar()
    counts = t.groupBy(F.col("category").alias("code")).agg(F.count(F.lit(1)).alias("n"))
    names = F.broadcast(label_map(spark).select("code", "name"))
    return counts.join(names, "code", "left").select("code", "name", "n", r6(F.lit(100.0) * F.col("n") / total).alias("pct"))


@register(
    "dataset_profile",
    O.with_("txn", "ent", "mer", "per", "cust", "alias")
    + """SELECT 'transactions' AS item, CAST(count(*) AS BIGINT) AS n FROM txn
UNION ALL SELECT 'customer_profile', count(*) FROM cust
UNION ALL SELECT 'recipient_entity', count(*) FROM ent
UNION ALL SELECT 'recipient_alias', count(*) FROM alias
UNION ALL SELECT 'merchant_profile', count(*) FROM mer
UNION ALL SELECT 'person_profile', count(*) FROM per
UNION ALL SELECT 'entity_type=' || entity_type, count(*) FROM ent GROUP BY entity_type
UNION ALL SELECT 'distinct_categories', count(DISTINCT category) FROM txn""",
)
def q_dataset_profile(spark, sf):
    tables = {
        "transactions": txn(spark, sf),
        "customer_profile": fixtures.customer_profile(spark, sf),
        "recipient_entity": fixtures.recipient_entity(spark, sf),
        "recipient_alias": fixtures.recipient_alias(spark, sf),
        "merchant_profile": fixtures.merchant_profile(spark, sf),
        "person_profile": fixtures.person_profile(spark, sf),
    }
    out = None
    for name, df in tables.items():
        p = df.agg(F.lit(name).alias("item"), F.count(F.lit(1)).alias("n"))
        out = p if out is None else out.unionByName(p)
    et = fixtures.recipient_entity(spark, sf).groupBy(F.concat(F.lit("entity_type="), F.col("entity_type")).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    cats = txn(spark, sf).agg(F.lit("distinct_categories").alias("item"), F.countDistinct("category").alias("n"))
    return out.unionByName(et).unionByName(cats)


@register(
    "label_validity_counts",
    O.with_("txn", "lm")
    + """SELECT CAST((SELECT count(*) FROM lm) AS BIGINT) AS n_classes,
       CAST(count(lm.idx) AS BIGINT) AS n_valid, CAST(count(*) - count(lm.idx) AS BIGINT) AS n_unknown
FROM txn t LEFT JOIN lm ON lm.code = t.category""",
)
def q_label_validity_counts(spark, sf):
    lm = label_map(spark)
    t = training.label_lookup(txn(spark, sf).withColumn("label_l1", F.col("category")), lm)
    return t.agg(
        lm.agg(F.count(F.lit(1))).scalar().alias("n_classes"),
        F.count_if(F.col("label_idx") >= 0).alias("n_valid"),
        F.count_if(F.col("label_idx") < 0).alias("n_unknown"),
    )


@register(
    "snapshot_stats",
    O.with_("txn", "feat", "ap AS (SELECT DISTINCT sender_id AS id, txn_date AS d FROM feat)", f"ra AS ({_RCV_ACTIVE})")
    + """SELECT 'sender' AS kind, CAST(ap.d AS VARCHAR) AS snapshot_date, CAST(count(DISTINCT ap.id) AS BIGINT) AS n_active,
       CAST(count(*) AS BIGINT) AS n_window_rows
FROM ap JOIN feat f ON f.sender_id = ap.id AND f.txn_date BETWEEN ap.d - 10 AND ap.d GROUP BY ap.d
UNION ALL
SELECT 'recipient', CAST(ra.d AS VARCHAR), count(DISTINCT ra.recipient_canon_id), count(*)
FROM ra JOIN feat f ON f.recipient_canon_id = ra.recipient_canon_id AND f.txn_date BETWEEN ra.d - 10 AND ra.d GROUP BY ra.d""",
)
def q_snapshot_stats(spark, sf):
    f = feat(spark, sf)
    s = graph.snapshot_stats(snapshots.snapshot_expand(f, "sender_id", 10), "sender_id").withColumn("kind", F.lit("sender"))
    r = graph.snapshot_stats(snapshots.snapshot_expand(f, "recipient_canon_id", 10), "recipient_canon_id").withColumn("kind", F.lit("recipient"))
    return s.unionByName(r).select("kind", ds("snapshot_date").alias("snapshot_date"), "n_active", "n_window_rows")


_QS = [0.2, 0.4, 0.6, 0.8]


@register(
    "amount_quantiles",
    O.with_("txn", "feat")
    + " UNION ALL ".join(
        f"SELECT CAST({i} AS INT) AS q_idx, {q} AS q, {O.r6(f'quantile_cont(amount_log, {q})')} AS value FROM feat"
        for i, q in enumerate([0.2, 0.4, 0.6, 0.8])
    ),
)
def q_amount_quantiles(spark, sf):
    q = exact_quantiles(feat(spark, sf), "amount_log", _QS)
    return q.select("q_idx", "q", r6("value").alias("value"))


@register(
    "fit_scaler",
    O.with_("txn", "feat", O.VOCAB, O.SCALED)
    + f"""SELECT 'amount_log' AS feature, {O.r6('m0')} AS mean, {O.r6('s0')} AS std FROM st
UNION ALL SELECT 'hour_sin', {O.r6('m1')}, {O.r6('s1')} FROM st
UNION ALL SELECT 'hour_cos', {O.r6('m2')}, {O.r6('s2')} FROM st""",
)
def q_fit_scaler(spark, sf):
    st = context.scaler_stats(txn(spark, sf))
    parts = [st.select(F.lit(c).alias("feature"), r6(f"{c}_mean").alias("mean"), r6(f"{c}_std").alias("std")) for c in context.NUMERIC]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@register(
    "fit_category_index",
    O.with_("txn", "feat", O.VOCAB)
    + "SELECT 'tranx_type' AS \"column\", tt AS value, tt_r AS idx FROM vt UNION ALL SELECT 'channel', ch, ch_r FROM vc",
)
def q_fit_category_index(spark, sf):
    return snapshots.category_index_table(txn(spark, sf), ["tranx_type", "channel"])


@register(
    "copay_graph",
    O.with_("txn", "feat", "e AS (SELECT sender_id, recipient_canon_id, ln(1 + sum(amount)) AS w FROM feat GROUP BY ALL)")
    + f"""SELECT a.recipient_canon_id, {O.r6('sum(CASE WHEN a.recipient_canon_id = b.recipient_canon_id THEN a.w * b.w END)')} AS self_weight,
       {O.r6('sum(a.w * b.w)')} AS strength
FROM e a JOIN e b ON a.sender_id = b.sender_id GROUP BY ALL""",
)
def q_copay_graph(spark, sf):
    g = graph.copay_graph(edges_all_period(spark, sf))
    return g.select("recipient_canon_id", r6("self_weight").alias("self_weight"), r6("strength").alias("strength"))


# ================================================== 2.5 windows / sequences


@register(
    "sender_history",
    O.with_("txn")
    + "SELECT sender_id, row_number() OVER (PARTITION BY sender_id ORDER BY txn_time_utc, txn_id) AS seq_no, txn_id FROM txn",
)
def q_sender_history(spark, sf):
    return snapshots.sender_history(txn(spark, sf)).select("sender_id", "seq_no", "txn_id")


_EX_SQL = O.with_("txn", "feat", O.VOCAB) + f""",
qs AS (SELECT quantile_cont(amount_log, [0.2, 0.4, 0.6, 0.8]) AS q FROM feat),
h AS (SELECT fv.*, row_number() OVER (PARTITION BY sender_id ORDER BY txn_time_utc, txn_id) AS seq_no,
             CASE WHEN amount_log <= q[1] THEN 0 WHEN amount_log <= q[2] THEN 1 WHEN amount_log <= q[3] THEN 2
                  WHEN amount_log <= q[4] THEN 3 ELSE 4 END AS amt_bin FROM fv, qs),
w AS (SELECT h.*, count(*) OVER (PARTITION BY sender_id ORDER BY seq_no ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS hist_len,
             sum(amount_log) OVER (PARTITION BY sender_id ORDER BY seq_no ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING) AS hs
      FROM h)
"""


def _examples(spark: SparkSession, sf: str, maxlen: int = 100) -> DataFrame:
    spec = sender_spec(spark, sf)
    ev = snapshots.event_features(txn(spark, sf), spec.tt_vocab, spec.ch_vocab)
    q = exact_quantiles(ev, "amount_log", _QS)
    edges = [q.where(F.col("q_idx") == i).select("value").scalar() for i in range(4)]
    ev = ev.withColumn("amt_bin", fx.bin_by_edges("amount_log", edges))
    hist = snapshots.sender_history(ev)
    return snapshots.next_event_examples(
        hist, ["amount_log", "hour_sin", "hour_cos", "tt_idx", "ch_idx"], ["tt_idx", "amt_bin"], maxlen=maxlen
    )


@register(
    "next_event_examples",
    _EX_SQL.replace("WITH ", "WITH ", 1)
    + f"""SELECT sender_id, seq_no, txn_id, tt_r AS target_tt_idx, amt_bin AS target_amt_bin, hist_len,
       {O.r6('hs')} AS hist_amount_sum FROM w WHERE seq_no >= 2""",
)
def q_next_event_examples(spark, sf):
    ex = _examples(spark, sf)
    return ex.select(
        "sender_id",
        "seq_no",
        "txn_id",
        F.col("tt_idx").alias("target_tt_idx"),
        F.col("amt_bin").alias("target_amt_bin"),
        F.col("hist_len").cast("long").alias("hist_len"),
        r6(F.aggregate(F.col("hist"), F.lit(0.0), lambda a, s: a + s["amount_log"])).alias("hist_amount_sum"),
    )


@register(
    "pad_sequences",
    _EX_SQL + f"""SELECT txn_id, 100 AS padded_len, hist_len, {O.r6('hs')} AS padded_sum FROM w WHERE seq_no >= 2""",
)
def q_pad_sequences(spark, sf):
    ex = _examples(spark, sf)
    padded = snapshots.pad_sequences(F.col("hist"), "amount_log", 100)
    return ex.select(
        "txn_id",
        F.size(padded).alias("padded_len"),
        F.col("hist_len").cast("long").alias("hist_len"),
        r6(fx.dot_sum(padded)).alias("padded_sum"),
    )


@register(
    "sender_snapshot",
    O.with_("txn", "feat", O.VOCAB, O.SND)
    + f"SELECT sender_id, CAST(snapshot_date AS VARCHAR) AS snapshot_date, dim, {O.r6('value')} AS value FROM snd",
)
def q_sender_snapshot(spark, sf):
    s = sender_states(spark, sf)
    return s.select("sender_id", ds("snapshot_date").alias("snapshot_date"), F.posexplode("state").alias("dim", "value")).select(
        "sender_id", "snapshot_date", "dim", r6("value").alias("value")
    )


@register(
    "sender_state",
    O.with_("txn", "feat", O.VOCAB, O.SND)
    + f"""SELECT k.sender_id, CAST(k.snapshot_date AS VARCHAR) AS snapshot_date, CAST(n.n_window_txns AS BIGINT) AS n_window_txns,
       {O.r6('k.ck')} AS checksum FROM sndck k JOIN sndn n USING (sender_id, snapshot_date)""",
)
def q_sender_state(spark, sf):
    s = sender_states(spark, sf)
    return s.select("sender_id", ds("snapshot_date").alias("snapshot_date"), "n_window_txns", r6(fx.checksum("state")).alias("checksum"))


def _gate_sql(weights, biases=None):
    lines = [" + ".join(f"({w!r}) * {c}" for w, c in zip(row, ("e.amount_log", "e.hour_sin", "e.hour_cos"))) for row in weights]
    return [f"1.0 / (1.0 + exp(-({b!r} + {x})))" for x, b in zip(lines, biases)] if biases else lines


@register(
    "sender_gated_state",
    O.with_("txn", "feat", "ap AS (SELECT DISTINCT sender_id, txn_date AS d FROM feat WHERE sender_id IS NOT NULL)")
    + ", "
    + "gz AS (SELECT ap.sender_id, ap.d, e.txn_time_utc AS t, e.txn_id, "
    + ", ".join(f"{z} AS z{i}" for i, z in enumerate(_gate_sql(recurrence.GATE_WEIGHTS, recurrence.GATE_BIASES)))
    + ", "
    + ", ".join(f"{v} AS v{i}" for i, v in enumerate(_gate_sql(recurrence.VALUE_WEIGHTS)))
    + """ FROM ap JOIN feat e ON e.sender_id = ap.sender_id AND e.txn_date BETWEEN ap.d - 10 AND ap.d),
gl AS (SELECT *, """
    + ", ".join(f"coalesce(sum(ln(1 - z{i})) OVER later, 0) AS s{i}" for i in range(4))
    + """ FROM gz WINDOW later AS (PARTITION BY sender_id, d ORDER BY t, txn_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT sender_id, CAST(d AS VARCHAR) AS snapshot_date, CAST(count(*) AS BIGINT) AS n_window_txns, """
    + ", ".join(f"{O.r6(f'sum(z{i} * v{i} * exp(s{i}))')} AS h{i}" for i in range(4))
    + " FROM gl GROUP BY sender_id, d",
)
def q_sender_gated_state(spark, sf):
    """The order-indexed gated state of every active sender and day."""
    tt, ch = vocabs(spark, sf)
    s = recurrence.gated_sender_state(snapshots.event_features(txn(spark, sf), tt, ch))
    return s.select("sender_id", ds("snapshot_date").alias("snapshot_date"), "n_window_txns", *[r6(F.get("state", i)).alias(f"h{i}") for i in range(4)])


# ================================================== 2.6 sort / limit


@register(
    "sort_by_time",
    O.with_("txn") + "SELECT txn_id, row_number() OVER (ORDER BY txn_time_utc, txn_id) AS pos FROM txn",
)
def q_sort_by_time(spark, sf):
    r = bucketed_rank(txn(spark, sf), [], F.date_trunc("minute", F.col("txn_time_utc")), [F.col("txn_time_utc"), F.col("txn_id")], out="pos")
    return r.select("txn_id", "pos")


@register(
    "sorted_dates",
    O.with_("txn", "feat") + "SELECT CAST(txn_date AS VARCHAR) AS txn_date, row_number() OVER (ORDER BY txn_date) AS pos FROM (SELECT DISTINCT txn_date FROM feat) x",
)
def q_sorted_dates(spark, sf):
    d = feat(spark, sf).select("txn_date").distinct()
    # bounded: one row per calendar date
    r = bucketed_rank(d, [], F.year("txn_date"), [F.col("txn_date")], out="pos")
    return r.select(ds("txn_date").alias("txn_date"), "pos")


@register(
    "list_options",
    O.with_("txn", "feat", "ent")
    + """(SELECT 'sender' AS kind, sender_id AS code, sender_id AS display_name FROM (SELECT DISTINCT sender_id FROM feat) s ORDER BY sender_id LIMIT 50)
UNION ALL
(SELECT 'recipient', r.recipient_canon_id, coalesce(e.primary_display_name, r.recipient_canon_id)
 FROM (SELECT DISTINCT recipient_canon_id FROM feat) r LEFT JOIN ent e ON e.recipient_entity_id = r.recipient_canon_id
 ORDER BY r.recipient_canon_id LIMIT 50)""",
)
def q_list_options(spark, sf, limit: int = 50):
    sroot, _ = built_sender_store(spark, sf, "options")
    rroot, _ = built_recipient_store(spark, sf, "options")
    s = io.scan_cumulative(spark, sroot).select(F.col("sender_id").alias("code")).distinct().orderBy("code").limit(limit)
    s = s.select(F.lit("sender").alias("kind"), "code", F.col("code").alias("display_name"))
    r = io.scan_cumulative(spark, rroot).select(F.col("recipient_canon_id").alias("code")).distinct().orderBy("code").limit(limit)
    names = io.scan_display_names(spark, fixtures.recipient_entity(spark, sf)).withColumnRenamed("recipient_entity_id", "code")
    r = r.join(names, "code", "left").select(F.lit("recipient").alias("kind"), "code", F.coalesce("primary_display_name", "code").alias("display_name"))
    return s.unionByName(r)


@register(
    "default_entity",
    O.with_("txn", "feat")
    + "SELECT 'sender' AS kind, min(sender_id) AS default_id FROM feat UNION ALL SELECT 'recipient', min(recipient_canon_id) FROM feat",
)
def q_default_entity(spark, sf):
    sroot, _ = built_sender_store(spark, sf, "default")
    rroot, _ = built_recipient_store(spark, sf, "default")
    s = io.scan_cumulative(spark, sroot).agg(F.lit("sender").alias("kind"), F.min("sender_id").alias("default_id"))
    r = io.scan_cumulative(spark, rroot).agg(F.lit("recipient").alias("kind"), F.min("recipient_canon_id").alias("default_id"))
    return s.unionByName(r)


@register("argmax_class", O.with_("txn", "feat", O.STUB) + "SELECT txn_id, pred AS pred_idx FROM am")
def q_argmax_class(spark, sf):
    f = cz.linear_scores(feat(spark, sf), [F.col("amount_log") / F.lit(10.0), F.col("hour_sin"), F.col("hour_cos")], 10)
    return f.select("txn_id", fx.argmax("prob").alias("pred_idx"))


# ====================================================== 2.7 set operators


@register(
    "union_snapshots",
    O.with_("txn", "feat")
    + """SELECT DISTINCT sender_id, NULL AS recipient_canon_id, CAST(txn_date AS VARCHAR) AS snapshot_date FROM feat
UNION ALL SELECT DISTINCT NULL, recipient_canon_id, CAST(txn_date AS VARCHAR) FROM feat""",
)
def q_union_snapshots(spark, sf):
    f = feat(spark, sf)
    s = snapshots.active_pairs(f, "sender_id")
    r = snapshots.active_pairs(f, "recipient_canon_id")
    u = s.unionByName(r, allowMissingColumns=True)
    return u.select("sender_id", "recipient_canon_id", ds("snapshot_date").alias("snapshot_date"))


# ===================================================== 2.8 scalar functions


@register("strip_accents", O.with_("txn") + "SELECT txn_id, strip_accents(lower(coalesce(msg_content, ''))) AS cleaned FROM txn")
def q_strip_accents(spark, sf):
    return txn(spark, sf).select("txn_id", strip_accents(fx.fill_text("msg_content")).alias("cleaned"))


@register(
    "keyword_match",
    O.with_("txn", O.KWHITS) + "SELECT txn_id, h.keyword AS keyword FROM (SELECT txn_id, unnest(hits) AS h FROM kwh) x",
)
def q_keyword_match(spark, sf):
    cleaned = strip_accents(fx.fill_text("msg_content"))
    kws = [kw for _, ks in KEYWORD_RULES for kw in ks]
    hits = F.array_compact(F.array(*[F.when(keyword_match(F.col("cleaned"), kw), F.lit(kw)) for kw in kws]))
    return txn(spark, sf).select("txn_id", cleaned.alias("cleaned")).select("txn_id", F.explode(hits).alias("keyword"))


@register("type_rule", O.with_("txn") + f"SELECT txn_id, {O._type_rule_case('tranx_type')} AS type_label FROM txn")
def q_type_rule(spark, sf):
    return txn(spark, sf).select("txn_id", type_rule("tranx_type").alias("type_label"))


@register(
    "extract_json_reply",
    O.with_("reply", O.REPLIES) + f"SELECT txn_id, parsed, has_label, label, {O.r6('confidence')} AS confidence FROM rp",
)
def q_extract_json_reply(spark, sf):
    r = fixtures.external_replies(spark, sf).withColumn("p", extract_json_reply("reply_text"))
    return r.select("txn_id", "p.parsed", "p.has_label", "p.label", r6("p.confidence").alias("confidence"))


@register(
    "confidence_gate",
    O.with_("reply", O.REPLIES)
    + f"""SELECT txn_id, CASE WHEN confidence < 0.8 THEN 'unknown' ELSE label END AS label,
       (CASE WHEN confidence < 0.8 THEN 'unknown' ELSE label END) IS NOT NULL AND (CASE WHEN confidence < 0.8 THEN 'unknown' ELSE label END) <> 'unknown' AS success,
       {O.r6('confidence')} AS confidence FROM rp WHERE parsed AND has_label""",
)
def q_confidence_gate(spark, sf):
    r = fixtures.external_replies(spark, sf).withColumn("p", extract_json_reply("reply_text")).where("p.parsed AND p.has_label")
    g = confidence_gate(F.col("p.label"), F.col("p.confidence"))
    return r.select("txn_id", g["label"].alias("label"), g["success"].alias("success"), r6(g["confidence"]).alias("confidence"))


@register(
    "bin_amount",
    O.with_("txn", "feat", "qs AS (SELECT quantile_cont(amount_log, [0.2, 0.4, 0.6, 0.8]) AS q FROM feat)")
    + """SELECT txn_id, CASE WHEN amount_log <= q[1] THEN 0 WHEN amount_log <= q[2] THEN 1 WHEN amount_log <= q[3] THEN 2
                   WHEN amount_log <= q[4] THEN 3 ELSE 4 END AS amt_bin FROM feat, qs""",
)
def q_bin_amount(spark, sf):
    f = feat(spark, sf)
    q = exact_quantiles(f, "amount_log", _QS)
    edges = [q.where(F.col("q_idx") == i).select("value").scalar() for i in range(4)]
    return f.select("txn_id", fx.bin_by_edges("amount_log", edges).alias("amt_bin"))


@register("category_index", O.with_("txn", "feat", O.VOCAB) + "SELECT txn_id, tt_r AS tt_idx, ch_r AS ch_idx FROM fv")
def q_category_index(spark, sf):
    tt, ch = vocabs(spark, sf)
    return txn(spark, sf).select(
        "txn_id",
        fx.category_index(fx.fill_unknown("tranx_type"), tt).alias("tt_idx"),
        fx.category_index(fx.fill_unknown("channel"), ch).alias("ch_idx"),
    )


@register(
    "one_hot",
    O.with_("txn", "feat", O.VOCAB)
    + """SELECT f.txn_id,
       (SELECT string_agg(CASE WHEN vt.tt_r = f.tt_r THEN '1' ELSE '0' END, ',' ORDER BY vt.tt_r) FROM vt) AS tt_onehot,
       (SELECT string_agg(CASE WHEN vc.ch_r = f.ch_r THEN '1' ELSE '0' END, ',' ORDER BY vc.ch_r) FROM vc) AS ch_onehot
FROM fv f""",
)
def q_one_hot(spark, sf):
    tt, ch = vocabs(spark, sf)

    def s(v: Column) -> Column:
        return F.array_join(F.transform(v, lambda x: x.cast("int").cast("string")), ",")

    t = txn(spark, sf)
    return t.select(
        "txn_id",
        s(fx.one_hot(fx.fill_unknown("tranx_type"), tt)).alias("tt_onehot"),
        s(fx.one_hot(fx.fill_unknown("channel"), ch)).alias("ch_onehot"),
    )


@register(
    "standardize",
    O.with_("txn", "feat", O.VOCAB, O.SCALED) + f"SELECT txn_id, {O.r6('z0')} AS amount_z, {O.r6('z1')} AS hour_sin_z, {O.r6('z2')} AS hour_cos_z FROM sc",
)
def q_standardize(spark, sf):
    st = context.scaler_stats(txn(spark, sf))
    f = context.numeric_features(txn(spark, sf))
    out = [F.col("txn_id")]
    for c, nm in zip(context.NUMERIC, ["amount_z", "hour_sin_z", "hour_cos_z"]):
        out.append(r6(fx.standardize(c, st.select(f"{c}_mean").scalar(), st.select(f"{c}_std").scalar())).alias(nm))
    return f.select(*out)


def _ctx_numeric_vec(spark: SparkSession, sf: str) -> DataFrame:
    art = ctx_art(spark, sf)
    f = context.numeric_features(txn(spark, sf))
    scaled = F.array(*[(F.col(c) - F.lit(m)) / F.lit(s) for c, m, s in zip(context.NUMERIC, art.means, art.stds)])
    v = fx.concat_vectors(scaled, fx.one_hot(fx.fill_unknown("tranx_type"), art.tt_vocab), fx.one_hot(fx.fill_unknown("channel"), art.ch_vocab))
    return f.select("txn_id", v.alias("v"))


@register(
    "concat_vectors",
    _CTX_NUM_SQL + f"SELECT txn_id, CAST(3 + (SELECT nt + nc FROM nv) AS INT) AS n_dims, {O.r6('sum((dim + 1) * v)')} AS checksum FROM ctxl GROUP BY txn_id",
)
def q_concat_vectors(spark, sf):
    v = _ctx_numeric_vec(spark, sf)
    return v.select("txn_id", F.size("v").alias("n_dims"), r6(fx.checksum("v")).alias("checksum"))


@register(
    "l2_normalize",
    _CTX_NUM_SQL
    + f"""SELECT txn_id, {O.r6('sum((dim + 1) * v) / greatest(sqrt(sum(v * v)), 1e-9)')} AS checksum,
       {O.r6('sum(v * v) / greatest(sum(v * v), 1e-18)')} AS norm_sq FROM ctxl GROUP BY txn_id""",
)
def q_l2_normalize(spark, sf):
    v = _ctx_numeric_vec(spark, sf).withColumn("n", fx.l2_normalize("v"))
    return v.select("txn_id", r6(fx.checksum("n")).alias("checksum"), r6(F.aggregate("n", F.lit(0.0), lambda a, x: a + x * x)).alias("norm_sq"))


_TOKENS_SQL = O.with_("txn", "feat", "ent", "mer", "per", _META_SQL) + """,
ids AS (SELECT DISTINCT recipient_canon_id FROM feat),
toks AS (SELECT i.recipient_canon_id,
            CASE WHEN m.recipient_entity_id IS NULL THEN ['none']
                 ELSE list_filter(['etype_' || coalesce(m.entity_type, 'UNK'),
                                   CASE WHEN m.mcc IS NOT NULL THEN 'mcc_' || m.mcc END,
                                   CASE WHEN m.age_band IS NOT NULL THEN 'age_' || m.age_band END,
                                   CASE WHEN m.province_code IS NOT NULL THEN 'prov_' || m.province_code END,
                                   CASE WHEN m.occupation_band IS NOT NULL THEN 'occ_' || m.occupation_band END], lambda x: x IS NOT NULL) END AS tokens
         FROM ids i LEFT JOIN meta m ON m.recipient_entity_id = i.recipient_canon_id)
"""


def _hashed(spark: SparkSession, sf: str) -> DataFrame:
    ids = feat(spark, sf).select("recipient_canon_id").distinct()
    meta = graph.recipient_metadata(fixtures.recipient_entity(spark, sf), fixtures.merchant_profile(spark, sf), fixtures.person_profile(spark, sf))
    return graph.hashed_recipients(ids, meta, 32)


@register("profile_tokens", _TOKENS_SQL + "SELECT recipient_canon_id, array_to_string(tokens, ',') AS tokens FROM toks")
def q_profile_tokens(spark, sf):
    return _hashed(spark, sf).select("recipient_canon_id", F.array_join("tokens", ",").alias("tokens"))


@register(
    "feature_hash",
    _TOKENS_SQL
    + """, tk AS (SELECT recipient_canon_id, unnest(tokens) AS t FROM toks),
hv AS (SELECT recipient_canon_id, CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT) AS h FROM tk)
SELECT recipient_canon_id, CAST(h % 32 AS INT) AS bucket,
       CAST(sum(CASE WHEN h >= 2147483648 THEN -1.0 ELSE 1.0 END) AS DOUBLE) AS value
FROM hv GROUP BY ALL HAVING sum(CASE WHEN h >= 2147483648 THEN -1.0 ELSE 1.0 END) <> 0""",
)
def q_feature_hash(spark, sf):
    h = _hashed(spark, sf)
    return h.select("recipient_canon_id", F.posexplode("hash_vec").alias("bucket", "value")).where(F.col("value") != 0).select(
        "recipient_canon_id", F.col("bucket").cast("int").alias("bucket"), F.col("value").cast("double").alias("value")
    )


@register(
    "softmax",
    O.with_("txn", "feat", O.STUB) + f"SELECT txn_id, c AS class, {O.r6('p')} AS prob FROM pr",
)
def q_softmax(spark, sf):
    f = cz.linear_scores(feat(spark, sf), [F.col("amount_log") / F.lit(10.0), F.col("hour_sin"), F.col("hour_cos")], 10)
    return f.select("txn_id", F.posexplode("prob").alias("class", "prob")).select("txn_id", "class", r6("prob").alias("prob"))


# ============================================= 2.9 feature learning (exact parts)


@register(
    "text_vector",
    O.with_("txn", O.TEXTLONG) + f"SELECT txn_id, {O.r6('sum((dim + 1) * v)')} AS checksum FROM textl GROUP BY txn_id",
)
def q_text_vector(spark, sf):
    t = txn(spark, sf)
    table = hashed_word_table(t, "msg_content", 16)
    v = sentence_vector_from_table(t, "txn_id", "msg_content", table, 16)
    return v.select("txn_id", r6(fx.checksum("text_vec")).alias("checksum"))


@register(
    "ctx_features",
    O.with_("txn", "feat", O.VOCAB, O.SCALED, O.CTXLONG, O.TEXTLONG)
    + f""", allv AS (SELECT txn_id, dim, v FROM ctxl UNION ALL SELECT txn_id, 3 + (SELECT nt + nc FROM nv) + dim, v FROM textl)
SELECT txn_id, CAST(3 + (SELECT nt + nc FROM nv) + 16 AS INT) AS n_dims, {O.r6('sum((dim + 1) * v)')} AS checksum FROM allv GROUP BY txn_id""",
)
def q_ctx_features(spark, sf):
    c = context.build_ctx(txn(spark, sf), ctx_art(spark, sf))
    return c.select("txn_id", F.size("ctx_vec").alias("n_dims"), r6(fx.checksum("ctx_vec")).alias("checksum"))


@register(
    "ctx_features_wide",
    O.with_("txn", "feat", O.VOCAB, O.SCALED, O.CTXLONG, O.TEXTLONG.replace("range(0, 16)", "range(0, 300)"))
    + f""", allv AS (SELECT txn_id, dim, v FROM ctxl UNION ALL SELECT txn_id, 3 + (SELECT nt + nc FROM nv) + dim, v FROM textl)
SELECT txn_id, CAST(3 + (SELECT nt + nc FROM nv) + 300 AS INT) AS n_dims, round(sum((dim + 1) * v), 5) + 0.0 AS checksum FROM allv GROUP BY txn_id""",
)
def q_ctx_features_wide(spark, sf):
    """Context vectors with the full 300-wide sentence vector, as the models take them."""
    c = context.build_ctx(txn(spark, sf), ctx_art(spark, sf, TEXT_DIM))
    return c.select("txn_id", F.size("ctx_vec").alias("n_dims"), (F.round(fx.checksum("ctx_vec"), 5) + F.lit(0.0)).alias("checksum"))


# ============================================ 2.10 training set, splits, metrics

_VALID = "valid AS (SELECT f.*, lm.idx AS label_idx FROM feat f JOIN lm ON lm.code = f.category)"


@register(
    "training_set",
    O.with_("txn", "feat", "lm", O.VOCAB, O.SCALED, O.CTXLONG, O.TEXTLONG, O.SND, f"ra AS ({_RCV_ACTIVE})")
    + f""", allv AS (SELECT txn_id, dim, v FROM ctxl UNION ALL SELECT txn_id, 3 + (SELECT nt + nc FROM nv) + dim, v FROM textl),
ctxck AS (SELECT txn_id, sum((dim + 1) * v) AS ck FROM allv GROUP BY txn_id)
SELECT f.txn_id, CAST(f.txn_date AS VARCHAR) AS txn_date, CAST(f.txn_date - 1 AS VARCHAR) AS feature_date,
       lm.idx AS label_idx, k.ck IS NOT NULL AS has_snd_emb, ra.d IS NOT NULL AS has_rcv_emb,
       {O.r6('c.ck')} AS ctx_checksum, {O.r6('coalesce(k.ck, 0.0)')} AS snd_checksum,
       CAST(2 * (SELECT nt + nc FROM nv) + 3 + 16 + 4 + 96 AS INT) AS n_features
FROM feat f JOIN lm ON lm.code = f.category
LEFT JOIN sndck k ON k.sender_id = f.sender_id AND k.snapshot_date = f.txn_date - 1
LEFT JOIN ra ON ra.recipient_canon_id = f.recipient_entity_id AND ra.d = f.txn_date - 1
JOIN ctxck c ON c.txn_id = f.txn_id""",
)
def q_training_set(spark, sf):
    """Flagship: context ⟕ sender ⟕ recipient snapshots at D-1, label index, valid rows."""
    ts = build_training_set(spark, sf)
    return ts.where("is_valid").select(
        "txn_id",
        ds("txn_date").alias("txn_date"),
        ds("_feature_date").alias("feature_date"),
        F.col("label_idx").cast("int").alias("label_idx"),
        "has_snd_emb",
        "has_rcv_emb",
        r6(fx.checksum("ctx_vec")).alias("ctx_checksum"),
        r6(fx.checksum("snd_emb")).alias("snd_checksum"),
        F.size("features").alias("n_features"),
    )


def build_training_set(spark: SparkSession, sf: str, tag: str = "train") -> DataFrame:
    t = txn(spark, sf)
    art = ctx_art(spark, sf)
    ctx = context.build_ctx(t, art, mode="train")
    sroot, sspec = built_sender_store(spark, sf, tag)
    rroot, rspec = built_recipient_store(spark, sf, tag)
    return training.training_set(spark, ctx, sroot, rroot, label_map(spark), sspec.dim, rspec.dim, lookback_days=1)


@register(
    "temporal_split",
    O.with_("txn", "feat", "lm", _VALID, "cut AS (SELECT quantile_cont(date_diff('day', DATE '1970-01-01', txn_date), 0.8) AS c FROM valid)")
    + "SELECT txn_id, CASE WHEN date_diff('day', DATE '1970-01-01', txn_date) < c THEN 'train' ELSE 'val' END AS split FROM valid, cut",
)
def q_temporal_split(spark, sf):
    v = training.label_lookup(feat(spark, sf).withColumn("label_l1", F.col("category")), label_map(spark)).where(F.col("label_idx") >= 0)
    return training.temporal_split(v, 0.2).select("txn_id", "split")


@register(
    "stratified_split",
    O.with_("txn", "feat", "lm", _VALID)
    + """, h AS (SELECT txn_id, label_idx, md5(txn_id || '#42') AS hh FROM valid),
r AS (SELECT h.*, row_number() OVER (PARTITION BY label_idx ORDER BY hh, txn_id) AS rk, count(*) OVER (PARTITION BY label_idx) AS n FROM h)
SELECT txn_id, CASE WHEN rk <= ceil(n * 0.2) THEN 'val' ELSE 'train' END AS split FROM r""",
)
def q_stratified_split(spark, sf):
    v = training.label_lookup(txn(spark, sf).withColumn("label_l1", F.col("category")), label_map(spark)).where(F.col("label_idx") >= 0)
    return training.stratified_split(v, 0.2, 42).select("txn_id", "split")


_SCORED = O.with_("txn", "feat", "lm", O.STUB, _VALID) + """, s AS (SELECT v.txn_id, v.label_idx AS label, am.pred FROM valid v JOIN am USING (txn_id))
"""


@register("confusion_matrix", _SCORED + "SELECT label, pred, CAST(count(*) AS BIGINT) AS n FROM s GROUP BY ALL")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(stub_scored(spark, sf))


@register("metric_accuracy", _SCORED + f"SELECT {O.r6('avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM s")
def q_metric_accuracy(spark, sf):
    return metrics.accuracy(stub_scored(spark, sf)).select(r6("accuracy").alias("accuracy"))


@register(
    "metric_macro_f1",
    _SCORED
    + f""", cl AS (SELECT label AS c FROM s UNION SELECT pred FROM s),
pc AS (SELECT c, (SELECT count(*) FROM s WHERE label = c AND pred = c) AS tp,
              (SELECT count(*) FROM s WHERE pred = c AND label <> c) AS fp,
              (SELECT count(*) FROM s WHERE label = c AND pred <> c) AS fn FROM cl)
SELECT {O.r6('avg(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2.0 * tp / (2 * tp + fp + fn) END)')} AS macro_f1 FROM pc""",
)
def q_metric_macro_f1(spark, sf):
    return metrics.macro_f1(stub_scored(spark, sf)).select(r6("macro_f1").alias("macro_f1"))


@register(
    "metric_log_loss",
    _SCORED + f"SELECT {O.r6('avg(-(pr.logit - pr.lse))')} AS log_loss FROM valid v JOIN pr ON pr.txn_id = v.txn_id AND pr.c = v.label_idx",
)
def q_metric_log_loss(spark, sf):
    return metrics.log_loss(stub_scored(spark, sf)).select(r6("log_loss").alias("log_loss"))


@register(
    "metric_auc_ovr",
    _SCORED
    + f""", ps AS (SELECT pr.c, pr.p AS s, sum(CASE WHEN v.label_idx = pr.c THEN 1 ELSE 0 END) AS p,
                   sum(CASE WHEN v.label_idx = pr.c THEN 0 ELSE 1 END) AS q
            FROM valid v JOIN pr ON pr.txn_id = v.txn_id GROUP BY pr.c, pr.p),
pa AS (SELECT ps.*, coalesce(sum(p) OVER (PARTITION BY c ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM ps),
pcl AS (SELECT c, sum(q * (above + p / 2.0)) AS u, sum(p) AS pp, sum(q) AS nn FROM pa GROUP BY c)
SELECT {O.r6('CASE WHEN count(*) < 10 OR sum(CASE WHEN pp = 0 OR nn = 0 THEN 1 ELSE 0 END) > 0 THEN 0.0 ELSE avg(u / (pp * nn)) END')} AS auc_ovr FROM pcl""",
)
def q_metric_auc_ovr(spark, sf):
    return metrics.auc_ovr(stub_scored(spark, sf), 10).select(r6("auc_ovr").alias("auc_ovr"))


# =================================================== 2.11 decision cascade

_VALID_CODES = "('BIL', 'FOO', 'TRN', 'HLT', 'INS', 'SHP', 'ENT', 'EDU', 'FIN')"


@register("rule_classify", O.with_("txn", O.RULE) + "SELECT txn_id, success, label, reason FROM rl")
def q_rule_classify(spark, sf):
    r = apply_rules(txn(spark, sf), "msg_content", "tranx_type", label_codes(spark), out="r")
    return r.select("txn_id", "r.success", "r.label", "r.reason")


_L2 = f"""ok AS (SELECT txn_id, label, confidence FROM rp WHERE parsed AND has_label),
g AS (SELECT txn_id, CASE WHEN confidence < 0.8 THEN 'unknown' ELSE label END AS glabel, confidence FROM ok),
l2 AS (SELECT r.txn_id,
              CASE WHEN g.txn_id IS NOT NULL AND g.glabel IN {_VALID_CODES} THEN TRUE ELSE FALSE END AS l2ok,
              CASE WHEN g.txn_id IS NULL THEN 'unknown' ELSE g.glabel END AS label,
              CASE WHEN g.txn_id IS NULL THEN 0.0 ELSE g.confidence END AS confidence
       FROM rl r LEFT JOIN g USING (txn_id) WHERE NOT r.success)"""


@register(
    "external_label_layer",
    O.with_("txn", "reply", O.RULE, O.REPLIES, _L2)
    + f"SELECT txn_id, CASE WHEN l2ok THEN 'success' ELSE 'fail' END AS status, label, {O.r6('confidence')} AS confidence FROM l2",
)
def q_external_label_layer(spark, sf):
    codes = label_codes(spark)
    req = cz.requests_from_transactions(txn(spark, sf))
    l1 = cz.rule_layer(req, codes)
    rest = l1.where(~F.col("_l1.success"))
    l2 = cz.external_layer(rest, fixtures.external_replies(spark, sf), [c for c in codes if c != "OTH"])
    return l2.select("txn_id", "layer2.status", "layer2.label", r6("layer2.confidence").alias("confidence"))


@register(
    "external_prompt",
    O.with_("txn", O.RULE)
    + """SELECT r.txn_id, 'Label the payment below with one code out of BIL FOO TRN HLT INS SHP ENT EDU FIN.' || chr(10)
       || 'memo: ' || coalesce(t.msg_content, '') || chr(10)
       || 'payee: ' || coalesce(t.recipient_entity_id, '') || chr(10)
       || 'Reply with a single JSON object {"label": code, "confidence": number from 0 to 1}; below 0.8 the label is "unknown".' AS prompt
FROM rl r JOIN txn t USING (txn_id) WHERE NOT r.success""",
)
def q_external_prompt(spark, sf):
    codes = label_codes(spark)
    req = cz.requests_from_transactions(txn(spark, sf))
    rest = cz.rule_layer(req, codes).where(~F.col("_l1.success"))
    return cz.external_prompt(rest, [c for c in codes if c != "OTH"])


_CASCADE_SQL = (
    O.with_("txn", "feat", "lm", "reply", O.STUB, O.RULE, O.REPLIES, _L2)
    + f""", req AS (SELECT txn_id FROM txn WHERE coalesce(trim(msg_content), '') <> '' AND amount > 0 AND recipient_entity_id IS NOT NULL),
dec AS (
  SELECT q.txn_id,
         CASE WHEN r.success THEN r.label WHEN l2.l2ok THEN l2.label ELSE coalesce(lm.code, 'unknown') END AS final_label,
         CASE WHEN r.success THEN 0.9 WHEN l2.l2ok THEN l2.confidence ELSE am.conf END AS final_confidence,
         CASE WHEN r.success THEN 'layer1_rule' WHEN l2.l2ok THEN 'layer2_llm' ELSE 'layer3_model' END AS decided_by,
         CASE WHEN r.success THEN 'success' ELSE 'fail' END AS l1_status,
         CASE WHEN r.success THEN 'skipped' WHEN l2.l2ok THEN 'success' ELSE 'fail' END AS l2_status,
         CASE WHEN r.success OR l2.l2ok THEN 'skipped' ELSE 'success' END AS l3_status
  FROM req q JOIN rl r USING (txn_id) LEFT JOIN l2 USING (txn_id) LEFT JOIN am USING (txn_id) LEFT JOIN lm ON lm.idx = am.pred)
"""
)


#: With trained vectors: rows whose sender or recipient has no stored vector fall back.
_DECIDED_SQL = """CASE WHEN r.success THEN 'layer1_rule' WHEN l2.l2ok THEN 'layer2_llm'
              WHEN q.txn_id IN (SELECT txn_id FROM txn WHERE sender_id IN (SELECT sender_id FROM feat)
                                AND recipient_entity_id IN (SELECT recipient_canon_id FROM feat)) THEN 'layer3_model'
              ELSE 'fallback_oth' END AS decided_by"""


def _cascade(spark: SparkSession, sf: str) -> DataFrame:
    t = txn(spark, sf)
    req = cz.validate_requests(cz.requests_from_transactions(t)).where("is_valid").drop("is_valid", "reject_reason")
    scores = cz.linear_scores(feat(spark, sf), [F.col("amount_log") / F.lit(10.0), F.col("hour_sin"), F.col("hour_cos")], 10).select("txn_id", "prob")

    def score_fn(rest: DataFrame) -> DataFrame:
        return scores.join(rest.select("txn_id"), "txn_id", "left_semi")

    return cz.cascade_classify(req, label_map(spark), label_codes(spark), fixtures.external_replies(spark, sf), score_fn)


@register(
    "cascade_classify",
    _CASCADE_SQL + f"SELECT txn_id, final_label, {O.r6('final_confidence')} AS final_confidence, decided_by, l1_status, l2_status, l3_status FROM dec",
)
def q_cascade_classify(spark, sf):
    d = _cascade(spark, sf)
    return d.select(
        "txn_id", "final_label", r6("final_confidence").alias("final_confidence"), "decided_by",
        F.col("layer1.status").alias("l1_status"), F.col("layer2.status").alias("l2_status"), F.col("layer3.status").alias("l3_status"),
    )


@register(
    "cascade_report",
    _CASCADE_SQL
    + f"""SELECT decided_by, CAST(count(*) AS BIGINT) AS n, {O.r6('avg(final_confidence)')} AS mean_confidence,
       {O.r6('count(*) * 1.0 / (SELECT count(*) FROM dec)')} AS share FROM dec GROUP BY decided_by""",
)
def q_cascade_report(spark, sf):
    rep = cz.cascade_report(_cascade(spark, sf))
    return rep.select("decided_by", "n", r6("mean_confidence").alias("mean_confidence"), r6("share").alias("share"))


_CTX_FULL_SQL = O.with_("txn", "feat", O.VOCAB, O.SCALED, O.CTXLONG, O.TEXTLONG) + f""", allv AS (SELECT txn_id, dim, v FROM ctxl UNION ALL SELECT txn_id, 3 + (SELECT nt + nc FROM nv) + dim, v FROM textl)
SELECT txn_id, {O.r6('sum((dim + 1) * v)')} AS checksum FROM allv GROUP BY txn_id"""


@register("artifact_save_load", _CTX_FULL_SQL)
def q_artifact_save_load(spark, sf):
    """Fit the context artifacts, save them, load them back and apply them."""
    path = shared_path(spark, "artifacts", "ctx", unique=True)
    ctx_art(spark, sf).save(spark, path)
    art = context.CtxArtifacts.load(spark, path)
    c = context.build_ctx(txn(spark, sf), art)
    return c.select("txn_id", r6(fx.checksum("ctx_vec")).alias("checksum"))


@register("sink_ctx", _CTX_FULL_SQL)
def q_sink_ctx(spark, sf):
    """Write the context table and read it back."""
    path = shared_path(spark, "processed", "ctx_emb", unique=True)
    io.sink_ctx(context.build_ctx(txn(spark, sf), ctx_art(spark, sf)), path)
    return spark.read.parquet(path).select("txn_id", r6(fx.checksum("ctx_vec")).alias("checksum"))


# ================================ R: learned and streamed parts (rows-only check)


@register("recipient_svd")
def q_recipient_svd(spark, sf):
    e = graph.interaction_edges(txn(spark, sf), 10)
    s = graph.recipient_svd(e, 64)
    return s.select(ds("snapshot_date").alias("snapshot_date"), "recipient_canon_id", r6(fx.l2_norm("svd_vec")).alias("svd_norm"))


@register("order_singular")
def q_order_singular(spark, sf):
    e = graph.interaction_edges(txn(spark, sf), 10)
    return graph.singular_values(e).select(ds("snapshot_date").alias("snapshot_date"), "rank", r6("singular_value").alias("singular_value"))


#: Edges of every window, and the leading right singular vector of each date by power iteration.
_EDGES_SQL = f"""ra AS ({_RCV_ACTIVE}),
ed AS MATERIALIZED (SELECT ra.d, f.sender_id AS s, f.recipient_canon_id AS r, ln(1 + sum(f.amount)) AS w
FROM ra JOIN feat f ON f.recipient_canon_id = ra.recipient_canon_id AND f.txn_date BETWEEN ra.d - 10 AND ra.d
WHERE f.sender_id IS NOT NULL GROUP BY ra.d, f.sender_id, f.recipient_canon_id)"""
_POWER_SQL = """pw AS (
  SELECT 0 AS k, d, r, CAST(1.0 AS DOUBLE) AS v, CAST(1.0 AS DOUBLE) AS lam FROM (SELECT DISTINCT d, r FROM ed)
  UNION ALL
  SELECT k, d, r, y / sqrt(sum(y * y) OVER (PARTITION BY d)), sqrt(sum(y * y) OVER (PARTITION BY d)) FROM (
    SELECT z.k + 1 AS k, z.d, ed.r, sum(ed.w * z.z) AS y
    FROM (SELECT max(pw.k) AS k, ed.d, ed.s, sum(ed.w * pw.v) AS z FROM pw JOIN ed ON ed.d = pw.d AND ed.r = pw.r WHERE pw.k < 60 GROUP BY ed.d, ed.s) z
    JOIN ed ON ed.d = z.d AND ed.s = z.s GROUP BY z.k, z.d, ed.r) q)"""


@register(
    "svd_leading",
    O.with_("txn", "feat", _EDGES_SQL, _POWER_SQL).replace("WITH ", "WITH RECURSIVE ", 1)
    + """SELECT CAST(d AS VARCHAR) AS snapshot_date, r AS recipient_canon_id, round(v * sqrt(sqrt(lam)), 4) + 0.0 AS leading,
       round(sqrt(lam), 4) + 0.0 AS singular_value FROM pw WHERE k = 60""",
)
def q_svd_leading(spark, sf):
    """Every recipient's leading coordinate and its date's largest singular value (the SQL finds them by power iteration)."""
    f = factorise(graph.interaction_edges(txn(spark, sf), 10), 64, rounds=7)  # to four digits
    top = f.values.where("rank = 1").select("snapshot_date", "singular_value")
    v = f.vectors.join(F.broadcast(top), "snapshot_date")  # one row per date
    four = lambda x: F.round(x, 4) + F.lit(0.0)
    return v.select(ds("snapshot_date").alias("snapshot_date"), "recipient_canon_id", four(F.get("svd_vec", 0)).alias("leading"), four("singular_value").alias("singular_value"))


@register("recipient_snapshot")
def q_recipient_snapshot(spark, sf):
    root, _ = built_recipient_store(spark, sf, "rcv_snapshot")
    r = spark.read.parquet(io.daily_root(root))
    return r.select("recipient_canon_id", ds("snapshot_date").alias("snapshot_date"), F.size("rcv_emb").alias("dim"), r6(fx.l2_norm("rcv_emb")).alias("norm"))


@register("ctx_embedding")
def q_ctx_embedding(spark, sf):
    """Losses of the context auto-encoder's epochs, and its embedding's width."""
    model = trained_ctx_encoder(spark, sf)
    rows = [(int(h["epoch"]), h["train_loss"], h["val_loss"]) for h in model.extra["history"]]
    h = spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double")
    return h.select(F.lit(model.net.spec["code"]).alias("k"), "epoch", r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


def trained_ctx_encoder(spark: SparkSession, sf: str):
    """The context auto-encoder, trained once per application and input."""
    key = (spark.sparkContext.applicationId, sf, "ctx_encoder")
    if key not in _BUILT:
        _BUILT[key] = context.fit_ctx_autoencoder(context.build_ctx(txn(spark, sf), trained_ctx_art(spark, sf)), EMB_DIM)
    return _BUILT[key]


def trained_ctx_art(spark: SparkSession, sf: str) -> context.CtxArtifacts:
    """The context artifacts that the models are trained on, fitted once per application and input."""
    key = (spark.sparkContext.applicationId, sf, "ctx_art")
    if key not in _BUILT:
        _BUILT[key] = ctx_art(spark, sf, TEXT_DIM)
    return _BUILT[key]


@register("ctx_embedding_rows", O.with_("txn") + "SELECT txn_id, 128 AS dim, true AS normalised FROM txn")
def q_ctx_embedding_rows(spark, sf):
    """Every transaction's context embedding: its width, and that the last layer normalised it (before gain and shift: mean 0, variance 1)."""
    model = trained_ctx_encoder(spark, sf)
    p = model.net.split(model.params)
    gain, shift = ([float(x) for x in p[f"encoder.5.{k}"]] for k in ("gain", "shift"))
    e = context.embed(context.build_ctx(txn(spark, sf), trained_ctx_art(spark, sf)), model)
    unit = F.zip_with(F.zip_with("ctx_emb", F.lit(shift), lambda x, b: x - b), F.lit(gain), lambda x, g: x / g)
    e = e.withColumn("u", unit).withColumn("mean", fx.dot_sum("u") / F.size("u")).withColumn("second", fx.dot_sum(F.transform("u", lambda x: x * x)) / F.size("u"))
    return e.select("txn_id", F.size("ctx_emb").alias("dim"), ((F.abs("mean") < 1e-6) & (F.col("second") <= 1.0 + 1e-6) & (F.col("second") > 0.5)).alias("normalised"))


@register("sender_encoder")
def q_sender_encoder(spark, sf):
    """Losses of the recurrent sender encoder's epochs (type and amount heads together)."""
    from paylabel.plans.encoders import fit_sender_encoder

    tt, ch = vocabs(spark, sf)
    model = fit_sender_encoder(_examples(spark, sf), len(tt), len(ch))
    rows = [(int(h["epoch"]), h["train_loss"], h["val_loss"]) for h in model.extra["history"]]
    h = spark.createDataFrame(rows, "epoch int, train_loss double, val_loss double")
    return h.select("epoch", r6("train_loss").alias("train_loss"), r6("val_loss").alias("val_loss"))


@register("next_event_models")
def q_next_event_models(spark, sf):
    from paylabel.plans.encoders import fit_next_event_models

    return fit_next_event_models(_examples(spark, sf), n_types=len(vocabs(spark, sf)[0]))[1]


def trained_parts(spark: SparkSession, sf: str) -> dict:
    """Classifier, its validation metrics, scored rows and scorer: trained once per application and input."""
    key = (spark.sparkContext.applicationId, sf, "trained")
    if key not in _BUILT:
        root = shared_path(spark, "artifacts", "trained", unique=True)
        art = trained_ctx_art(spark, sf)
        ctx = context.build_ctx(txn(spark, sf), art, mode="train")
        embedder = trained_ctx_encoder(spark, sf)
        sroot, sspec = built_sender_store(spark, sf, "trained")
        rroot, rspec = built_recipient_store(spark, sf, "trained")
        ctx = context.embed(ctx, embedder)
        ts = training.training_set(spark, ctx, sroot, rroot, label_map(spark), sspec.dim, rspec.dim, lookback_days=1, ctx_col="ctx_emb")
        ts = ts.where("is_valid").select("txn_id", "txn_date", "features", "label_idx").checkpoint(eager=True)
        split = training.temporal_split(ts, 0.2).checkpoint(eager=True)
        model, m = training.fit_classifier(split.where("split = 'train'"), split.where("split = 'val'"), 10)
        # saved and loaded, as the jobs do
        art.save(spark, f"{root}/ctx")
        embedder.save(spark, f"{root}/ctx_encoder")
        model.save(spark, f"{root}/classifier")
        _BUILT[key] = {"root": root, "stores": (sroot, rroot), "model": model, "metrics": m.checkpoint(eager=True), "rows": split, "scorer": scoring.load_scorer(spark, root, sroot, rroot)}
    return _BUILT[key]


@register("train_classifier")
def q_train_classifier(spark, sf):
    return trained_parts(spark, sf)["metrics"]


@register("train_history")
def q_train_history(spark, sf):
    """Every epoch of the classifier's training: losses, validation accuracy and macro-F1."""
    h = training.training_history(spark, trained_parts(spark, sf)["model"])
    return h.select("epoch", *[r6(c).alias(c) for c in ("train_loss", "val_loss", "accuracy", "f1_macro")])


@register("score_batch")
def q_score_batch(spark, sf):
    """All valid rows scored by the trained classifier: code and confidence."""
    parts = trained_parts(spark, sf)
    scored = training.score_batch(parts["scorer"].classifier, parts["rows"], keep=["txn_id", "label_idx"])
    lm = F.broadcast(label_map(spark).select(F.col("idx").alias("pred"), F.col("code").alias("pred_code")))  # 10 rows
    return scored.join(lm, "pred", "left").select("txn_id", "pred_code", r6("confidence").alias("confidence"))


class _Placed:
    """Artifacts and stores that queries have built, as ``jobs.Paths`` names them."""

    def __init__(self, artifacts: str, x_snd: str, x_rcv: str):
        self.artifacts, self.x_snd, self.x_rcv = artifacts, x_snd, x_rcv


def _timed_requests(spark: SparkSession, sf: str) -> DataFrame:
    t = txn(spark, sf)
    return cz.requests_from_transactions(t).join(t.select("txn_id", "txn_time_utc"), "txn_id")


@register(
    "score_requests",
    O.with_("txn", "feat")
    + """SELECT txn_id, true AS sums_to_one FROM txn
WHERE sender_id IN (SELECT sender_id FROM feat) AND recipient_entity_id IN (SELECT recipient_canon_id FROM feat)""",
)
def q_score_requests(spark, sf):
    """Unlabelled requests scored with the trained parts; exactly those with stored vectors."""
    s = scoring.score_requests(_timed_requests(spark, sf), trained_parts(spark, sf)["scorer"])
    total = F.aggregate("prob", F.lit(0.0), lambda a, x: a + x)
    return s.select("txn_id", (F.abs(total - 1.0) < 1e-9).alias("sums_to_one"))


@register(
    "cascade_model",
    _CASCADE_SQL.replace("CASE WHEN r.success THEN 'layer1_rule' WHEN l2.l2ok THEN 'layer2_llm' ELSE 'layer3_model' END AS decided_by", _DECIDED_SQL)
    + """SELECT txn_id, decided_by, CASE decided_by WHEN 'layer3_model' THEN 'model' WHEN 'fallback_oth' THEN 'OTH' ELSE final_label END AS label,
       CAST(NULL AS VARCHAR) AS reject_reason FROM dec
UNION ALL SELECT txn_id, 'rejected', NULL, CASE WHEN coalesce(trim(msg_content), '') = '' THEN 'message must not be empty'
       WHEN amount IS NULL OR amount <= 0 THEN 'amount must be greater than 0' ELSE 'recipient_entity_id is required' END
FROM txn WHERE txn_id NOT IN (SELECT txn_id FROM dec)""",
)
def q_cascade_model(spark, sf):
    """Every request decided by rules, replies and the trained model, or rejected with its reason.

    The model's own label is fitted, so it stands as ``model`` where it is in the taxonomy.
    """
    decided, rejected = scoring.classify_requests(_timed_requests(spark, sf), trained_parts(spark, sf)["scorer"], fixtures.external_replies(spark, sf))
    by_model = (F.col("decided_by") == "layer3_model") & F.col("final_label").isin(label_codes(spark)) & F.col("final_confidence").between(0.0, 1.0)
    return decided.select(
        "txn_id", "decided_by", F.when(by_model, "model").otherwise(F.col("final_label")).alias("label"), F.lit(None).cast("string").alias("reject_reason")
    ).unionByName(rejected.withColumn("decided_by", F.lit("rejected")), allowMissingColumns=True)


@register("cascade_predictions")
def q_cascade_predictions(spark, sf):
    """Every decided request with its final label and confidence, the trained model's own included."""
    decided, _ = scoring.classify_requests(_timed_requests(spark, sf), trained_parts(spark, sf)["scorer"], fixtures.external_replies(spark, sf))
    return decided.select("txn_id", "decided_by", "final_label", r6("final_confidence").alias("final_confidence"))


@register(
    "stream_classify",
    _CASCADE_SQL.replace("CASE WHEN r.success THEN 'layer1_rule' WHEN l2.l2ok THEN 'layer2_llm' ELSE 'layer3_model' END AS decided_by", _DECIDED_SQL)
    + """SELECT txn_id, decided_by FROM dec
UNION ALL SELECT txn_id, 'rejected' FROM txn WHERE txn_id NOT IN (SELECT txn_id FROM dec)""",
)
def q_stream_classify(spark, sf):
    """Requests streamed through rules, replies and the trained model; decided and rejected ones from the two sinks."""
    from paylabel.streaming.jobs import classified, classify_stream

    parts = trained_parts(spark, sf)
    sroot, rroot = parts["stores"]
    base = shared_path(spark, "streams", "classify", unique=True)
    requests = _timed_requests(spark, sf)
    requests.write.parquet(f"{base}/landing")
    paths = _Placed(parts["root"], sroot, rroot)
    classify_stream(spark, f"{base}/landing", requests.schema, fixtures.external_replies(spark, sf), paths, f"{base}/out", f"{base}/checkpoint")
    decided, rejected = classified(spark, f"{base}/out")
    return decided.select("txn_id", "decided_by").unionByName(rejected.select("txn_id", F.lit("rejected").alias("decided_by")))


@register("text_vector_word2vec")
def q_text_vector_word2vec(spark, sf):
    """Sentence vectors from a Word2Vec model fitted on the memos (table-join form)."""
    t = txn(spark, sf)
    model = context.fit_word2vec(t, "msg_content", 16)
    table = model.getVectors().select("word", vector_to_array("vector").alias("vector"))
    v = sentence_vector_from_table(t, "txn_id", "msg_content", table, 16)
    return v.select("txn_id", r6(fx.l2_norm("text_vec")).alias("norm"))


@register(
    "text_vector_subword",
    O.with_("txn")
    + """SELECT txn_id, 300 AS dim, len(list_filter(string_split_regex(coalesce(msg_content, ''), '\\s+'), lambda x: x <> '')) > 0 AS has_vector FROM txn""",
)
def q_text_vector_subword(spark, sf):
    """Sentence vectors of 300 dimensions from learnt words and their n-grams; every word has one, so only empty memos have none."""
    t = txn(spark, sf)
    words = subword.fit_words(t, "msg_content").checkpoint(eager=True)
    vocabulary = t.select(F.explode(tokens("msg_content")).alias("word"))
    table = subword.word_vectors(vocabulary, words, subword.ngram_vectors(words))
    v = subword.sentence_vectors(t, "txn_id", "msg_content", table)
    return v.select("txn_id", F.size("text_vec").alias("dim"), (fx.l2_norm("text_vec") > 0).alias("has_vector"))


@register(
    "profile_tokens_bridged",
    _TOKENS_SQL.replace(
        "FROM ids i LEFT JOIN meta m ON m.recipient_entity_id = i.recipient_canon_id)",
        "FROM ids i LEFT JOIN (SELECT 'MER_' || merchant_id AS cid, recipient_entity_id FROM mer) b ON b.cid = i.recipient_canon_id"
        " LEFT JOIN meta m ON m.recipient_entity_id = coalesce(b.recipient_entity_id, i.recipient_canon_id))",
    )
    + "SELECT recipient_canon_id, array_to_string(tokens, ',') AS tokens FROM toks",
)
def q_profile_tokens_bridged(spark, sf):
    """Metadata tokens with merchant-only recipients bridged to their entity."""
    ids = feat(spark, sf).select("recipient_canon_id").distinct()
    mer = fixtures.merchant_profile(spark, sf)
    meta = graph.recipient_metadata(fixtures.recipient_entity(spark, sf), mer, fixtures.person_profile(spark, sf))
    h = graph.hashed_recipients(ids, meta, 32, bridge=graph.merchant_bridge(mer))
    return h.select("recipient_canon_id", F.array_join("tokens", ",").alias("tokens"))


@register(
    "stream_score",
    _CASCADE_SQL + f"SELECT txn_id, final_label, {O.r6('final_confidence')} AS final_confidence, decided_by FROM dec",
)
def q_stream_score(spark, sf):
    from paylabel.streaming.jobs import stream_score

    out = stream_score(spark, sf)
    return out.select("txn_id", "final_label", r6("final_confidence").alias("final_confidence"), "decided_by")


@register(
    "stream_daily_edges",
    O.with_("txn", "feat")
    + f"""SELECT CAST(txn_date AS VARCHAR) AS day, sender_id, recipient_canon_id, {O.r6('sum(amount)')} AS amount_sum, CAST(count(*) AS BIGINT) AS n
FROM feat GROUP BY txn_date, sender_id, recipient_canon_id""",
)
def q_stream_daily_edges(spark, sf):
    from paylabel.streaming.jobs import stream_daily_edges

    return stream_daily_edges(spark, sf)


FLAGSHIP = "training_set"
