"""Payment-shaped tables derived from the driver's ``events`` table.

The reference reads a transaction landing table and four dimension tables.
The test data has none of them, so each is derived here, row for row, from
``events`` (see FIXTURES.md part B; the same derivation is written as SQL in
``paylabel.oracle`` for the DuckDB twin).  Every derivation is a projection or
a ``distinct`` over ``events``, so it grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _k() -> Column:
    return F.regexp_extract("props", "([0-9]+)", 1).cast("int")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _case(expr: Column, pairs: list[tuple[int, str]]) -> Column:
    out = None
    for key, val in pairs:
        out = (F.when(expr == key, F.lit(val)) if out is None else out.when(expr == key, F.lit(val)))
    return out


# Fixed values of the stand-in (FIXTURES.md B1): type mapping, labels, memos.
EVENT_TYPE_TO_TRANX = [
    ("purchase", "qrcode_payment"),
    ("signup", "opensaving"),
    ("click", "bill_payment"),
    ("view", "transfer_in"),
]
CATEGORY_BY_K11 = ["BIL", "FOO", "TRN", "HLT", "INS", "SHP", "ENT", "EDU", "FIN", "OTH", "ZZZ"]
MEMO_BY_K11 = [
    "Tien nước thang 3",
    "Nhà hàng Cafe",
    "Grab",
    "Khám bệnh",
    "Bảo hiểm",
    "Mua sắm tại sieu thi",
    "Ve phim",
    "Học phí",
    "Điện thoại đan",
]
MEMO_DEFAULT = "Chuyen tien"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``transactions_landing`` stand-in (15 columns)."""
    e = _events(spark, sf_dir).withColumn("k", _k())
    k = F.col("k")
    tranx = None
    for ev, tt in EVENT_TYPE_TO_TRANX:
        cond = F.col("event_type") == ev
        tranx = F.when(cond, tt) if tranx is None else tranx.when(cond, tt)
    category = _case(k % 11, list(enumerate(CATEGORY_BY_K11)))
    memo = _case(k % 11, list(enumerate(MEMO_BY_K11))).otherwise(F.lit(MEMO_DEFAULT))
    return e.select(
        F.concat(F.lit("TXN_"), _pad(F.col("event_id"), 8)).alias("txn_id"),
        F.concat(F.lit("CUST_"), _pad(F.col("user_id"), 6)).alias("sender_id"),
        F.col("ts").alias("txn_time_utc"),
        (F.col("value") * 1000).alias("amount"),
        F.lit("VND").alias("currency"),
        tranx.alias("tranx_type"),
        F.when(F.col("event_id") % 5 < 3, "MOBILE").otherwise("WEB").alias("channel"),
        category.alias("category"),
        F.when(F.col("event_id") % 50 == 0, F.lit(None).cast("string")).otherwise(memo).alias("msg_content"),
        F.when(k < 68, F.concat(F.lit("ENT_rcv_"), _pad(k, 5))).alias("recipient_entity_id"),
        F.concat(F.lit("Payee "), k.cast("string")).alias("recipient_alias_raw"),
        F.concat(F.lit("h:acc_"), F.substring(F.md5(k.cast("string")), 1, 16)).alias("to_account_number_hash"),
        _case(k % 4, [(0, "VCB"), (1, "TCB"), (2, "ACB")]).alias("to_bank_code"),
        F.when((k >= 68) & (k < 96), F.concat(F.lit("MER_"), _pad(k, 5))).alias("merchant_id"),
        F.when(
            F.col("event_id") % 10 < 7,
            F.concat(F.lit("882a100d"), (F.col("event_id") % 10).cast("string"), F.lit("bfffff")),
        ).alias("geo_cell_h3_8"),
    )


def _distinct_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(_k().alias("k")).distinct()


def recipient_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        _distinct_k(spark, sf_dir)
        .where(k < 96)
        .select(
            F.concat(F.lit("ENT_rcv_"), _pad(k, 5)).alias("recipient_entity_id"),
            F.when(k % 2 == 0, "MERCHANT").otherwise("PERSON").alias("entity_type"),
            F.concat(F.lit("Payee "), k.cast("string")).alias("primary_display_name"),
        )
    )


def merchant_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        _distinct_k(spark, sf_dir)
        .where((k < 96) & (k % 2 == 0))
        .select(
            F.concat(F.lit("MER_"), _pad(k, 5)).alias("merchant_id"),
            F.concat(F.lit("ENT_rcv_"), _pad(k, 5)).alias("recipient_entity_id"),
            F.when(k % 6 == 0, F.lit(None).cast("string")).when(k % 6 == 2, "4900").otherwise("5812").alias("mcc"),
            F.concat(F.lit("Payee "), k.cast("string")).alias("brand_name"),
        )
    )


def person_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return (
        _distinct_k(spark, sf_dir)
        .where((k < 96) & (k % 2 == 1))
        .select(
            F.concat(F.lit("PERS_"), _pad(k, 5)).alias("person_id"),
            F.concat(F.lit("ENT_rcv_"), _pad(k, 5)).alias("recipient_entity_id"),
            _case(k % 3, [(0, "18-24"), (1, "25-34")]).otherwise("unk").alias("age_band"),
            _case(k % 5, [(0, "HCM"), (1, "HN"), (2, "DN")]).alias("province_code"),
            _case(k % 7, [(0, "student"), (1, "retired")]).otherwise("salaried").alias("occupation_band"),
        )
    )


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("user_id")
    return (
        _events(spark, sf_dir)
        .select("user_id")
        .distinct()
        .select(
            F.concat(F.lit("CUST_"), _pad(u, 6)).alias("sender_id"),
            _case(u % 4, [(0, "L0"), (1, "L1"), (2, "L2")]).otherwise("L3").alias("kyc_tier"),
            _case(u % 3, [(0, "student"), (1, "salaried")]).otherwise("other").alias("segment"),
            _case(u % 3, [(0, "18-24"), (1, "25-34")]).otherwise("55+").alias("age_band"),
            F.when(u % 2 == 0, "HCM").otherwise("HN").alias("home_province_code"),
            _case(u % 4, [(0, "low"), (1, "mid"), (2, "high")]).otherwise("unk").alias("income_band"),
        )
    )


def recipient_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    base = _distinct_k(spark, sf_dir).where(k < 96)
    # two alias rows per entity: an explode of a 2-element literal array, not a join
    return base.select(
        k, F.explode(F.array(F.lit("account_name"), F.lit("handle"))).alias("alias_type")
    ).select(
        F.concat(F.lit("ENT_rcv_"), _pad(k, 5)).alias("recipient_entity_id"),
        F.when(F.col("alias_type") == "handle", F.concat(F.lit("@payee_"), k.cast("string")))
        .otherwise(F.concat(F.lit("Payee "), k.cast("string")))
        .alias("alias_text"),
        "alias_type",
    )


# Fixed reply texts of the external-labeller stand-in (FIXTURES.md B7), by event_id % 6.
REPLY_TEXTS = [
    '{"label": "FOO", "confidence": 0.95}',
    'Sure: {"label": "SHP", "confidence": 0.80} done',
    '{"label": "EDU", "confidence": 0.5}',
    "no idea",
    '{"label": null, "confidence": 0.9}',
    '{"label": "unknown", "confidence": 0.1}',
]


def external_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    return e.select(
        F.concat(F.lit("TXN_"), _pad(F.col("event_id"), 8)).alias("txn_id"),
        _case(F.col("event_id") % 6, list(enumerate(REPLY_TEXTS))).alias("reply_text"),
    )


def raw_bundle(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four tables the recipient job loads together."""
    return {
        "transactions": transactions(spark, sf_dir),
        "recipient_entity": recipient_entity(spark, sf_dir),
        "merchant_profile": merchant_profile(spark, sf_dir),
        "person_profile": person_profile(spark, sf_dir),
    }
