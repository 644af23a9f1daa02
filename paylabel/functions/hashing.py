"""Signed feature hashing of profile tokens.

Bucket and sign come from the first 8 hex digits of ``md5(token)``: bucket =
value mod ``n``, sign = bit 31.  The same arithmetic is portable to DuckDB, so
the hashed part of a recipient vector is oracle-checked.  It is not bit-equal
to a Murmur3 hasher but has the same statistics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def profile_tokens() -> Column:
    """Tokens from the joined metadata columns; no token at all -> ``['none']``.

    Expects ``entity_type, mcc, age_band, province_code, occupation_band``;
    ``entity_type`` is present only for known entities (null otherwise).
    """
    parts = F.array_compact(
        F.array(
            F.when(F.col("_known"), F.concat(F.lit("etype_"), F.coalesce(F.col("entity_type"), F.lit("UNK")))),
            F.when(F.col("_known") & F.col("mcc").isNotNull(), F.concat(F.lit("mcc_"), F.col("mcc"))),
            F.when(F.col("_known") & F.col("age_band").isNotNull(), F.concat(F.lit("age_"), F.col("age_band"))),
            F.when(F.col("_known") & F.col("province_code").isNotNull(), F.concat(F.lit("prov_"), F.col("province_code"))),
            F.when(F.col("_known") & F.col("occupation_band").isNotNull(), F.concat(F.lit("occ_"), F.col("occupation_band"))),
        )
    )
    return F.when(F.size(parts) > 0, parts).otherwise(F.array(F.lit("none")))


def token_hash_value(token: Column) -> Column:
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def token_bucket(token: Column, n: int) -> Column:
    return (token_hash_value(token) % n).cast("int")


def token_sign(token: Column) -> Column:
    return F.when(token_hash_value(token) >= F.lit(2**31), F.lit(-1.0)).otherwise(F.lit(1.0))


def hash_tokens(tokens: Column, n: int) -> Column:
    """Dense signed-count vector of length ``n`` from an array of tokens."""
    signed = F.transform(tokens, lambda t: F.struct(token_bucket(t, n).alias("b"), token_sign(t).alias("s")))
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.aggregate(signed, F.lit(0.0), lambda acc, e: acc + F.when(e["b"] == i, e["s"]).otherwise(F.lit(0.0))),
    )


