"""Exact ranks and quantiles that do not funnel a hot key into one task.

A plain ``row_number() OVER (PARTITION BY key ORDER BY t)`` sends every row of
a key to one task; a key holding a third of the data then serialises a third
of the job.  ``bucketed_rank`` computes the same number as

    (rows of the key in earlier buckets) + row_number() within (key, bucket)

where ``bucket`` is any expression monotone in the ordering (an hour of the
timestamp, a hash prefix).  The first term comes from a partially aggregated
``(key, bucket) -> count`` table with one row per key and bucket that occur (with fine
buckets and sparse keys about as many as there are rows); the second splits a hot key into as many tasks as
it has buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylabel.session import ensure_checkpoint_dir


def bucketed_rank(
    df: DataFrame,
    partition_cols: list[str],
    bucket: Column,
    order_cols: list[Column | str],
    out: str = "seq_no",
) -> DataFrame:
    """Exact 1-based ``row_number`` over ``partition_cols`` ordered by ``(bucket, order_cols)``."""
    b = "_rank_bucket"
    with_b = df.withColumn(b, bucket)
    counts = with_b.groupBy(*partition_cols, b).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*partition_cols).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    prefix = counts.select(*partition_cols, b, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(*partition_cols, b).orderBy(*order_cols)
    ranked = with_b.withColumn("_rn", F.row_number().over(within))
    return (
        ranked.join(prefix, on=[*partition_cols, b], how="inner")
        .withColumn(out, (F.col("_before") + F.col("_rn")).cast("long"))
        .drop(b, "_rn", "_before")
    )


def exact_quantiles(df: DataFrame, value: str, qs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles (numpy/pandas 'linear', DuckDB ``quantile_cont``).

    One scan counts the rows of each distinct value, so a value that most rows share is one
    row; the counts are dealt by range of value and checkpointed; running sums within each
    range start at the total of the ranges before it, for which one row per range meets in
    one window.  Returns ``(q_idx, q, value)``.
    """
    ensure_checkpoint_dir(df.sparkSession)
    x = F.col(value).cast("double")
    counts = df.select(x.alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x")).groupBy("_x").agg(F.count(F.lit(1)).alias("c"))
    counts = counts.repartitionByRange("_x").withColumn("range", F.spark_partition_id()).checkpoint(eager=True)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy("range").agg(F.sum("c").alias("total")).withColumn("start", F.coalesce(F.sum("total").over(before), F.lit(0)))
    n = counts.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    within = Window.partitionBy("range").orderBy("_x").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("inside", F.coalesce(F.sum("c").over(within), F.lit(0))).join(starts.select("range", "start"), "range")
    first = F.col("start") + F.col("inside")  # rank, from 0, of a value's first row; its last is first + c - 1
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    wanted = F.transform(
        qarr, lambda q, i: F.struct(i.alias("q_idx"), ((F.lit(n) - 1) * q).alias("h"))
    )
    covers = lambda w: (F.floor(w["h"]) + 1 >= first) & (F.floor(w["h"]) < first + F.col("c"))
    hits = placed.select("_x", "c", first.alias("first"), F.explode(F.filter(wanted, covers)).alias("w")).select("_x", "c", "first", "w.*")
    at = lambda pos: (F.col("first") <= pos) & (pos < F.col("first") + F.col("c"))
    picks = hits.groupBy("q_idx", "h").agg(
        F.max(F.when(at(F.floor("h")), F.col("_x"))).alias("v0"),
        F.max(F.when(at(F.floor("h") + 1), F.col("_x"))).alias("v1"),
    )
    frac = F.col("h") - F.floor("h")
    v1 = F.coalesce(F.col("v1"), F.col("v0"))
    return picks.select(
        F.col("q_idx").cast("int").alias("q_idx"),
        F.element_at(qarr, F.col("q_idx") + 1).alias("q"),
        (F.col("v0") + frac * (v1 - F.col("v0"))).alias("value"),
    )
