"""Readers and writers: raw tables, label map, feature-store partitions.

Store layout (one per feature family)::

    <root>/daily/date=YYYY-MM-DD/part-*.parquet   one partition per snapshot date
    <root>/cumulative/...                         upserted view (``upsert_store``)

The cumulative view is never overwritten in place: a batch writes its own rows, and a
manifest that appears whole makes them count, so a reader never sees a half-written table.
"""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylabel.sources.upsert_store import UpsertStore

LABEL_MAP_PATH = str(Path(__file__).resolve().parent.parent / "data" / "label_map.json")

TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType()),
        T.StructField("sender_id", T.StringType()),
        T.StructField("txn_time_utc", T.TimestampNTZType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("tranx_type", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("msg_content", T.StringType()),
        T.StructField("recipient_entity_id", T.StringType()),
        T.StructField("recipient_alias_raw", T.StringType()),
        T.StructField("to_account_number_hash", T.StringType()),
        T.StructField("to_bank_code", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("geo_cell_h3_8", T.StringType()),
    ]
)


# ---------------------------------------------------------------- raw sources


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def normalize_time(df: DataFrame, col: str = "txn_time_utc") -> DataFrame:
    """Accept ISO strings with a trailing ``Z`` as well as timestamps."""
    if isinstance(df.schema[col].dataType, T.StringType):
        return df.withColumn(col, F.to_timestamp_ntz(F.regexp_replace(col, "Z$", "")))
    return df


def scan_by_suffix(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """``.parquet`` or ``.csv`` by extension; anything else is a ``ValueError``."""
    suffix = os.path.splitext(path.rstrip("/"))[1].lower()
    if suffix == ".parquet":
        return scan_parquet(spark, path, schema)
    if suffix == ".csv":
        reader = spark.read.option("header", "true")
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
        return normalize_time(reader.csv(path)) if "txn_time_utc" in (schema.names if schema else []) else reader.csv(path)
    raise ValueError(f"cannot read {path}: the extension must be .parquet or .csv, not {suffix or 'empty'}")


def scan_label_map(spark: SparkSession, path: str = LABEL_MAP_PATH) -> DataFrame:
    """``{code: {index, name}}`` JSON -> dimension rows ``(code, idx, name)``.

    The taxonomy that comes with the package is read where the package is, on the driver; any
    other file through Spark, so that it may stand in any store.
    """
    if path == LABEL_MAP_PATH:
        with open(path) as f:
            taxonomy = json.load(f)
    else:
        text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
        taxonomy = json.loads(text)
    rows = [(code, int(e["index"]), e["name"]) for code, e in taxonomy.items()]
    return spark.createDataFrame(rows, "code string, idx int, name string").coalesce(1)


def scan_display_names(spark: SparkSession, entity: DataFrame | str | None) -> DataFrame:
    """id -> display name; an empty frame when the entity table is absent."""
    schema = "recipient_entity_id string, primary_display_name string"
    if entity is None:
        return spark.createDataFrame([], schema)
    if isinstance(entity, str):
        if not path_exists(spark, entity):
            return spark.createDataFrame([], schema)
        entity = spark.read.parquet(entity)
    return entity.select(F.col("recipient_entity_id").cast("string"), "primary_display_name")


# ----------------------------------------------------------- filesystem helpers


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs_and_path(spark, path)
    return bool(fs.exists(hpath))


def list_partition_values(spark: SparkSession, root: str, key: str) -> list[str]:
    """Values of ``key=value`` folders that hold a finished write (metadata only)."""
    fs, hpath = _fs_and_path(spark, root)
    if not fs.exists(hpath):
        return []
    out = []
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{key}="):
            out.append(name.split("=", 1)[1])
    return sorted(out)


# ---------------------------------------------------------------- store sinks


def daily_root(store_root: str) -> str:
    return f"{store_root.rstrip('/')}/daily"


def cumulative_root(store_root: str) -> str:
    return f"{store_root.rstrip('/')}/cumulative"


def sink_ctx(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def sink_daily_snapshot(df: DataFrame, store_root: str) -> None:
    """Write one partition per ``date``, replacing only the dates present in ``df``.

    ``REBALANCE`` on the partition key lets AQE gather each date into few
    files and split a date that is too large, instead of every task writing
    a file into every date folder.
    """
    (
        df.hint("rebalance", "date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(daily_root(store_root))
    )


def stored_dates(spark: SparkSession, store_root: str) -> list[str]:
    return list_partition_values(spark, daily_root(store_root), "date")


def scan_cumulative(spark: SparkSession, store_root: str) -> DataFrame | None:
    """The upserted view, or ``None`` if nothing was stored."""
    return UpsertStore(spark, cumulative_root(store_root)).rows()


def sink_upsert_cumulative(spark: SparkSession, new_rows: DataFrame, store_root: str, key: str) -> None:
    """Stored rows whose key is in ``new_rows`` give way to them; only the new rows, and buckets that
    have gathered many batches, are written.  Superseded files go."""
    store = UpsertStore(spark, cumulative_root(store_root))
    store.upsert(new_rows, key)
    store.vacuum()


def scan_snapshots(spark: SparkSession, store_root: str, dates: DataFrame) -> DataFrame | None:
    """Snapshots of the wanted dates only, tagged ``_feature_date`` (DATE).

    ``dates`` is a one-column frame of wanted dates; the semi join on the
    partition column lets dynamic partition pruning skip other dates.
    Returns ``None`` when the store has no partitions at all.
    """
    root = daily_root(store_root)
    if not stored_dates(spark, store_root):
        return None
    snaps = spark.read.parquet(root)
    wanted = dates.select(F.col(dates.columns[0]).cast("date").alias("date")).distinct()
    # a literal date range prunes partitions at planning time (one tiny job for the
    # bounds); the semi join then keeps exactly the wanted dates inside the range
    lo, hi = wanted.agg(F.min("date"), F.max("date")).first()
    if lo is None:
        return snaps.limit(0).withColumn("_feature_date", F.col("date"))
    snaps = snaps.where(F.col("date").between(F.lit(lo), F.lit(hi)))
    return snaps.join(wanted, on="date", how="left_semi").withColumn("_feature_date", F.col("date"))


def missing_snapshot_dates(spark: SparkSession, store_root: str, dates: DataFrame) -> DataFrame:
    """Wanted dates with no stored partition (the reference only warns about these)."""
    have = spark.createDataFrame([(d,) for d in stored_dates(spark, store_root)], "date string").select(
        F.col("date").cast("date").alias("date")
    )
    wanted = dates.select(F.col(dates.columns[0]).cast("date").alias("date")).distinct()
    return wanted.join(have, on="date", how="left_anti")


# ------------------------------------------------------------------ artifacts


def save_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def load_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
