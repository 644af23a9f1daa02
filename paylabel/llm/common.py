"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import os
import sys
import types
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir, shared_path

#: Rows and bytes that one Arrow batch carries to a Python worker at most: bounds a worker's memory when rows are long.
BATCH_ROWS, BATCH_BYTES = 1000, 32 * 2**20


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes a query's shuffle files when the query ends, not when the driver happens to collect its garbage.
FILES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared folder; unlike a checkpoint it is
    compressed, read by column, and its size is known to the planner.  Its shuffle files go at once."""
    path = shared_path(df.sparkSession, "llm", name, unique=True)
    conf = df.sparkSession.conf
    before = conf.get(FILES_GO)
    conf.set(FILES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(FILES_GO, before)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made, once nothing that is still to run reads them."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """One object per Python worker process, kept from task to task."""
    store = sys.modules.setdefault("_paylabel_llm_worker", types.ModuleType("_paylabel_llm_worker")).__dict__
    if name not in store:
        store[name] = make()
    return store[name]


def one_thread_per_task() -> None:
    """Spark runs a task per core; a tokenizer's own thread pool would only add to its CPU time."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


class Memo:
    """A bounded memo of two generations: what is still used moves on when the older one is dropped.

    The bound is on a worker's memory only; what a memo no longer holds is computed again.
    """

    def __init__(self, entries: int):
        self.entries, self.new, self.old = entries, {}, {}

    def turn(self) -> None:
        if len(self.new) >= self.entries:
            self.new, self.old = {}, self.new

    def get(self, key: Any) -> Any:
        value = self.new.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.new[key] = value
        return value
