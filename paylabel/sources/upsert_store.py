"""A table of rows by key that is upserted batch by batch, without rewriting what a batch does not touch.

Rows lie in hash buckets of their key.  A batch writes its own rows once, one folder per bucket it touches; a
manifest, published as one new file that no other writer can have published, lists the live
folders and in which order they came.  A reader takes the newest manifest: of a key's rows those of the last
batch that has the key count, as if that batch had dropped the older ones.  A bucket with more than
``max_parts`` live folders is compacted into one while the batch is published; other buckets stay as they are.

A writer that dies before publishing leaves folders that no manifest names: readers never see them,
and ``vacuum`` removes what compaction superseded, and with ``strays`` them too.  A writer that finds its version taken
reads the newer manifest and publishes on top of it; its rows need not be written again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Buckets of a new store, live folders of one bucket, and manifests that vacuum keeps readable.
BUCKETS, MAX_PARTS, KEPT_VERSIONS = 16, 6, 2


@dataclass
class Manifest:
    """Version, key and the live folders: (batch, order, bucket)."""

    version: int
    key: str
    buckets: int
    parts: list[tuple[str, int, int]] = field(default_factory=list)

    def of_bucket(self, bucket: int) -> list[tuple[str, int, int]]:
        return [p for p in self.parts if p[2] == bucket]


class UpsertStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # -- files through Hadoop's file systems -----------------------------------------------

    def _path(self, *parts: str) -> Any:
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self) -> Any:
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def _read(self, *parts: str) -> str:
        jvm = self.spark.sparkContext._jvm
        stream = self._fs().open(self._path(*parts))
        try:
            return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _publish(self, text: str, name: str) -> bool:
        """Make the file appear whole under its name, or return False if another one has it."""
        jvm, gateway = self.spark.sparkContext._jvm, self.spark.sparkContext._gateway
        draft = self._path("manifests", f"_draft-{uuid.uuid4().hex}")
        out = self._fs().create(draft, True)
        out.write(bytearray(text.encode()))
        out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(draft, self._path("manifests", name), gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        except Exception as error:  # py4j wraps the exception of a taken name
            self._fs().delete(draft, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    # -- manifests ---------------------------------------------------------------------------

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self._names("manifests") if n.startswith("v") and n.endswith(".json")]

    def manifest(self, version: int | None = None) -> Manifest | None:
        if version is None:
            versions = self.versions()
            if not versions:
                return None
            version = versions[-1]
        found = json.loads(self._read("manifests", f"v{version:09d}.json"))
        return Manifest(version, found["key"], found["buckets"], [tuple(p) for p in found["parts"]])

    # -- rows --------------------------------------------------------------------------------

    def _rows(self, parts: list[tuple[str, int, int]], key: str) -> DataFrame:
        """The rows that count of some whole buckets."""
        paths = [f"{self.root}/rows/batch={batch}/bucket={bucket}" for batch, _, bucket in parts]
        rows = self.spark.read.option("basePath", f"{self.root}/rows").option("mergeSchema", True).parquet(*paths)
        order = {batch: at for batch, at, _ in parts}
        if len({b for _, _, b in parts}) == len(parts):  # one folder a bucket: nothing to merge
            return rows.drop("batch", "bucket")
        orders = self.spark.createDataFrame(list(order.items()), "batch string, _order int")
        rows = rows.join(F.broadcast(orders), "batch")  # one row per live batch
        newest = rows.groupBy(F.col(key).alias("_key")).agg(F.max("_order").alias("_newest"))
        counts = rows[key].eqNullSafe(newest["_key"]) & (rows["_order"] == newest["_newest"])
        return rows.join(newest, counts, "left_semi").drop("batch", "bucket", "_order")

    def rows(self, version: int | None = None) -> DataFrame | None:
        """The upserted rows, or None if nothing was ever published."""
        m = self.manifest(version)
        if m is None or not m.parts:
            return None
        crowded = {b for _, _, b in m.parts if len(m.of_bucket(b)) > 1}
        plain, merged = ([p for p in m.parts if (p[2] in crowded) == side] for side in (False, True))
        found = [self._rows(some, m.key) for some in (plain, merged) if some]
        return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)

    def write_rows(self, rows: DataFrame, key: str, buckets: int) -> tuple[str, list[int]]:
        """Write a batch that nobody sees yet: its name and the buckets it touches."""
        batch = uuid.uuid4().hex
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))
        dealt.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/rows/batch={batch}")
        return batch, sorted(int(n.split("=")[1]) for n in self._names("rows", f"batch={batch}") if n.startswith("bucket="))

    def upsert(self, rows: DataFrame, key: str, buckets: int = BUCKETS, max_parts: int = MAX_PARTS) -> int:
        """Rows whose key is in ``rows`` are replaced by them, all others stay; returns the new version."""
        m = self.manifest()
        batch, touched = self.write_rows(rows, key, m.buckets if m else buckets)
        return self.publish(batch, touched, key, m.buckets if m else buckets, max_parts)

    def publish(self, batch: str, touched: list[int], key: str, buckets: int, max_parts: int = MAX_PARTS) -> int:
        while True:
            m = self.manifest() or Manifest(0, key, buckets)
            if (m.key, m.buckets) != (key, buckets):
                raise ValueError(f"the store is keyed by {m.key} in {m.buckets} buckets, not by {key} in {buckets}")
            order = 1 + max((at for _, at, _ in m.parts), default=0)
            parts = m.parts + [(batch, order, b) for b in touched]
            crowded, merged = {b for b in touched if sum(p[2] == b for p in parts) > max_parts}, None
            if crowded:
                merged, found = self.write_rows(self._rows([p for p in parts if p[2] in crowded], key), key, buckets)
                parts = [p for p in parts if p[2] not in crowded] + [(merged, order, b) for b in found]
            text = json.dumps({"key": key, "buckets": buckets, "parts": parts})
            if self._publish(text, f"v{m.version + 1:09d}.json"):
                self._remove({(batch, b) for b in crowded})  # merged before any manifest named them
                return m.version + 1
            if merged:
                self._remove({(merged, b) for b in found})

    def vacuum(self, keep: int = KEPT_VERSIONS, strays: bool = False) -> int:
        """Remove folders that older manifests name and the last ``keep`` do not, and those manifests; with ``strays`` also
        folders that no manifest names, which is not safe while another writer is at work.  Returns how many were removed."""
        versions = self.versions()
        named = {v: {(batch, bucket) for batch, _, bucket in self.manifest(v).parts} for v in versions}
        live = set().union(*(named[v] for v in versions[-keep:]))
        dead = set().union(*(named[v] for v in versions[:-keep])) - live
        if strays:
            for batch in self._names("rows"):
                found = {(batch.split("=")[1], int(n.split("=")[1])) for n in self._names("rows", batch) if n.startswith("bucket=")}
                dead |= found - live
        self._remove(dead)
        for v in versions[:-keep]:
            self._fs().delete(self._path("manifests", f"v{v:09d}.json"), False)
        return len(dead)

    def _remove(self, folders: set[tuple[str, int]]) -> None:
        fs = self._fs()
        for batch, bucket in folders:
            fs.delete(self._path("rows", f"batch={batch}", f"bucket={bucket}"), True)
        for batch in {b for b, _ in folders}:
            if not any(n.startswith("bucket=") for n in self._names("rows", f"batch={batch}")):
                fs.delete(self._path("rows", f"batch={batch}"), True)
