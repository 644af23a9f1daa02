"""The upsert store against a dictionary: batches, compaction, dead and racing writers, bytes written."""

import random

import pytest
from pyspark.sql import functions as F

from paylabel.session import shared_path
from paylabel.sources.upsert_store import UpsertStore


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, v double")


def content(store, version=None):
    return sorted(map(tuple, store.rows(version).select("k", "n", "v").collect()))


def size(store, *parts):
    fs = store._fs()
    path = store._path(*parts)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def test_upserts_equal_a_dictionary(spark):
    store, rnd, want = UpsertStore(spark, shared_path(spark, "t", "upsert", unique=True)), random.Random(3), {}
    assert store.rows() is None and store.manifest() is None
    for step in range(9):
        keys = {f"k{rnd.randrange(60)}" for _ in range(25 if step % 3 else 3)}
        new = {k: [(k, i, float(step)) for i in range(rnd.randrange(1, 4))] for k in keys}
        want |= new
        assert store.upsert(frame(spark, [r for rows in new.values() for r in rows]), "k", buckets=4, max_parts=3) == step + 1
        assert content(store) == sorted(r for rows in want.values() for r in rows)
    m = store.manifest()
    assert all(len(m.of_bucket(b)) <= 3 for b in range(4)) and len({p[0] for p in m.parts}) < 9  # compacted
    before = content(store)
    assert store.vacuum() > 0 and content(store) == before and len(store.versions()) == 2
    live = {p[0] for v in store.versions() for p in store.manifest(v).parts}
    assert {n.split("=")[1] for n in store._names("rows")} == live


def test_a_writer_that_dies_is_never_seen(spark):
    store = UpsertStore(spark, shared_path(spark, "t", "upsert", unique=True))
    store.upsert(frame(spark, [("a", 1, 1.0), ("b", 1, 1.0)]), "k", buckets=2)
    store.write_rows(frame(spark, [("a", 9, 9.0), ("c", 9, 9.0)]), "k", 2)  # and no manifest
    assert content(store) == [("a", 1, 1.0), ("b", 1, 1.0)]
    store.upsert(frame(spark, [("b", 2, 2.0)]), "k")
    assert content(store) == [("a", 1, 1.0), ("b", 2, 2.0)]
    assert store.vacuum() == 0 and store.vacuum(strays=True) >= 1 and content(store) == [("a", 1, 1.0), ("b", 2, 2.0)]


def test_a_taken_version_is_published_on_top(spark, monkeypatch):
    root = shared_path(spark, "t", "upsert", unique=True)
    one, two = UpsertStore(spark, root), UpsertStore(spark, root)
    one.upsert(frame(spark, [("a", 1, 1.0)]), "k", buckets=2)
    old = two.manifest()
    stale = [old]  # the second writer still holds the old manifest when the first one has published again
    monkeypatch.setattr(two, "manifest", lambda version=None: stale.pop() if version is None and stale else UpsertStore.manifest(two, version))
    batch, touched = two.write_rows(frame(spark, [("c", 3, 3.0)]), "k", 2)
    one.upsert(frame(spark, [("b", 2, 2.0)]), "k")
    assert two.publish(batch, touched, "k", 2) == 3
    assert content(one) == [("a", 1, 1.0), ("b", 2, 2.0), ("c", 3, 3.0)] and content(one, 2) == [("a", 1, 1.0), ("b", 2, 2.0)]


def test_bytes_follow_the_batch(spark):
    store = UpsertStore(spark, shared_path(spark, "t", "upsert", unique=True))
    many = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("n"), F.rand(1).alias("v"))
    store.upsert(many, "k")
    whole = size(store, "rows")
    store.upsert(frame(spark, [("k7", 2, 0.5), ("new", 2, 0.5)]), "k")
    assert size(store, "rows") - whole < whole / 20
    assert store.rows().count() == 40_001 and store.rows().where("k = 'k7'").count() == 1


def test_another_key_is_an_error(spark):
    store = UpsertStore(spark, shared_path(spark, "t", "upsert", unique=True))
    store.upsert(frame(spark, [("a", 1, 1.0)]), "k")
    with pytest.raises(ValueError, match="keyed by"):
        store.upsert(frame(spark, [("a", 1, 1.0)]), "n")
