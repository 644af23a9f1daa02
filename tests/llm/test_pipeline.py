"""The pipeline's stages on a small table, and the registered queries on the smallest one."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    good = [" ".join(word() for _ in range(80)) for _ in range(120)]
    junk = [" ".join(word().upper() + "!!" for _ in range(80)) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(good + junk)] + [(300, good[4]), (301, good[5] + " " + word()), (7, good[7]), (None, good[9])]
    rows += [(302, good[10] + " password=0123456789abcdef0123")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, n int")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(240)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns, name
    rows = {r.doc_id: r for r in docs.collect()}
    assert not set(range(120, 240)) & set(rows) and 300 not in rows and 301 not in rows
    assert set(range(120)) <= set(rows) and docs.where("doc_id = 7").count() == 1 and None in rows
    assert all("password=" not in r.text and r.n_chars == len(r.text) for r in rows.values())
    packed = corpus_pipeline.packing_stage(spark, docs, folder)
    assert packed.agg(F.countDistinct("doc_id")).first()[0] == len(rows) - 1


def test_run_gives_packed_pieces(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() >= 120


def test_queries_are_registered():
    names = set(entry.queries())
    assert {"pipeline"} <= names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
