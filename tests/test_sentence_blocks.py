"""Sentence vectors by blocks of documents: repeated and missing ids, words without a vector, several blocks."""

import pytest
from pyspark.sql import functions as F

from paylabel.functions.subword import sentence_vectors
from paylabel.functions.textvec import sentence_vector_from_table


@pytest.mark.parametrize("block_docs", [1, 3, 4096])
def test_means_by_block(spark, block_docs):
    docs = spark.createDataFrame([("a", "x y x"), ("b", "z"), ("c", None), ("d", "q q"), ("d", "x"), (None, "x")], "i string, t string")
    table = spark.createDataFrame([("x", [1.0, 2.0]), ("y", [4.0, 0.0]), ("z", [0.0, 8.0]), ("z", [1.0, 1.0])], "word string, vector array<double>")
    got = sorted((str(r.i), list(r.text_vec)) for r in sentence_vector_from_table(docs, "i", "t", table, 2, block_docs).collect())
    # the two rows of d share the sum of their words, each divided by its own number of them
    assert got == [("None", [0.0, 0.0]), ("a", [2.0, 4 / 3]), ("b", [1.0, 9.0]), ("c", [0.0, 0.0]), ("d", [0.5, 1.0]), ("d", [1.0, 2.0])]


def test_nothing_is_broadcast(spark):
    docs = spark.range(50).select("id", F.lit("x y").alias("t"))
    table = spark.createDataFrame([("x", [1.0] * 300)], "word string, vector array<double>")
    out = sentence_vectors(docs, "id", "t", table)
    assert out.count() == 50 and "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
