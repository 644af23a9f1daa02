"""Hashed sentence vectors come from batches, bit for bit what the column form gives."""

from pyspark.sql import functions as F

from paylabel.functions import textvec


def test_batches_equal_columns_and_plan_stays_small(spark):
    texts = [None, "", "  ", "một hai ba", "ba ba ba", "a\tb\nc", "x", "😀 ﬁ đ " + "w " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, msg string").repartition(3)
    for dim in (5, 16, 300):
        out = textvec.with_hashed_sentence_vector(df, "msg", dim, "v")
        assert len(out._jdf.queryExecution().optimizedPlan().toString()) < 2000  # not one expression per dimension
        parts = F.transform(textvec.tokens("msg"), lambda t: textvec.token_vector(t, dim))
        zero = F.array_repeat(F.lit(0.0), dim)
        total = F.aggregate(parts, zero, lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
        n = F.greatest(F.size(textvec.tokens("msg")), F.lit(1))
        want = df.select("i", F.transform(total, lambda x: x / n).alias("v"))
        assert sorted(map(tuple, out.select("i", "v").collect())) == sorted(map(tuple, want.collect()))


def test_slices_of_a_batch():
    import pyarrow as pa

    lists = pa.array([["a", "b", "c"], [], ["a"], ["b"] * 7, ["c", "a"]], pa.list_(pa.string()))
    whole = textvec._mean_vectors(lists, 4)
    assert (whole[1] == 0).all() and (whole[0] != 0).all()
    assert (textvec._mean_vectors(lists.slice(2), 4) == whole[2:]).all()
