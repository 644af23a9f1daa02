"""Word vectors with subwords: unseen words get vectors from the character n-grams they share with known ones.

Words are learnt by Word2Vec on the memos.  An n-gram (of ``<word>``, MIN_N to MAX_N characters, hashed into
``buckets``) has the mean vector of the words that hold it; a word has the mean of its own
vector, if it was learnt, and its n-grams', scaled to unit length; a sentence has the mean of its
words.  All of it is joins on words and buckets and vector sums that are partially aggregated: no
vocabulary is collected or broadcast.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylabel.functions import features as fx
from paylabel.functions.textvec import sentence_vector_from_table, tokens

MIN_N, MAX_N, BUCKETS, DIM = 3, 5, 2_000_000, 300


def ngram_buckets(word: Column, min_n: int = MIN_N, max_n: int = MAX_N, buckets: int = BUCKETS) -> Column:
    """The distinct bucket numbers of a word's character n-grams."""
    marked = F.concat(F.lit("<"), word, F.lit(">"))

    def of_length(n: int) -> Column:
        starts = F.when(F.length(marked) >= n, F.sequence(F.lit(1), F.length(marked) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.substring(marked, i, F.lit(n))), F.lit(buckets)))

    return F.array_distinct(F.concat(*[of_length(n) for n in range(min_n, max_n + 1)]))


def _mean(rows: DataFrame, by: str, vector: str = "vector") -> DataFrame:
    """Mean vector per key, summed where the rows lie first."""
    mean = rows.groupBy(by).agg(Summarizer.mean(array_to_vector(vector)).alias("m"))
    return mean.select(by, vector_to_array("m").alias("vector"))


def ngram_vectors(words: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(bucket, vector)``: the mean of the vectors of the words that hold an n-gram; ``words`` is (word, vector)."""
    return _mean(words.select(F.explode(ngram_buckets(F.col("word"), buckets=buckets)).alias("bucket"), "vector"), "bucket")


def word_vectors(vocabulary: DataFrame, words: DataFrame, ngrams: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """``(word, vector)`` of unit length for every word of ``vocabulary`` that was learnt or shares an n-gram with one that was."""
    asked = vocabulary.select("word").distinct()
    parts = asked.select("word", F.explode(ngram_buckets(F.col("word"), buckets=buckets)).alias("bucket")).join(ngrams, "bucket").select("word", "vector")
    own = asked.join(words, "word").select("word", "vector")
    return _mean(parts.unionByName(own), "word").select("word", fx.l2_normalize("vector").alias("vector"))


def sentence_vectors(docs: DataFrame, id_col: str, text_col: str, table: DataFrame, dim: int = DIM) -> DataFrame:
    """``id_col, text_vec``: the mean over a text's words (a word without a vector counts as zero); zeros for no word."""
    return sentence_vector_from_table(docs, id_col, text_col, table, dim)


def fit_words(docs: DataFrame, text_col: str, dim: int = DIM, min_count: int = 1, iterations: int = 1, seed: int = 42) -> DataFrame:
    """``(word, vector)`` learnt by Word2Vec on the texts' words."""
    from pyspark.ml.feature import Word2Vec

    corpus = docs.select(tokens(text_col).alias("tok"))
    model = Word2Vec(vectorSize=dim, minCount=min_count, inputCol="tok", outputCol="v", seed=seed, maxIter=iterations).fit(corpus)
    return model.getVectors().select("word", vector_to_array("vector").alias("vector"))
