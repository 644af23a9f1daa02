"""Sentence vectors of memo text.

The reference averages pretrained 300-d word vectors.  Two Spark forms:

* ``with_hashed_sentence_vector`` — every token gets a deterministic
  pseudo-random vector from ``sha256(token#c)`` (16 dimensions per digest) and
  the sentence is their mean; computed batch by batch, no lookup table,
  reproducible in SQL (oracle-checked).
* ``sentence_vector_from_table`` — deal documents into blocks, join each block's distinct
  words with any word-vector table ``(word, vector)`` (for example
  ``Word2VecModel.getVectors()``) and average; the vocabulary is never broadcast.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylabel.functions import features as fx


def tokens(text: str | Column) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(fx.fill_text(t), r"\s+"), lambda s: s != F.lit(""))


# dimension d of a token's vector uses hex digits [4*(d % 16), +4) of
# sha256(token + '#' + d // 16): one hash serves 16 dimensions
DIMS_PER_HASH = 16


def token_hashes(token: Column, dim: int) -> Column:
    """The sha256 hex digests a token needs for ``dim`` dimensions."""
    n = (dim + DIMS_PER_HASH - 1) // DIMS_PER_HASH
    return F.array(*[F.sha2(F.concat(token, F.lit(f"#{c}")), 256) for c in range(n)])


def dim_value_from_hashes(hashes: Column, d: int) -> Column:
    """Value in [-1, 1] of dimension ``d`` from a token's digests."""
    h = F.element_at(hashes, d // DIMS_PER_HASH + 1)
    v = F.conv(F.substring(h, 4 * (d % DIMS_PER_HASH) + 1, 4), 16, 10).cast("double")
    return v / F.lit(65535.0) * F.lit(2.0) - F.lit(1.0)


def token_vector(token: Column, dim: int) -> Column:
    hashes = token_hashes(token, dim)
    return F.array(*[dim_value_from_hashes(hashes, d) for d in range(dim)])


def _word_values(words: pa.Array, dim: int) -> np.ndarray:
    """The hashed vectors of some words, one row each: what ``token_vector`` gives."""
    hashes = range((dim + DIMS_PER_HASH - 1) // DIMS_PER_HASH)
    raw = b"".join(hashlib.sha256(w + b"#%d" % c).digest() for w in words.cast(pa.binary()).to_pylist() for c in hashes)
    return np.frombuffer(raw, ">u2").reshape(len(words), len(hashes) * DIMS_PER_HASH)[:, :dim] / 65535.0 * 2.0 - 1.0


def _mean_vectors(lists: pa.ListArray, dim: int) -> np.ndarray:
    """Mean of each list's word vectors, added in the order of the words; zeros for an empty list."""
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    starts, lens = offsets[:-1], np.diff(offsets)
    coded = lists.flatten().dictionary_encode()  # a batch hashes each of its words once
    values, codes = _word_values(coded.dictionary, dim), coded.indices.to_numpy(zero_copy_only=False)
    out = np.zeros((len(lens), dim))
    # the k-th words of all texts that have so many, then the next ones: the order in which Spark SQL's fold adds
    rows, k = np.flatnonzero(lens), 0
    while len(rows):
        out[rows] += values[codes[starts[rows] + k]]
        k += 1
        rows = rows[lens[rows] > k]
    return out / np.maximum(lens, 1)[:, None]


def with_hashed_sentence_vector(df: DataFrame, text: str, dim: int, out: str) -> DataFrame:
    """Adds ``out`` = mean of the tokens' hashed vectors (zeros for no token).

    Spark splits the texts; a batch of rows gives its words to numpy, which takes the same
    digests and values as ``token_vector`` and adds them in the same order.  As column
    expressions each dimension would parse its hex digits for every row.
    """

    def run(lists: pa.Array) -> pa.Array:
        mean = _mean_vectors(lists, dim)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(mean) + 1, dtype=np.int32) * dim), pa.array(mean.ravel()))

    return df.withColumn(out, F.arrow_udf(run, "array<double>")(tokens(text)))


def hashed_word_table(docs: DataFrame, text_col: str, dim: int) -> DataFrame:
    """``(word, vector)`` for every distinct token of a text column."""
    words = docs.select(F.explode(tokens(text_col)).alias("word")).distinct()
    return words.select("word", token_vector(F.col("word"), dim).alias("vector"))


#: Documents of one block, about.
BLOCK_DOCS = 4096


def _mean_words(id_col: str, dim: int):
    """A block's documents and its words' vectors -> the mean vector of every document."""

    def run(docs: pa.Table, sent: pa.Table) -> pa.Table:
        ids, lists = docs.column(id_col).combine_chunks(), docs.column("words").combine_chunks()
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        starts, lens = offsets[:-1], np.diff(offsets)
        known = sent.column("word").combine_chunks().dictionary_encode()
        values = np.zeros((len(known.dictionary) + 1, dim))  # the last one: words without a vector
        if len(known):
            given = sent.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(known), -1)
            np.add.at(values, known.indices.to_numpy(), given[:, :dim])
        codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=known.dictionary), len(known.dictionary)).to_numpy()
        total = np.zeros((len(lens), dim))
        rows, k = np.flatnonzero(lens), 0
        while len(rows):
            total[rows] += values[codes[starts[rows] + k]]
            k += 1
            rows = rows[lens[rows] > k]
        named = ids.is_valid().to_numpy(zero_copy_only=False)
        same = ids.dictionary_encode()
        if named.any() and len(same.dictionary) < named.sum():  # rows of one id share their words
            at = same.indices.to_numpy(zero_copy_only=False)[named].astype(np.int64)
            sums = np.zeros((len(same.dictionary), dim))
            np.add.at(sums, at, total[named])
            total[named] = sums[at]
        total[~named] = 0.0  # and a row without an id has none
        mean = total / np.maximum(lens, 1)[:, None]
        return pa.table([ids, pa.ListArray.from_arrays(pa.array(np.arange(len(mean) + 1, dtype=np.int32) * dim), pa.array(mean.ravel()))], names=[id_col, "text_vec"])

    return run


def sentence_vector_from_table(docs: DataFrame, id_col: str, text_col: str, table: DataFrame, dim: int, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``id_col, text_vec``: the mean of the word vectors of each document's tokens (a word without one counts as zero).

    Documents are dealt by id into blocks, and every block gets the vectors of its own distinct words:
    a vector travels once per block and word, not once per token, and no vocabulary or table of
    documents is broadcast on a guess of its size.
    """
    n = max(1, -(-docs.count() // block_docs))
    dealt = docs.select(F.col(id_col), tokens(text_col).alias("words"), F.pmod(F.xxhash64(id_col), F.lit(n)).cast("int").alias("block"))
    asked = dealt.select(F.col("block").alias("to"), F.explode("words").alias("word")).distinct()
    sent = asked.join(table.select("word", "vector").hint("merge"), "word").select("to", "word", "vector")
    out = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("text_vec", T.ArrayType(T.DoubleType()))])
    return dealt.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(_mean_words(id_col, dim), out)
