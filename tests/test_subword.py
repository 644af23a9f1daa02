"""Subword vectors against brute force; unseen words get vectors near their relatives."""

import numpy as np
from pyspark.sql import functions as F

from paylabel.functions import subword


def grams(word, buckets):
    marked = f"<{word}>"
    return {marked[i : i + n] for n in range(3, 6) for i in range(len(marked) - n + 1)}


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(1)
    words = {w: rng.normal(size=4) for w in ["transfer", "transfers", "rent", "lunch", "a", "tiền", "日本"]}
    table = spark.createDataFrame([(w, [float(x) for x in v]) for w, v in words.items()], "word string, vector array<double>")
    ngrams = subword.ngram_vectors(table)
    asked = ["transfer", "transferred", "zzz", "a", "tiền", "rents"]
    got = {r.word: np.array(r.vector) for r in subword.word_vectors(spark.createDataFrame([(w,) for w in asked + asked], "word string"), table, ngrams).collect()}
    holders = {}
    for w in words:
        for g in grams(w, None):
            holders.setdefault(g, []).append(words[w])
    for w in asked:
        parts = [np.mean(holders[g], axis=0) for g in grams(w, None) if g in holders] + ([words[w]] if w in words else [])
        if not parts:
            assert w not in got
            continue
        want = np.mean(parts, axis=0)
        assert np.allclose(got[w], want / np.linalg.norm(want), atol=1e-9), w
    assert "transferred" in got and got["transferred"] @ got["transfer"] > got["transferred"] @ got["rents"]
    docs = spark.createDataFrame([(1, "transfer  rents"), (2, ""), (3, None), (4, "zzz a a")], "id int, msg string")
    sentence = {r.id: np.array(r.text_vec) for r in subword.sentence_vectors(docs, "id", "msg", spark.createDataFrame([(w, [float(x) for x in v]) for w, v in got.items()], "word string, vector array<double>"), 4).collect()}
    assert np.allclose(sentence[1], (got["transfer"] + got["rents"]) / 2) and np.allclose(sentence[4], 2 * got["a"] / 3)
    assert not sentence[2].any() and not sentence[3].any()


def test_learnt_words_cover_all_memos(spark):
    docs = spark.createDataFrame([(i, f"pay rent {i % 7} lunch") for i in range(60)], "id int, msg string")
    words = subword.fit_words(docs, "msg", dim=12)
    assert words.where(F.size("vector") != 12).count() == 0
    table = subword.word_vectors(docs.select(F.explode(F.split("msg", " ")).alias("word")), words, subword.ngram_vectors(words))
    assert table.count() == 10 and abs(table.select(F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("n")).agg(F.min("n")).first()[0] - 1) < 1e-9
