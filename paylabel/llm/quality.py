"""Quality classifier: histogram gradient-boosted trees over document statistics.

Every whole text becomes a row of statistics (byte classes, words, lines).  The trees are
fitted on the driver to at most FIT_ROWS labelled rows (a documented bound; the rows with
the smallest id hashes): features are cut into BINS quantile bins, and each level of a tree
is grown from histograms of gradients.  The trees are flattened into arrays and
scoring walks all trees of all rows of a batch at once, in numpy, where the documents lie.

Defined cases: a null text is empty, and an empty text has all statistics zero and gets a
score like any other; null labels and labels of unknown documents are not learnt from; a
document labelled twice counts with its lower label; without labelled rows every score is
0.5; repeated rows score alike; an empty table gives no rows; other columns are not read
(``score``) or pass through (``accepted``).  Labels, lang, source and doc_id never enter
a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FIT_ROWS = 20_000
BINS, TREES, DEPTH, RATE, L2, LEAST_HESSIAN = 64, 60, 4, 0.15, 1.0, 2.0
THRESHOLD = 0.3

# Frequent function words of the corpus languages.
FUNCTION_WORDS = frozenset(
    "a and are as at be by for from in is it of on or that the this to was with "
    "au avec dans de des du en est et la le les par pas pour que qui sur un une "
    "als auf das dem den der des die ein eine für ich im in ist mit nicht sich und von zu "
    "al como con de del el en la las los no para por que se su un una y".split()
)


def _classes() -> np.ndarray:
    """256 x 10 indicator of byte classes."""
    c = np.zeros((256, 10))
    c[ord("a") : ord("z") + 1, 0] = 1
    c[ord("A") : ord("Z") + 1, 1] = 1
    c[ord("0") : ord("9") + 1, 2] = 1
    c[[32, 9], 3] = 1
    c[[10, 13], 4] = 1
    c[[ord(x) for x in ".,;:"], 5] = 1
    c[[ord(x) for x in "!?"], 6] = 1
    c[[ord(x) for x in "|/\\_=-+<>[]{}()"], 7] = 1
    c[[ord(x) for x in "#$%&*@^~`"], 8] = 1
    c[128:, 9] = 1
    return c


CLASSES = _classes()
FEATURES = 31


def statistics(text: str | None) -> list[float]:
    """The document statistics that the trees see."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * FEATURES
    n = len(raw)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = (counts @ CLASSES / n).tolist()
    p = counts[counts > 0] / n
    entropy = float(-(p * np.log2(p)).sum())
    words = raw.split()
    if not words:
        return [np.log1p(n), *shares, entropy, *[0.0] * (FEATURES - 12)]
    m = len(words)
    lengths = np.fromiter(map(len, words), np.int64, m)
    seen = Counter(words)
    top = max(seen.values()) / m
    repeats = sum(map(bytes.__eq__, words, words[1:])) / m
    pairs = len(set(zip(words, words[1:]))) / max(1, m - 1)
    plain = common = upper = title = ended = 0
    for w, k in seen.items():
        common += k * (w.lower().decode() in FUNCTION_WORDS)
        plain += k * w.isalpha()
        upper += k * (w.isupper() and len(w) > 1)
        title += k * w[:1].isupper()
        ended += k * (w[-1:] in b".!?")
    lines = raw.split(b"\n")
    distinct = set(lines)
    line_lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    half = words[m // 2 :]
    return [
        np.log1p(n),
        *shares,
        entropy,
        np.log1p(m),
        float(lengths.mean()),
        float(lengths.std()),
        np.log1p(float(lengths.max())),
        float((lengths <= 2).mean()),
        float((lengths == 1).mean()),
        len(seen) / m,
        len(seen) / m**0.5,
        top,
        repeats,
        pairs,
        common / m,
        plain / m,
        upper / m,
        title / m,
        ended / m,
        np.log1p(len(lines)),
        len(distinct) / len(lines),
        float(np.log1p(line_lengths.mean())),
        len(set(half)) / len(half),
    ][:FEATURES]


class Trees:
    """Boosted trees, flattened: one row per tree, one column per node of a complete binary tree."""

    def __init__(self, base: float, feature: np.ndarray, threshold: np.ndarray, value: np.ndarray):
        self.base, self.feature, self.threshold, self.value = base, feature, threshold, value

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1; rows that are not above a node's threshold go left."""
        margin = np.full(len(x), self.base)
        row = np.arange(len(x))[:, None]
        tree = np.arange(len(self.feature))[None, :]
        if len(self.feature):
            node = np.zeros((len(x), len(self.feature)), np.int64)
            for _ in range(DEPTH):
                right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
                node = 2 * node + 1 + right
            margin = margin + self.value[tree, node].sum(axis=1)
        return 1 / (1 + np.exp(-margin))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1])) for column in x.T]


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Histogram gradient boosting of the logistic loss."""
    nodes, inner = 2 ** (DEPTH + 1) - 1, 2**DEPTH - 1
    if not len(x) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Trees(float(np.log(rate / (1 - rate))), np.zeros((0, nodes), np.int64), np.zeros((0, nodes)), np.zeros((0, nodes)))
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
    n, d = x.shape
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, threshold, value = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        node = np.zeros(n, np.int64)
        for first in (2**level - 1 for level in range(DEPTH)):
            width = first + 1
            place = node - first
            best = np.full(width, 1e-6)
            for f in range(d):
                at = place * BINS + binned[:, f]
                hg = np.bincount(at, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hh = np.bincount(at, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                tg, th = hg[:, -1:], hh[:, -1:]
                gain = hg**2 / (hh + L2) + (tg - hg) ** 2 / (th - hh + L2) - tg**2 / (th + L2)
                gain[(hh < LEAST_HESSIAN) | (th - hh < LEAST_HESSIAN)] = 0
                gain[:, len(edges[f]) :] = 0
                cut = gain.argmax(axis=1)
                top = gain[np.arange(width), cut]
                for i in np.flatnonzero(top > best):
                    best[i] = top[i]
                    feature[first + i], threshold[first + i] = f, edges[f][cut[i]]
            right = x[np.arange(n), feature[node]] > threshold[node]
            node = 2 * node + 1 + right
        leaf_g, leaf_h = np.bincount(node, g, nodes), np.bincount(node, h, nodes)
        value[inner:] = -RATE * leaf_g[inner:] / (leaf_h[inner:] + L2)
        margin = margin + value[node]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(base, np.array(features), np.array(thresholds), np.array(values))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _stat_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        stats = [statistics(t) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"), pa.array(stats, pa.list_(pa.float64()))], names=["doc_id", "quality", "stats"]
        )


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit on labelled documents that are not held out; at most ``fit_rows`` reach the driver."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    known = known.where(~held_out(F.col("doc_id")) & F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # fit_rows ids at most
    rows = rows.mapInArrow(_stat_rows, "doc_id bigint, quality int, stats array<double>")
    # partial aggregates leave one row per document before anything is shuffled
    rows = rows.groupBy("doc_id").agg(F.max(F.struct("stats", "quality")).alias("r")).select("doc_id", "r.*").orderBy("doc_id").collect()
    x = np.array([r["stats"] for r in rows], float).reshape(-1, FEATURES)
    y = np.array([float(r["quality"] > 0) for r in rows])
    return fit(x, y)


def score(docs: DataFrame, trees: Trees, score_col: str = "score") -> DataFrame:
    """docs with a score column; every other column passes through (one of the same name is replaced)."""
    names = [n for n in docs.columns if n != score_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(trees.score(x))], names=[*names, score_col])

    fields = [docs.schema[n] for n in names]
    return docs.select(*names).mapInArrow(run, T.StructType([*fields, T.StructField(score_col, T.DoubleType(), False)]))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier does not reject, with the columns of docs."""
    trees, names = train(docs, labels), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t) for t in batch.column("text").to_pylist()], float).reshape(-1, FEATURES)
            yield batch.filter(pa.array(trees.score(x) >= threshold))

    return docs.select(*names).mapInArrow(run, docs.schema)
