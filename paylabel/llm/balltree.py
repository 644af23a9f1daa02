"""Ranked lexical search: exact inner products found by best-first search of sparse ball trees.

A document's vector holds, for each term of the queries, its weight times its saturated
frequency; a query's vector is one for each of its terms, so the inner product is the score.

1. Documents are read once for a block of queries: how many terms they have, and how often each
   term of the block's queries occurs.  Spark sums the number of documents, all terms, and
   the documents of each query term; from these follow the integer weights.
2. Vectors are dealt by ranges of their heaviest term, copies by their ids, and every TREE_DOCS of them
   become one ball tree: ranges of documents are split by which of two far documents is nearer
   until FANOUT parts or LEAF documents are left.  A node is a range with its centroid and radius.
3. *Bound.*  No document of a node scores above q.c + |q|.r, q being the query on the terms that occur
   under the node.  Radius and bound are widened by more than float rounding can lose, so a
   subtree is left out only if its integer scores must lie below the k-th best.
4. *Best first.*  Each tree's most promising leaf is scored for every query; the k-th best
   of these scores over all trees is a floor that no result lies below.  Then every tree is searched with it:
   nodes leave a heap by falling bound until the bound is below the floor, and documents in leaves are
   scored exactly in 64-bit integers.  Each query's k best of all trees are ranked by Spark.

Queries are taken in blocks of BLOCK_TERMS distinct terms, which bounds what a task holds; a block
reads all documents.

Defined cases: a null text and one without terms is no document and has no score; a null doc_id counts
in the statistics and is not returned; rows that repeat a doc_id are documents each; rows that repeat an
item_id are one query of all their terms; a null item_id is no query; a query without terms,
or an empty table, gives no rows; equal scores are ranked by doc_id; texts are read whole at any length; only the id
and text columns are read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Documents of one tree, documents of a leaf, children of an inner node, and the share (one of so many) that a split leaves at least.
TREE_DOCS, LEAF, FANOUT, LEAST = 8192, 64, 16, 8
#: Distinct terms of the queries that are searched together (memory bound).
BLOCK_TERMS = 40_000
#: Trees that one task builds, about.
TASK_TREES = 16
#: Widening of squared radii (relative to squared norms) and of bounds, far above float64 rounding.
RADIUS_SLACK, BOUND_SLACK = 1e-12, 1e-9

_SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_FOLD = bytes.maketrans(
    bytes([*_SEPARATORS, *range(0x41, 0x5B)]),
    b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B)),
)


def terms_of(text: str | None) -> list[bytes]:
    """The text's terms: runs of ASCII letters, digits and all characters beyond ASCII; A-Z is lower-cased."""
    return (text or "").encode().translate(_FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block(NamedTuple):
    """Queries searched together: items, and each one's terms as numbers of the vocabulary."""

    vocabulary: dict[bytes, int]
    items: list[int]
    terms: list[np.ndarray]


def blocks(queries: DataFrame, item_col: str, text_col: str) -> Iterator[Block]:
    """The queries by item, a block at a time; the driver holds one block."""
    rows = queries.select(F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text")).where("item IS NOT NULL")
    block, last = Block({}, [], []), None
    for row in rows.orderBy("item").toLocalIterator():
        if row.item != last and len(block.vocabulary) >= BLOCK_TERMS:
            yield block
            block = Block({}, [], [])
        numbers = {block.vocabulary.setdefault(t, len(block.vocabulary)) for t in terms_of(row.text)}
        if row.item == last:
            block.terms[-1] = np.union1d(block.terms[-1], np.array(sorted(numbers), np.int64))
        else:
            block.items.append(row.item)
            block.terms.append(np.array(sorted(numbers), np.int64))
        last = row.item
    if block.vocabulary:
        yield block


# -- documents to vectors ----------------------------------------------------------------


def _count(vocabulary: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.get
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in batch.column("text").to_pylist():
                words = terms_of(text)
                sizes.append(len(words))
                found = [i for i in map(number, words) if i is not None]
                at, n = np.unique(np.array(found, np.int32), return_counts=True)
                terms.append(at)
                times.append(n.astype(np.int32))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(t) for t in terms])]), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([np.empty(0, np.int32), *x]))) for x in (terms, times)]
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "times"])

    return run


def _vectors(n_docs: int, n_terms: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weighted vectors, and each one's heaviest term."""
        for batch in batches:
            sizes = batch.column("n").to_pylist()
            lists = batch.column("terms")
            ends = lists.offsets.to_numpy()
            lens, terms = np.diff(ends), lists.flatten().to_numpy()
            tf = batch.column("times").flatten().to_numpy().astype(np.int64)
            m = np.repeat(np.array([10 + (90 * n * n_docs) // n_terms for n in sizes], np.int64), lens)
            values = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            starts = np.cumsum(lens) - lens  # every vector has a term
            top = np.maximum.reduceat(values, starts) if len(values) else values
            first = np.flatnonzero(values == np.repeat(top, lens))
            heaviest = terms[first[np.searchsorted(first, starts)]] if len(values) else terms
            offsets = pa.array(np.append(starts, len(values)), pa.int32())
            columns = [
                batch.column("doc_id"),
                pa.array(heaviest, pa.int32()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(offsets, pa.array(values, pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "heaviest", "terms", "weights"])

    return run


# -- trees -------------------------------------------------------------------------------


class Tree:
    """Vectors in tree order, and nodes as ranges of them; node 0 is the root."""

    def __init__(self, ids: np.ndarray, lens: np.ndarray, terms: np.ndarray, values: np.ndarray, nodes: np.ndarray | None = None):
        self.ids, self.lens, self.terms, self.values = ids, lens, terms, values
        self.nodes = self._build() if nodes is None else nodes  # start, end, first child, children
        self._bounds()

    def _take(self, order: np.ndarray) -> None:
        starts = (np.cumsum(self.lens) - self.lens)[order]
        lens = self.lens[order]
        at = np.repeat(starts - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
        self.ids, self.lens, self.terms, self.values = self.ids[order], lens, self.terms[at], self.values[at]

    def _build(self) -> np.ndarray:
        columns, local = np.unique(self.terms, return_inverse=True)
        starts = np.cumsum(self.lens) - self.lens
        values = self.values.astype(np.float64)
        norms = np.add.reduceat(values * values, starts)

        def entries(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            lens = self.lens[docs]
            begins = np.cumsum(lens) - lens
            return np.repeat(starts[docs] - begins, lens) + np.arange(lens.sum()), begins

        def sides(docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at, begins = entries(docs)

            def dot(doc: int) -> np.ndarray:
                dense = np.zeros(len(columns))
                own = slice(starts[doc], starts[doc] + self.lens[doc])
                dense[local[own]] = values[own]
                return np.add.reduceat(values[at] * dense[local[at]], begins)

            one = docs[np.argmax(norms[docs] - 2 * dot(docs[0]))]
            to_one = dot(one)
            other = docs[np.argmax(norms[docs] - 2 * to_one)]
            nearer = to_one - dot(other) - (norms[one] - norms[other]) / 2
            order = np.argsort(nearer, kind="stable")
            cut = min(max(int((nearer < 0).sum()), len(docs) // LEAST), len(docs) - len(docs) // LEAST)
            return docs[order[:cut]], docs[order[cut:]]

        order, nodes, waiting = [], [[0, len(self.ids), 0, 0]], [(0, np.arange(len(self.ids)))]
        for node, docs in waiting:  # grows while it is walked
            parts = [docs]
            while 2 * len(parts) <= FANOUT and max(map(len, parts)) > LEAF:
                parts = [side for p in parts for side in (sides(p) if len(p) > LEAF else (p,))]
            if len(parts) == 1:
                order.append((nodes[node][0], docs))
                continue
            nodes[node][2:] = [len(nodes), len(parts)]
            start = nodes[node][0]
            for p in parts:
                waiting.append((len(nodes), p))
                nodes.append([start, start + len(p), 0, 0])
                start += len(p)
        self._take(np.concatenate([docs for _, docs in sorted(order, key=lambda x: x[0])]))
        return np.array(nodes, np.int64)

    def _bounds(self) -> None:
        """Dense centroids over the tree's terms, and widened radii."""
        self.columns, self.local = np.unique(self.terms, return_inverse=True)
        self.ends = np.concatenate([[0], np.cumsum(self.lens)])
        values = self.values.astype(np.float64)
        norms = np.add.reduceat(values * values, self.ends[:-1])
        self.centroids = np.zeros((len(self.nodes), len(self.columns)))
        self.radii = np.zeros(len(self.nodes))
        for k, (start, end, *_) in enumerate(self.nodes.tolist()):
            own = slice(self.ends[start], self.ends[end])
            c = np.bincount(self.local[own], values[own], len(self.columns)) / (end - start)
            squared = norms[start:end] + c @ c - 2 * np.add.reduceat(values[own] * c[self.local[own]], self.ends[start:end] - self.ends[start])
            self.centroids[k] = c
            self.radii[k] = math.sqrt(max(squared.max(), 0) + RADIUS_SLACK * (norms[start:end].max() + c @ c))

    def bounds(self, nodes: slice, query: np.ndarray) -> np.ndarray:
        """No document under these nodes scores above."""
        c = self.centroids[nodes, query] if len(query) else np.zeros((nodes.stop - nodes.start, 0))
        most = c.sum(axis=1) + np.sqrt((c > 0).sum(axis=1)) * self.radii[nodes]
        return most * (1 + BOUND_SLACK) + 1

    def scores(self, node: int, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents; ``wanted`` is one for the query's columns, else zero."""
        start, end = self.nodes[node, :2]
        own = slice(self.ends[start], self.ends[end])
        return np.add.reduceat(self.values[own] * wanted[self.local[own]], self.ends[start:end] - self.ends[start])

    def search(self, terms: np.ndarray, k: int, floor: int = 0, leaves: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """ids and scores that hold the k best of at least ``floor`` (above 0), and how many leaves were scored.

        ``leaves`` ends the search after as many leaves: then they are scores of documents, no more.
        """
        at = np.searchsorted(self.columns, terms)
        at = at[at < len(self.columns)]
        query = at[np.isin(self.columns[at], terms)]
        wanted = np.zeros(len(self.columns), np.int64)
        wanted[query] = 1
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        floor, seen = max(floor, 1), 0
        heap = [(-float(self.bounds(slice(0, 1), query)[0]), 0)]
        while heap and seen != leaves:
            bound, node = heapq.heappop(heap)
            if -bound < floor:
                break
            first, n = self.nodes[node, 2:]
            if n:
                for b, child in zip(self.bounds(slice(first, first + n), query), range(first, first + n)):
                    if b >= floor:
                        heapq.heappush(heap, (max(bound, -b), child))
                continue
            seen += 1
            new = self.scores(node, wanted)
            live = new >= floor
            if not live.any():
                continue
            start, end = self.nodes[node, :2]
            ids, scores = np.append(ids, self.ids[start:end][live]), np.append(scores, new[live])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) == k:
                floor = max(floor, int(scores[-1]))
        return ids, scores, seen

    def row(self) -> pa.RecordBatch:
        parts = [self.ids, self.lens.astype(np.int32), self.terms.astype(np.int32), self.values, self.nodes]
        columns = [pa.array([pa.compress(p.tobytes(), codec="zstd", asbytes=True)], pa.binary()) for p in parts]
        sizes = pa.array([[len(self.ids), len(self.values), len(self.nodes)]], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays([sizes, *columns], names=["sizes", *TREE_PARTS])

    @staticmethod
    def read(row: dict) -> Tree:
        docs, entries, nodes = row["sizes"]
        sizes = zip(TREE_PARTS, (docs, docs, entries, entries, 4 * nodes), (np.int64, np.int32, np.int32, np.int64, np.int64))
        get = lambda name, n, kind: np.frombuffer(
            pa.decompress(row[name], decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind
        ).astype(np.int64)
        ids, lens, terms, values, flat = (get(*s) for s in sizes)
        return Tree(ids, lens, terms, values, flat.reshape(-1, 4))


TREE_PARTS = ["ids", "lens", "terms", "weights", "nodes"]
TREE = "sizes array<bigint>, " + ", ".join(f"{p} binary" for p in TREE_PARTS)


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Trees of TREE_DOCS neighbouring vectors."""

    def grown(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        lens = np.concatenate([np.diff(b.column("terms").offsets.to_numpy()) for b in held]).astype(np.int64)
        flat = lambda name: np.concatenate([b.column(name).flatten().to_numpy() for b in held]).astype(np.int64)
        ids = np.concatenate([b.column("doc_id").to_numpy() for b in held])
        return Tree(ids, lens, flat("terms"), flat("weights")).row()

    held, n = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            part = batch.slice(at, TREE_DOCS - n)
            held.append(part)
            at, n = at + part.num_rows, n + part.num_rows
            if n == TREE_DOCS:
                yield grown(held)
                held, n = [], 0
    if n:
        yield grown(held)


def _search(block: Block, k: int, floors: dict[int, int], leaves: int | None):
    items, terms = block.items, block.terms

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tree = Tree.read(row)
                found = [(item, *tree.search(t, k, floors.get(item, 0), leaves)[:2]) for item, t in zip(items, terms)]
                names = np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found])
                ids, scores = (np.concatenate([np.empty(0, np.int64), *(f[c] for f in found)]) for c in (1, 2))
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(ids), pa.array(scores)], names=["item_id", "doc_id", "score"])

    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def trees(docs: DataFrame, block: Block, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents' vectors over the block's terms, as ball trees."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    counted = written(rows.mapInArrow(_count(block.vocabulary), "doc_id bigint, n bigint, terms array<int>, times array<int>"), "balltree_counts")
    totals = counted.where("n > 0").agg(F.count("*").alias("n_docs"), F.sum("n").alias("n_terms")).first()
    # at most one row for each of the block's terms
    df = {r.term: r.df for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()}
    weights = np.array([weight(totals.n_docs, df.get(i, 0)) for i in range(len(block.vocabulary))], np.int64)
    live = counted.where(F.col("doc_id").isNotNull() & (F.size("terms") > 0))
    vectors = live.mapInArrow(
        _vectors(totals.n_docs, totals.n_terms or 1, weights), "doc_id bigint, heaviest int, terms array<int>, weights array<bigint>"
    )
    spread: list[Column] = [F.col("heaviest"), F.xxhash64("doc_id")]
    parts = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(totals.n_docs / (TREE_DOCS * TASK_TREES)))
    dealt = written(vectors, "balltree_vectors").repartitionByRange(parts, *spread).sortWithinPartitions(*spread)
    return written(dealt.select("doc_id", "terms", "weights").mapInArrow(_grow, TREE), "balltree_trees")


def search(docs: DataFrame, queries: DataFrame, k: int = 10, item_col: str = "item_id", query_text: str = "text") -> DataFrame:
    """item_id, rank, doc_id, score: each query's k documents of the highest score above 0."""
    spark, schema = docs.sparkSession, "item_id bigint, doc_id bigint, score bigint"
    out = spark.createDataFrame([], schema)
    for block in blocks(queries, item_col, query_text):
        index = trees(docs, block)
        first = _ranked(index.mapInArrow(_search(block, k, {}, 1), schema), k)
        # at most one row for each query of the block
        floors = {r.item_id: r.score for r in first.where(F.col("rank") == k).collect()}
        found = index.mapInArrow(_search(block, k, floors, None), schema)
        out = out.union(written(_ranked(found, k).select("item_id", "doc_id", "score"), "balltree_found"))
    return _ranked(out, k).select("item_id", "rank", "doc_id", "score")
