"""Truncated factorisation of every date's sender x recipient matrix, all dates in the same jobs.

Randomised subspace iteration on the sparse edges: a thin matrix of ``width`` columns per
(date, recipient) is multiplied by A and by its transpose.  The edges are dealt once by date and a hash of the
sender into blocks of about ``BLOCK_EDGES``, with all edges of a sender and date in one block.  A
round sends each block the vectors of its own recipients; the block multiplies by A and by its transpose and
gives back one vector per recipient, and these are summed.  Neither an edge nor a sender's vector
travels.  Between rounds the vectors are made orthonormal by their
``width`` x ``width`` Gram matrix per date.  Only these matrices reach the driver: their size is
dates x width^2 and does not follow the rows.  In the end the Gram matrix of A times the vectors
gives the singular values and the rotation to the singular vectors (Rayleigh-Ritz).

A date of any size goes this way.  Where a date's smaller side has at most ``width`` members the
result is the full decomposition; else it is the leading part, and ``rounds`` says how well it
separates from the rest.  Start vectors are hashes of the recipients, so results repeat.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylabel.session import written

#: Columns of the block beyond the wanted rank, and multiplications by A and its transpose.
OVERSAMPLE, ROUNDS = 16, 3
#: Edges of one block, about (more only if one sender has more on one date), and doubles of a product that is held at a time.
BLOCK_EDGES, HELD = 131_072, 4_000_000
#: Squared singular values below this share of the largest one count as zero: what a Gram matrix in float64 can tell.
ZERO = 1e-13


@dataclass
class Factors:
    """``vectors``: snapshot_date, recipient_canon_id, svd_vec (V times the root of S, padded with zeros);
    ``values``: snapshot_date, rank (1 = largest), singular_value."""

    vectors: DataFrame
    values: DataFrame


def svd_rank(n_rows: int, n_cols: int, svd_dim: int) -> int:
    return int(min(svd_dim, max(2, min(n_rows, n_cols) - 1)))


def _start(width: int) -> Column:
    """Repeatable numbers between -1 and 1 for a recipient."""
    return F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda j: F.pmod(F.xxhash64("r", j), F.lit(2**30)) / F.lit(float(2**29)) - 1.0)


def _ranks(values: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """The number of each value among the distinct ones, and these."""
    coded = values.combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.indices.to_numpy().astype(np.int32), coded.dictionary


def _packed(edges: pa.Table) -> pa.Table:
    """A block's edges as one row: its recipients, and by sender the number of the recipient and the weight."""
    sender, _ = _ranks(edges.column("s"))
    recipient, names = _ranks(edges.column("r"))
    order = np.argsort(sender, kind="stable")
    out = io.BytesIO()
    np.savez(out, s=sender[order], r=recipient[order], w=edges.column("weight").to_numpy()[order])
    columns = [edges.column("d").slice(0, 1), edges.column("b").slice(0, 1), pa.array([names.to_pylist()], pa.list_(pa.string())), pa.array([out.getvalue()], pa.binary())]
    return pa.table(columns, names=["d", "b", "recipients", "data"])


def _sums(at: np.ndarray, weight: np.ndarray, vectors: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Row k: the sum of weight times vectors[of] over the entries with at = k; ``at`` ascends and skips no number."""
    starts, out = np.flatnonzero(np.diff(at, prepend=-1)), []
    step = max(1, HELD // vectors.shape[1])
    edges = np.append(starts, len(at))
    k = 0
    while k < len(starts):  # whole sums of at most ``step`` entries, or one
        end = max(k + 1, int(np.searchsorted(edges, edges[k] + step, "right")) - 1)
        some = slice(edges[k], edges[end])
        out.append(np.add.reduceat(weight[some, None] * vectors[of[some]], starts[k:end] - edges[k], axis=0))
        k = end
    return np.concatenate(out)


class _Block:
    """The matrix of one block, dense where that takes little more than its entries."""

    def __init__(self, raw: bytes, n_recipients: int):
        with np.load(io.BytesIO(raw)) as stored:
            self.s, self.r, self.w = stored["s"], stored["r"], stored["w"]
        shape = (int(self.s[-1]) + 1, n_recipients)
        self.dense = None
        if shape[0] * shape[1] <= 16 * len(self.w):
            self.dense = np.bincount(self.s * np.int64(n_recipients) + self.r, self.w, shape[0] * shape[1]).reshape(shape)

    def times(self, x: np.ndarray) -> np.ndarray:
        return self.dense @ x if self.dense is not None else _sums(self.s, self.w, x, self.r)

    def transposed_times(self, z: np.ndarray) -> np.ndarray:
        if self.dense is not None:
            return self.dense.T @ z
        order = np.argsort(self.r, kind="stable")
        return _sums(self.r[order], self.w[order], z, self.s[order])


def _opened(block: pa.Table, sent: pa.Table) -> tuple[pa.Array, _Block, np.ndarray]:
    """The recipients of a block, its matrix, and their vectors in that order."""
    names = block.column("recipients").combine_chunks().flatten()
    at = pc.index_in(names, value_set=sent.column("r").combine_chunks())
    vectors = _matrix(sent.column("vec").combine_chunks())[at.to_numpy()]
    return names, _Block(block.column("data")[0].as_py(), len(names)), vectors


def _round(block: pa.Table, sent: pa.Table) -> pa.Table:
    """A block's part of A-transposed times A times the vectors: one row per recipient."""
    names, a, x = _opened(block, sent)
    y = a.transposed_times(a.times(x))
    day = pa.array(np.full(len(names), block.column("d")[0].as_py(), np.int32))
    return pa.table([day, names, _lists(y)], names=["d", "r", "vec"])


def _energy(block: pa.Table, sent: pa.Table) -> pa.Table:
    """A block's senders, and its part of the Gram matrix of A times the vectors."""
    _, a, x = _opened(block, sent)
    z = a.times(x)
    own = np.concatenate([[len(z)], (z.T @ z).ravel()])
    return pa.table([block.column("d"), _lists(own[None])], names=["d", "g"])


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(rows.ravel()))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _per_date(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Each date of the batch and its row numbers."""
    days = batch.column("d").to_numpy()
    for day in np.unique(days):
        yield int(day), np.flatnonzero(days == day)


def _gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per date of the partition: count, then the Gram matrix of its vectors."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        if batch.num_rows:
            block = _matrix(batch.column("vec"))
            for day, at in _per_date(batch):
                own = np.concatenate([[len(at)], (block[at].T @ block[at]).ravel()])
                sums[day] = sums[day] + own if day in sums else own
    yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int32()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))], names=["d", "g"])


def _totals(parts: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """date -> (rows, Gram matrix) of rows (d, g); one row per date reaches the driver."""
    total = parts.groupBy("d").agg(vector_to_array(Summarizer.sum(array_to_vector("g"))).alias("g"))
    out = {}
    for row in total.collect():
        g = np.array(row.g[1:])
        width = int(round(len(g) ** 0.5))
        out[row.d] = int(round(row.g[0])), g.reshape(width, width)
    return out


def _grams(block: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """date -> (rows, Gram matrix) of a table of vectors."""
    return _totals(block.select("d", vector_to_array("vec").alias("vec")).mapInArrow(_gram, "d int, g array<double>"))


def _whitening(gram: np.ndarray) -> np.ndarray:
    """The matrix that makes a block of this Gram matrix orthonormal; directions that are not there become zero."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    kept = values > ZERO * max(values[-1], np.finfo(float).tiny)
    return vectors * np.where(kept, 1 / np.sqrt(np.where(kept, values, 1)), 0)


def _turned(block: DataFrame, by: str, turn: dict[int, np.ndarray]) -> DataFrame:
    """Every vector times its date's matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = _matrix(batch.column("vec"))
            out = np.empty((len(vec), next(iter(turn.values())).shape[1]))
            for day, at in _per_date(batch):
                out[at] = vec[at] @ turn[day]
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * out.shape[1]), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column(by), flat], names=["d", by, "vec"])

    turned = block.select("d", by, vector_to_array("vec").alias("vec")).mapInArrow(run, f"d int, {by} string, vec array<double>")
    return turned.withColumn("vec", array_to_vector("vec"))


def _rotation(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Singular values (descending) and the rotation of the orthonormal block."""
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    order = np.argsort(-values, kind="stable")
    values = values[order]
    return np.sqrt(np.where(values > ZERO * max(values[0], np.finfo(float).tiny), values, 0)), vectors[:, order]


def factorise(edges: DataFrame, svd_dim: int = 64, oversample: int = OVERSAMPLE, rounds: int = ROUNDS, cut: Callable[[DataFrame], DataFrame] | None = None, block_edges: int = BLOCK_EDGES) -> Factors:
    """The leading ``svd_dim`` singular vectors and values of each date's matrix.

    ``cut`` materialises a block between jobs (default: a table in the shared folder).
    """
    spark = edges.sparkSession
    cut = cut or (lambda df: written(df, "factorise"))
    width, date = svd_dim + oversample, F.date_from_unix_date("d").alias("snapshot_date")
    e = cut(edges.select(F.unix_date("snapshot_date").alias("d"), F.col("sender_id").alias("s"), F.col("recipient_canon_id").alias("r"), "weight").where("d IS NOT NULL AND s IS NOT NULL AND r IS NOT NULL AND weight IS NOT NULL"))

    # one row per date; dates whose edges all weigh nothing have no block
    sizes = e.where("weight <> 0").groupBy("d").agg(F.ceil(F.count(F.lit(1)) / F.lit(block_edges)).alias("n")).collect()
    if not sizes:
        zero = e.select(date, F.col("r").alias("recipient_canon_id")).distinct().withColumn("svd_vec", F.array_repeat(F.lit(0.0), svd_dim))
        return Factors(zero, spark.createDataFrame([], "snapshot_date date, rank int, singular_value double"))
    per_date = spark.createDataFrame([(r.d, int(r.n)) for r in sizes], "d int, n int")
    dealt = e.where("weight <> 0").join(F.broadcast(per_date), "d").select("d", F.pmod(F.xxhash64("s"), F.col("n")).cast("int").alias("b"), "s", "r", "weight")
    blocks = dealt.groupBy("d", "b").applyInArrow(_packed, "d int, b int, recipients array<string>, data binary")
    # kept where they lie between the rounds: the vectors come to them
    blocks = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "d", "b").persist()
    routes = cut(blocks.select("d", "b", F.explode("recipients").alias("r")))

    def with_blocks(vectors: DataFrame, work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
        sent = routes.join(vectors.select("d", "r", vector_to_array("vec").alias("vec")), ["d", "r"]).select("d", "b", "r", "vec")
        return blocks.groupBy("d", "b").cogroup(sent.groupBy("d", "b")).applyInArrow(work, schema)

    basis = e.where("weight <> 0").select("d", "r").distinct().withColumn("vec", array_to_vector(_start(width)))
    for _ in range(rounds):
        parts = with_blocks(basis, _round, "d int, r string, vec array<double>")
        block = cut(parts.groupBy("d", "r").agg(Summarizer.sum(array_to_vector("vec")).alias("vec")))
        basis = _turned(block, "r", {day: _whitening(g) for day, (_, g) in _grams(block).items()})

    n_recipients = {r.d: r.n for r in e.groupBy("d").agg(F.countDistinct("r").alias("n")).collect()}  # one row per date
    energy = _totals(with_blocks(basis, _energy, "d int, g array<double>"))
    blocks.unpersist()
    values, turn = [], {}
    for day, (n_senders, gram) in energy.items():
        s, rotation = _rotation(gram)
        side = min(n_senders, n_recipients[day])
        values += [(day, i + 1, float(x)) for i, x in enumerate(s[: min(svd_dim, side)])]
        kept = np.arange(svd_dim) < svd_rank(n_senders, n_recipients[day], svd_dim)
        turn[day] = rotation[:, :svd_dim] * (np.sqrt(s[:svd_dim]) * kept)
    vectors = cut(_turned(basis, "r", turn))

    # the largest entry of a component is positive; one row per date and component
    entries = vectors.select("d", F.posexplode(vector_to_array("vec")).alias("c", "x"))
    most = entries.groupBy("d", "c").agg(F.max_by("x", F.struct(F.abs("x"), "x")).alias("x"))
    signs = {day: np.ones(svd_dim) for day in turn}
    for r in most.where("x < 0").collect():
        signs[r.d][r.c] = -1.0
    final = _turned(vectors, "r", {day: np.diag(s) for day, s in signs.items()}).withColumn("vec", vector_to_array("vec"))
    # recipients whose edges all weigh nothing have a zero vector
    whole = e.select("d", "r").distinct().join(final, ["d", "r"], "left")
    vec = F.coalesce(F.transform("vec", lambda x: F.when(x == 0, 0.0).otherwise(x)), F.array_repeat(F.lit(0.0), svd_dim))
    return Factors(
        whole.select(date, F.col("r").alias("recipient_canon_id"), vec.alias("svd_vec")),
        spark.createDataFrame(values, "d int, rank int, singular_value double").select(date, "rank", "singular_value"),
    )
