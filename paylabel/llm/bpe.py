"""Byte-level BPE by monoid tree reduction.

The BPE encodings of byte strings form a monoid under "concatenate and repair": a piece is
cut into halves, the halves are encoded recursively, and neighbours are joined by
re-encoding a window of tokens around the boundary.  A window is final when its outer tokens
are *compatible* with the untouched tokens beside them, that is, when encoding the two
tokens' bytes alone gives back these two tokens.  A sequence whose neighbours are all
compatible is the encoding of its bytes, because merges inside a token only ever see that
token and its neighbour; so nothing outside the window can change.  If an end is not yet
stable, the window doubles towards it; at worst it covers the whole piece, which is then
encoded directly.  Segments, pairs and pieces are memoised per worker.

Decoding concatenates token bytes up the same balanced tree.

The pre-split pattern and the rank file are parameters.  The rank file's bytes reach the
executors by broadcast (a vocabulary, under 1 MB), so that only the driver needs the path.

Defined cases: a null text encodes like an empty one, to no tokens; repeated rows encode
alike; an empty table gives no rows; other columns pass through unchanged.
"""

from __future__ import annotations

import base64
import heapq
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import worker_cache

#: Segments of at most this many bytes are merged directly, as leaves of the tree.
LEAF_BYTES = 6
#: Leaves and windows of at most this many bytes are memoised.
MEMO_BYTES = 12
#: Entries that a memo may hold in a worker before it starts anew (memory bound, not a result bound).
MEMO_ENTRIES = 200_000


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class TreeEncoder:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: token for token, rank in ranks.items()}
        self.segments: dict[bytes, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    # -- leaves -----------------------------------------------------------------------
    def merge(self, data: bytes) -> tuple[int, ...]:
        """Plain BPE of a leaf or window; short ones are memoised."""
        if len(data) > MEMO_BYTES:
            return self._merge_long(data) if len(data) > 24 else self._merge_short(data)
        known = self.segments.get(data)
        if known is None:
            if len(self.segments) >= MEMO_ENTRIES:
                self.segments.clear()
            known = self.segments[data] = self._merge_short(data)
        return known

    def _merge_short(self, data: bytes) -> tuple[int, ...]:
        """Join the neighbours whose concatenation has the lowest rank, leftmost first."""
        ranks = self.ranks
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = None, 0
            for i in range(len(parts) - 1):
                rank = ranks.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return tuple(ranks[p] for p in parts)

    def _merge_long(self, data: bytes) -> tuple[int, ...]:
        """The same merges from a heap: n log n for windows that a repetitive text makes long."""
        ranks, n = self.ranks, len(data)
        end = list(range(1, n + 1))  # end[i]: where the part that starts at i ends; 0 if i starts none
        start_of = list(range(n)) + [n]  # start_of[j]: start of the part that ends at j (by end position - 1)
        heap = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n:
                rank = ranks.get(data[i : end[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, j, end[j]))

        for i in range(n):
            offer(i)
        while heap:
            _, i, j, k = heapq.heappop(heap)
            if end[i] != j or end[j] != k:
                continue
            end[i], end[j] = k, 0
            start_of[k - 1] = i
            offer(i)
            if i > 0:
                offer(start_of[i - 1])
        out, i = [], 0
        while i < n:
            out.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(out)

    # -- joins ------------------------------------------------------------------------
    def compatible(self, left: int, right: int) -> bool:
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= MEMO_ENTRIES:
                self.pairs.clear()
            known = self.pairs[key] = self.merge(self.token[left] + self.token[right]) == key
        return known

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        if not left or not right or self.compatible(left[-1], right[0]):
            return left + right
        i = j = 1
        while True:
            window = b"".join([self.token[t] for t in left[len(left) - i :]] + [self.token[t] for t in right[:j]])
            middle = self.merge(window)
            left_done = i == len(left) or self.compatible(left[len(left) - i - 1], middle[0])
            right_done = j == len(right) or self.compatible(middle[-1], right[j])
            if left_done and right_done:
                return left[: len(left) - i] + middle + right[j:]
            if not left_done:
                i = min(2 * i, len(left))
            if not right_done:
                j = min(2 * j, len(right))

    def tree(self, data: bytes) -> tuple[int, ...]:
        n = len(data)
        if n <= LEAF_BYTES:
            return self.merge(data)
        return self.join(self.tree(data[: n // 2]), self.tree(data[n // 2 :]))

    # -- whole pieces and texts ---------------------------------------------------------
    def piece(self, data: bytes) -> tuple[int, ...]:
        """A match of the pre-split pattern: a piece that is a token as a whole stays whole."""
        whole = self.ranks.get(data)
        return (whole,) if whole is not None else self.tree(data)

    def decode(self, ids: list[int]) -> bytes:
        """Concatenation up a balanced tree whose leaves are runs of 4,096 tokens."""
        if len(ids) <= 4096:
            return b"".join(map(self.token.__getitem__, ids))
        level = [b"".join(map(self.token.__getitem__, ids[i : i + 4096])) for i in range(0, len(ids), 4096)]
        while len(level) > 1:
            level = [b"".join(level[i : i + 2]) for i in range(0, len(level), 2)]
        return level[0]


class PieceCache(dict):
    """piece -> token ids, filled on demand; pieces still used survive when the older half is dropped."""

    def __init__(self, encoder: TreeEncoder):
        super().__init__()
        self.encoder, self.old = encoder, {}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMO_ENTRIES:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(piece)
        if ids is None:
            ids = self.encoder.piece(piece.encode())
        self[piece] = ids
        return ids


#: Texts without a character from here on are split by the standard library's faster engine.
COMMON_END = 0x250


def common_pattern(pattern: str) -> str:
    """The pattern with its Unicode classes spelled out for characters below COMMON_END."""
    chars = [chr(i) for i in range(COMMON_END)]
    classes = {
        r"\p{L}": "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("L")),
        r"\p{N}": "".join(re.escape(c) for c in chars if unicodedata.category(c).startswith("N")),
        r"\s": r"\t-\r \x85\xa0",
        r"\S": r"^\t-\r \x85\xa0",
    }
    out, i, inside = [], 0, False
    while i < len(pattern):
        name = next((k for k in classes if pattern.startswith(k, i)), None)
        if name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
            i += len(name)
            continue
        inside = pattern[i] == "[" or (inside and pattern[i] != "]")
        out.append(pattern[i])
        i += 1
    return "".join(out)


class TextEncoder:
    def __init__(self, rank_data: bytes, pattern: str):
        import regex

        self.encoder = TreeEncoder(parse_ranks(rank_data))
        self.cache = PieceCache(self.encoder)
        self.split_any = regex.compile(pattern).findall
        self.split_common = re.compile(common_pattern(pattern)).findall
        self.uncommon = re.compile(f"[^\\x00-{chr(COMMON_END - 1)}]").search

    def split(self, text: str) -> list[str]:
        return self.split_any(text) if self.uncommon(text) else self.split_common(text)

    def __call__(self, text: str | None) -> list[int]:
        ids: list[int] = []
        extend, cache = ids.extend, self.cache
        for piece in self.split(text or ""):
            extend(cache[piece])
        return ids


def _worker_encoder(rank_data: bytes, pattern: str) -> TextEncoder:
    return worker_cache(f"bpe:{hash(rank_data)}:{pattern}", lambda: TextEncoder(rank_data, pattern))


def _appended(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def _schema_with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, T.StructField(name, kind, False)])


def encode(docs: DataFrame, rank_file: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """docs with a column of token ids (array<int>); the text column stays as it is."""
    with open(rank_file, "rb") as f:
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(ranks.value, pattern)
        for batch in batches:
            offsets, flat = [0], []
            for text in batch.column(text_col).to_pylist():
                flat.extend(encoder(text))
                offsets.append(len(flat))
            yield _appended(batch, ids_col, pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int32())))

    return docs.mapInArrow(run, _schema_with(docs, ids_col, T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, rank_file: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with a column of the bytes that its ids stand for; null ids decode to no bytes."""
    with open(rank_file, "rb") as f:
        ranks = encoded.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_cache(f"bpe-decode:{hash(ranks.value)}", lambda: TreeEncoder(parse_ranks(ranks.value)))
        for batch in batches:
            texts = [encoder.decode(ids or []) for ids in batch.column(ids_col).to_pylist()]
            yield _appended(batch, out_col, pa.array(texts, pa.binary()))

    return encoded.mapInArrow(run, _schema_with(encoded, out_col, T.BinaryType()))
