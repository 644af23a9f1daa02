"""Alignment of two tokenizers over the same texts, with an identity-map fast path.

1. Texts are encoded where they lie.  Both tokenizers end a token before a space that follows
   something else, so a text is cut there and each distinct segment of a chunk of documents is
   encoded and aligned once.  Byte offsets where tokens of both end cut a segment into groups;
   the elementary intervals between all ends are the links, one for each overlapping pair.
2. *Identity map.*  An array from A's ids to the B id of the same bytes is built once.  A group of
   one A and one B token that the map predicts is regular: it is counted in a vector as long as
   A's vocabulary.  Only links of the other groups become (a, b, count) pairs, one row for each
   distinct pair of a chunk, and are shuffled.
3. Sums of both give every id pair's corpus-wide count; the highest count of a B id is one row
   of B's vocabulary.  Regular counts go back as two vectors of A's vocabulary, irregular ones to
   the chunks that hold them, where segments, and from them documents, are summed.

A chunk is one row: its documents' figures, their segments by number, and the segments' links
(compressed arrays).  Its size is bounded by CHUNK_SEGMENTS and CHUNK_PLACES plus one slice of
documents; every document is in exactly one chunk, so nothing depends on where chunks end.

Defined cases: a null or empty text, and one whose tokens do not spell it (space + text) in both
vocabularies, has no tokens: zeros and an empty digest; a null doc_id passes through; repeated
rows are aligned and counted each; texts of any length are one document of one chunk; pairs with
equal counts are all best; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import one_thread_per_task, worker_cache, written

#: Distinct segments and segment occurrences after which a chunk is closed (memory bounds of a row).
CHUNK_SEGMENTS, CHUNK_PLACES = 150_000, 6_000_000
#: Characters of the documents that are cut and numbered together, and segments of one tokenizer call.
SLICE_CHARS, NEW_SEGMENTS = 2_000_000, 1000
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class Pair:
    """Two tokenizers, their tokens' bytes and the identity map."""

    def __init__(self, a_json: bytes, b_model: bytes):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        one_thread_per_task()
        spec = json.loads(a_json)
        self.a = Tokenizer.from_buffer(a_json)
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_alphabet()
        vocabulary = spec["model"]["vocab"]
        self.a_bytes = [b""] * (max([*vocabulary.values(), *(t["id"] for t in spec["added_tokens"])]) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(alphabet.__getitem__, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        by_bytes = {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if x and self.b.is_byte(i)}
        by_bytes |= {x: i for i, x in reversed(list(enumerate(self.b_bytes))) if x and not self.b.is_byte(i)}
        self.identity = np.array([by_bytes.get(x, -1) for x in self.a_bytes], np.int32)
        self.a_lens = np.array(list(map(len, self.a_bytes)), np.int64)
        self.b_lens = np.array(list(map(len, self.b_bytes)), np.int64)
        marks = [[mark + str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))] for mark in ",|;"]
        #: an id after each of the three marks between ids
        self.marked = np.array(marks, object)
        self.lone_space = self.b.piece_to_id(SPACE)
        pre = spec.get("pre_tokenizer") or {}
        apart = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec.get("normalizer")
        #: whether both end a token before every space that follows something else
        self.apart = bool(apart) and not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self._runs = re.compile(" +[^ ]*").findall
        self._odd = re.compile(r"[^\S ] (?:\s|\Z)").search  # white space that the pre-split keeps together with a space
        self._cuts = re.compile(r"(?<=\S)(?= )").split

    def segments(self, text: str) -> list[str]:
        """Parts of space + text that both tokenizers encode apart."""
        spaced = " " + text
        if not self.apart:
            return [spaced]
        return self._cuts(spaced) if self._odd(spaced) else self._runs(spaced)

    def encode(self, segments: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Each segment's ids."""
        a = [e.ids for e in self.a.encode_batch_fast(segments, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in segments], num_threads=1)
        return a, [ids if s != " " else [self.lone_space] for s, ids in zip(segments, b)]

    def flat(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All segments' ids in a row and how many each one has, by A and by B; none where they do not spell the segment.

        Segments that end in no white space can stand side by side: one call encodes them all.
        """
        if self.apart and not any(s[-1].isspace() for s in segments):
            joined = "".join(segments)
            raw = joined.encode()
            a = self.a.encode_batch_fast([joined], add_special_tokens=False)[0].ids
            b = self.b.encode(joined[1:], num_threads=1)
            if self._spelt(a, self.a_bytes) == raw == self._spelt(b, self.b_bytes):
                a, b = np.array(a, np.int64), np.array(b, np.int64)
                bounds = np.cumsum([len(s.encode()) for s in segments])
                counts = (np.diff(np.searchsorted(np.cumsum(lens[ids]), bounds, "right"), prepend=0) for ids, lens in ((a, self.a_lens), (b, self.b_lens)))
                return a, b, *counts
        a, b = self.encode(segments)
        for k, s in enumerate(segments):
            raw = s.encode()
            if self._spelt(a[k], self.a_bytes) != raw or self._spelt(b[k], self.b_bytes) != raw:
                a[k] = b[k] = []
        rows = lambda lists: np.array([i for ids in lists for i in ids], np.int64)
        return rows(a), rows(b), np.array(list(map(len, a)), np.int64), np.array(list(map(len, b)), np.int64)

    @staticmethod
    def _spelt(ids: list[int], table: list[bytes]) -> bytes:
        return b"".join(map(table.__getitem__, ids))


class Links:
    """The aligned segments of a chunk, numbered in order of appearance."""

    def __init__(self, pair: Pair):
        self.pair, self.index = pair, {}
        self.strings: list[str | None] = []
        empty = np.empty(0, np.int64)
        self.n_a, self.n_b, self.n_groups, self.counts = empty, empty, empty, empty
        self.of: list[np.ndarray] = []  # for each link: its segment, A id, B id, and whether its group is regular
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []
        self.regular: list[np.ndarray] = []

    def add(self, fresh: list[str]) -> None:
        """Segments in calls of bounded size, those that end in white space apart."""
        plain = [s for s in fresh if not s[-1].isspace()]
        for some in (plain, [s for s in fresh if s[-1].isspace()]):
            for i in range(0, len(some), NEW_SEGMENTS):
                self._add(some[i : i + NEW_SEGMENTS])

    def _add(self, fresh: list[str]) -> None:
        pair, first = self.pair, len(self.index)
        self.index.update(zip(fresh, range(first, first + len(fresh))))
        a, b, n_a, n_b = pair.flat(fresh)
        a_ends, b_ends = np.cumsum(pair.a_lens[a]), np.cumsum(pair.b_lens[b])
        group_ends = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(group_ends, a_ends), np.searchsorted(group_ends, b_ends)
        ends = np.union1d(a_ends, b_ends)  # one link ends at each
        a_at, b_at = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        a_of = np.repeat(np.arange(len(fresh)), n_a)
        link_group = a_group[a_at]
        alone = np.bincount(link_group, minlength=len(group_ends))[link_group] == 1
        group_of = a_of[np.searchsorted(a_ends, group_ends)]
        self.n_a, self.n_b = np.append(self.n_a, n_a), np.append(self.n_b, n_b)
        self.n_groups = np.append(self.n_groups, np.bincount(group_of, minlength=len(fresh)))
        self.counts = np.append(self.counts, np.zeros(len(fresh), np.int64))
        self.of.append(first + a_of[a_at])
        self.a.append(a[a_at])
        self.b.append(b[b_at])
        self.regular.append(alone & (pair.identity[a[a_at]] == b[b_at]))
        self._write(a, b, a_group, b_group, n_a + n_b)

    def _write(self, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, sizes: np.ndarray) -> None:
        """Each segment's groups as text: ids joined by ",", sides by "|", groups by ";"."""
        sides = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(sides, kind="stable")
        sides = sides[order]
        marks = np.where(np.diff(sides, prepend=-1) == 0, 0, np.where(sides % 2 == 1, 1, 2))
        tokens = self.pair.marked[marks, np.concatenate([a, b])[order]].tolist()
        ends = np.cumsum(sizes).tolist()
        self.strings += ["".join(tokens[i:j])[1:] if i < j else None for i, j in zip([0, *ends], ends)]


def _packed(x: np.ndarray) -> bytes:
    return pa.compress(x.tobytes(), codec="zstd", asbytes=True) if len(x) else b""


def _unpacked(x: bytes, n: int, kind: type) -> np.ndarray:
    return np.frombuffer(pa.decompress(x, decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind) if n else np.empty(0, kind)


PAIR = "array<struct<a:int,b:int,n:bigint>>"
CHUNK = (
    "chunk string, doc_id array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, digest array<string>, "
    f"n_segments array<bigint>, places binary, n_refs int, refs binary, n_sizes int, sizes binary, pairs {PAIR}, regular {PAIR}"
)


class Chunk:
    """Documents aligned against one growing dictionary of segments."""

    def __init__(self, pair: Pair):
        self.links, self.rows, self.places, self.n_places = Links(pair), [], [], 0

    @property
    def full(self) -> bool:
        return len(self.links.index) >= CHUNK_SEGMENTS or self.n_places >= CHUNK_PLACES

    def align(self, ids: list, texts: list[str | None]) -> None:
        links = self.links
        flat, bounds = [], [0]
        for text in texts:
            if text:
                flat += links.pair.segments(text)
            bounds.append(len(flat))
        links.add([s for s in dict.fromkeys(flat) if s not in links.index])
        at = np.fromiter(map(links.index.__getitem__, flat), np.int64, len(flat))
        bad = links.n_a[at] == 0
        sums = [np.concatenate([[0], np.cumsum(x)]) for x in (bad, links.n_a[at], links.n_b[at], links.n_groups[at])]
        for k, doc_id in enumerate(ids):
            i, j = bounds[k], bounds[k + 1]
            bads, n_a, n_b, n_groups = (int(s[j] - s[i]) for s in sums)
            if i == j or bads:
                self.rows.append((doc_id, 0, 0, 0, "", 0))
                continue
            mine = at[i:j]
            written_out = ";".join(map(links.strings.__getitem__, mine.tolist()))
            self.rows.append((doc_id, n_a, n_b, n_groups, hashlib.sha256(written_out.encode()).hexdigest(), j - i))
            np.add.at(links.counts, mine, 1)
            self.places.append(mine.astype(np.uint32))
            self.n_places += j - i

    def row(self) -> pa.RecordBatch:
        links, none = self.links, np.empty(0, np.int64)
        of, a, b = (np.concatenate([none, *x]) for x in (links.of, links.a, links.b))
        regular = np.concatenate([np.empty(0, bool), *links.regular])
        times = links.counts[of]
        vector = np.zeros(len(links.pair.identity), np.int64)
        np.add.at(vector, a[regular], times[regular])
        keys, place = np.unique((a[~regular] << 32) | b[~regular], return_inverse=True)
        pair_n = np.zeros(len(keys), np.int64)
        np.add.at(pair_n, place, times[~regular])
        refs = np.empty(len(of), np.int32)
        refs[regular], refs[~regular] = ~a[regular], place
        kept = np.flatnonzero(vector)
        sizes = np.bincount(of, minlength=len(links.index)).astype(np.uint32)
        longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
        columns = [pa.array([list(c)], strings if k == 4 else longs) for k, c in enumerate(zip(*self.rows))]
        arrays = [
            pa.array([uuid.uuid4().hex]),
            *columns,
            pa.array([_packed(np.concatenate([np.empty(0, np.uint32), *self.places]))], pa.binary()),
            pa.array([len(refs)], pa.int32()),
            pa.array([_packed(refs)], pa.binary()),
            pa.array([len(sizes)], pa.int32()),
            pa.array([_packed(sizes)], pa.binary()),
            _pairs(keys >> 32, keys & 0xFFFFFFFF, pair_n),
            _pairs(kept, links.pair.identity[kept], vector[kept]),
        ]
        return pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in CHUNK.replace(PAIR, "pairs").split(", ")])


def _pairs(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.ListArray:
    rows = pa.StructArray.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], names=["a", "b", "n"])
    return pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)


def _slices(ids: list, texts: list[str | None]) -> Iterator[tuple[list, list]]:
    start, chars = 0, 0
    for i, text in enumerate(texts):
        chars += len(text or "")
        if chars >= SLICE_CHARS:
            yield ids[start : i + 1], texts[start : i + 1]
            start, chars = i + 1, 0
    if start < len(texts):
        yield ids[start:], texts[start:]


def _finish(regular_n: np.ndarray, regular_best: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's segments and documents summed over their links' counts."""
        before = lambda x: np.concatenate([[0], np.cumsum(x, dtype=np.int64)])
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k] for n in batch.schema.names}
                refs = _unpacked(row["refs"].as_py(), row["n_refs"].as_py(), np.int32)
                lens = np.array(row["n_segments"].as_py(), np.int64)
                answers = row["answers"].values if row["answers"].is_valid else None
                n, best = np.empty(len(refs), np.int64), np.empty(len(refs), np.int64)
                own = refs < 0
                n[own], best[own] = regular_n[~refs[own]], regular_best[~refs[own]]
                if answers is not None:
                    at = refs[~own]
                    n[~own] = answers.field("n").to_numpy()[at]
                    best[~own] = answers.field("best").to_numpy(zero_copy_only=False)[at]
                n_all, best_all = before(n), before(best)
                places = _unpacked(row["places"].as_py(), int(lens.sum()), np.uint32)
                ends = before(_unpacked(row["sizes"].as_py(), row["n_sizes"].as_py(), np.uint32))
                links = np.diff(ends)
                segment_n, segment_best = np.diff(n_all[ends]), np.diff(best_all[ends])
                doc_ends = before(lens)
                sums = [np.diff(before(x[places])[doc_ends]) for x in (links, segment_best, segment_n)]
                columns = [row[c].values for c in ("doc_id", "n_a", "n_b", "n_groups")]
                names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(s, pa.int64()) for s in sums), row["digest"].values], names=names)

    return run


def align(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; see ``pair_counts`` for the pairs."""
    return _documents(*_aligned(docs, a_file, b_file))


def pair_counts(docs: DataFrame, a_file: str, b_file: str) -> DataFrame:
    """a, b, n, best: each linked id pair's corpus-wide count, and whether its B id has no more frequent one."""
    return _aligned(docs, a_file, b_file)[1]


def _aligned(docs: DataFrame, a_file: str, b_file: str) -> tuple[DataFrame, DataFrame, Pair]:
    raw = [open(path, "rb").read() for path in (a_file, b_file)]
    files = docs.sparkSession.sparkContext.broadcast(raw)
    name = "align:" + hashlib.sha256(b"".join(raw)).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = worker_cache(name, lambda: Pair(*files.value))
        chunk = Chunk(pair)
        for batch in batches:
            for ids, texts in _slices(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                chunk.align(ids, texts)
                if chunk.full:
                    yield chunk.row()
                    chunk = Chunk(pair)
        if chunk.rows:
            yield chunk.row()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    chunks = written(rows.mapInArrow(run, CHUNK), "align_chunks")
    counted = chunks.select(F.explode("pairs").alias("p")).union(chunks.select(F.explode("regular").alias("p")))
    counts = counted.groupBy("p.a", "p.b").agg(F.sum("p.n").alias("n"))
    counts = written(counts, "align_counts")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    # at most one row for each B id
    scored = counts.join(F.broadcast(most), "b").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    return chunks, scored, Pair(*raw)


def _documents(chunks: DataFrame, scored: DataFrame, pair: Pair) -> DataFrame:
    spark = chunks.sparkSession
    regular_n, regular_best = np.zeros(len(pair.identity), np.int64), np.zeros(len(pair.identity), np.int64)
    known = np.flatnonzero(pair.identity >= 0)
    same = spark.createDataFrame([(int(a), int(pair.identity[a])) for a in known], "a int, b int")
    # at most one row for each A id, both in the broadcast and in the result
    for r in scored.join(F.broadcast(same), ["a", "b"]).collect():
        regular_n[r.a], regular_best[r.a] = r.n, r.best

    irregular = chunks.select("chunk", F.posexplode("pairs").alias("place", "p")).select("chunk", "place", "p.a", "p.b")
    answers = irregular.join(scored.hint("merge"), ["a", "b"]).groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", "n", "best"))).alias("answers"))
    wide = chunks.drop("pairs", "regular").join(answers, "chunk", "left")
    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    return wide.mapInArrow(_finish(regular_n, regular_best), schema)
