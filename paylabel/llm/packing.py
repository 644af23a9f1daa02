"""Best-fit packing by length patterns and non-negative least squares.

1. Documents are tokenised where they lie.  White space separates tokens in this family of
   tokenizers, so a text is cut at ASCII white space and words, or their pre-tokens, are
   encoded once per worker; a document's ids are its words' ids and the end id.  Documents longer than a
   sequence are cut into full pieces, the last one shorter.  Only (doc_id, piece, start,
   length, checksum) rows go on.
2. The histogram of piece lengths (at most ``capacity`` rows) goes to the driver.  Patterns
   of one to four documents that fill a sequence are enumerated, repeat counts are fitted to
   the histogram by non-negative least squares (projected gradient on the sparse pattern
   matrix), rounded down to what is there, and fitted again to what is left.
3. The residual is packed best-fit decreasing, on runs of equal lengths rather than pieces.
4. The plan is a table of runs "the pieces of length l ranked a .. a+n-1 go to sequences s ..
   s+n-1 at offset o".  It depends on the capacity, not on the rows, and is broadcast.  A
   piece's rank among its length is a counter of its partition plus a prefix sum over
   partitions, so a length that a third of all pieces share is never one task's.

Defined cases: a null or empty text is one piece that holds the end id alone; a null doc_id
passes through; repeated rows are packed each; an empty table gives no rows; only doc_id and
text are read.
"""

from __future__ import annotations

import json
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import COMMON_END, common_pattern
from .common import Memo, one_thread_per_task, worker_cache, written

CAPACITY = 2048
END_ID = 0
#: Pre-tokens whose ids a worker remembers (memory bound, not a result bound).
MEMO_PARTS = 400_000
#: New pre-tokens that one tokenizer call takes, and characters of the texts whose pre-tokens are numbered together, about.
NEW_PARTS, NUMBERED_CHARS = 1000, 3_000_000
#: Rounds of the fit, steps of one round, and partners tried for a pattern's largest document.
FIT_ROUNDS, FIT_STEPS, PARTNERS = 4, 150, 12


class WordIds:
    """Token ids of texts: pre-tokens are numbered by Arrow, looked up once a batch, and encoded if new.

    The pre-split pattern and whether text is lower-cased are read from the vocabulary file.  New
    pre-tokens are encoded many in one call by the file's merges alone: each ends with the one token
    of it that ends a word, where the call's ids are cut.  A text with characters that this short cut does not cover, before or
    after lower-casing, is cut at white space only and its words go to the tokenizer as they stand.
    """

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        one_thread_per_task()
        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        self.tokenizer.encode_special_tokens = True
        self.parts = Memo(MEMO_PARTS)
        self.words = Memo(MEMO_PARTS)
        spec = json.loads(vocabulary)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        lowers = any(n.get("type") == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers") or [])
        pattern, suffix = steps[0].get("pattern", {}).get("Regex"), spec["model"].get("end_of_word_suffix")
        self.split = None
        if pattern and lowers and suffix and [s.get("type") for s in steps[1:]] == ["ByteLevel"]:
            self.split = re.compile(common_pattern(pattern)).findall
            bare = spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, steps[1]]}, "post_processor": None}
            self.merges = Tokenizer.from_buffer(json.dumps(bare).encode())
            self.merges.encode_special_tokens = True
            self.is_last = np.zeros(max(spec["model"]["vocab"].values()) + 1, bool)
            self.is_last[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self.uncommon = re.compile(f"[^\x00-{chr(COMMON_END - 1)}]").search

    def _as_they_stand(self, words: list[str]) -> list[bytes]:
        found = list(map(self.words.new.get, words))
        fresh = list(dict.fromkeys(w for w, ids in zip(words, found) if ids is None and self.words.get(w) is None))
        for i in range(0, len(fresh), NEW_PARTS):  # the tokenizer's own results are large
            some = fresh[i : i + NEW_PARTS]
            self.words.new.update(zip(some, self._encode(some)))
        return [self.words.new[w] if ids is None else ids for w, ids in zip(words, found)]

    def _encode(self, words: list[str]) -> list[bytes]:
        """Ids as little-endian 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _ids_of(self, parts: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens."""
        self.parts.turn()
        found = list(map(self.parts.new.get, parts))
        fresh = [p for p, ids in zip(parts, found) if ids is None and self.parts.get(p) is None]
        for i in range(0, len(fresh), NEW_PARTS):
            some = fresh[i : i + NEW_PARTS]
            ids = np.array(self.merges.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_last[ids]) + 1
            if len(ends) == len(some) and ends[-1] == len(ids):
                raw, ends = ids.tobytes(), (4 * ends).tolist()
                self.parts.new.update(zip(some, [raw[a:b] for a, b in zip([0, *ends], ends)]))
            else:
                self.parts.new.update(zip(some, self._encode(some)))
        return [self.parts.new[p] if ids is None else ids for p, ids in zip(parts, found)]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids as little-endian 32-bit integers."""
        ends = np.cumsum([len(t or "") for t in texts]) // NUMBERED_CHARS
        for i, j in zip(starts := [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist()], [*starts[1:], len(texts)]):
            yield from self._numbered(texts[i:j])

    def _numbered(self, texts: list[str | None]) -> Iterator[bytes]:
        flat_parts, offsets, whole = [], [0], {}
        self.words.turn()
        for k, text in enumerate(texts):
            text = text or ""
            low = text.lower()
            if self.split is None or (not text.isascii() and (self.uncommon(text) or self.uncommon(low))):
                whole[k] = b"".join(self._as_they_stand([w.decode() for w in text.encode().split()]))
            else:
                flat_parts += self.split(low)
            offsets.append(len(flat_parts))
        numbered = pa.array(flat_parts, pa.string()).dictionary_encode()
        each = self._ids_of(numbered.dictionary.to_pylist())
        flat = np.frombuffer(b"".join(each), "<u4")
        lens = np.array(list(map(len, each)), np.int64) // 4
        starts = np.cumsum(lens) - lens
        number = numbered.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(lens[number])]).astype(np.int64)
        ids = flat[np.repeat(starts[number] - ends[:-1], lens[number]) + np.arange(ends[-1])]
        bounds = (4 * ends[offsets]).tolist()
        raw = ids.tobytes()
        for k, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            yield whole[k] if k in whole else raw[a:b]


PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, place bigint"


def pieces(docs: DataFrame, vocabulary_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and part, place: rank among the partition's pieces of this length."""
    with open(vocabulary_file, "rb") as f:
        vocabulary = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = worker_cache(f"word-ids:{hash(vocabulary.value)}", lambda: WordIds(vocabulary.value))
        end = np.array([END_ID], "<u4").tobytes()
        places: dict[int, int] = defaultdict(int)
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            doc_ids, piece_nos, starts, lengths, crcs, ranks = columns
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(batch.column("text").to_pylist())):
                ids += end
                n = len(ids) // 4
                for piece, start in enumerate(range(0, n, capacity)):
                    length = min(capacity, n - start)
                    doc_ids.append(doc_id)
                    piece_nos.append(piece)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(ids[4 * start : 4 * (start + length)]))
                    ranks.append(places[length])
                    places[length] += 1
            columns.insert(5, [part] * len(doc_ids))
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, PIECES)


# -- the plan: histogram in, runs out ----------------------------------------------------


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Multisets of up to four present lengths that fill a sequence exactly, or best a largest length can do."""
    present = np.flatnonzero(histogram)
    have = histogram > 0
    found: set[tuple[int, ...]] = set()
    below = np.zeros(capacity + 1, np.int64)  # the greatest present length up to each gap
    below[present] = present
    below = np.maximum.accumulate(below)
    for a in present[::-1]:
        a = int(a)
        gap = capacity - a
        pair = int(below[min(gap, capacity)])
        found.add((a, pair) if pair else (a,))
        if gap <= 1:
            continue
        seconds = present[(present <= min(a, gap))]
        if not len(seconds):
            continue
        for b in seconds[np.unique(np.linspace(0, len(seconds) - 1, PARTNERS).astype(int))]:
            b = int(b)
            rest = gap - b
            c = int(below[rest]) if rest > 0 else 0
            if c and c <= b:
                found.add((a, b, c))
            if c and rest - c > 0 and (d := int(below[rest - c])):
                found.add(tuple(sorted((a, b, c, d), reverse=True)))
            half = rest // 2
            if half and have[half] and rest - half <= capacity and have[rest - half]:
                found.add(tuple(sorted((a, b, half, rest - half), reverse=True)))
    return sorted(found, key=lambda p: (-sum(p), len(p), p))


def fit_counts(rows: np.ndarray, cols: np.ndarray, n_patterns: int, target: np.ndarray) -> np.ndarray:
    """Non-negative least squares: min |A x - target| with x >= 0 by accelerated projected gradient."""
    scale = 1.0 / np.sqrt(np.maximum(target, 1.0))  # relative errors, so that rare lengths count too
    weight = scale[rows]
    ahead = lambda x: np.bincount(rows, weight * x[cols], len(target))
    back = lambda r: np.bincount(cols, weight * r[rows], n_patterns)
    v = np.ones(n_patterns)
    for _ in range(12):  # largest singular value, for the step
        v = back(ahead(v))
        norm = np.linalg.norm(v)
        v /= norm or 1.0
    step = 1.0 / max(1.05 * norm, 1e-12)
    goal = scale * target
    x = z = np.zeros(n_patterns)
    t = 1.0
    for _ in range(FIT_STEPS):
        new = np.maximum(0.0, z - step * back(ahead(z) - goal))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, count, first sequence, offset) that place every piece once."""
    left = histogram.astype(np.int64).copy()
    used = np.zeros_like(left)
    runs: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def place(lengths: tuple[int, ...], times: int) -> None:
        nonlocal sequence
        offset = 0
        for length in lengths:
            runs.append((length, int(used[length]), times, sequence, offset))
            used[length] += times
            left[length] -= times
            offset += length
        sequence += times

    if left[capacity]:
        place((capacity,), int(left[capacity]))
    for _ in range(FIT_ROUNDS):
        if left.sum() == 0:
            break
        found = [p for p in patterns(left, capacity) if sum(p) >= capacity - capacity // 64]
        if not found:
            break
        rows = np.array([length for p in found for length in p])
        cols = np.array([i for i, p in enumerate(found) for _ in p])
        repeats = fit_counts(rows, cols, len(found), left.astype(float))
        before = left.sum()
        for i in np.argsort(-repeats, kind="stable"):
            lengths, counts = np.unique(found[i], return_counts=True)
            times = int(min(np.floor(repeats[i] + 0.5), (left[lengths] // counts).min()))
            if times > 0:
                place(found[i], times)
        if left.sum() == before:
            break
    _best_fit(left, place, capacity)
    return runs


def _best_fit(left: np.ndarray, place, capacity: int) -> None:
    """Best-fit decreasing on runs: equal lengths go together into groups of equal gaps."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # gap -> (lengths, sequences)
    for length in np.flatnonzero(left)[::-1]:
        length, count = int(length), int(left[length])
        while count:
            gap = min((g for g in groups if g >= length and groups[g]), default=None)
            if gap is None:
                per = capacity // length
                full, rest = divmod(count, per)
                if full:
                    groups[capacity - per * length].append(((length,) * per, full))
                if rest:
                    groups[capacity - rest * length].append(((length,) * rest, 1))
                break
            lengths, sequences = groups[gap].pop()
            per = min(gap // length, count)
            taken = min(sequences, count // per)
            if taken < sequences:
                groups[gap].append((lengths, sequences - taken))
            groups[gap - per * length].append((lengths + (length,) * per, taken))
            count -= taken * per
    for bins in list(groups.values()):
        for lengths, sequences in bins:
            place(lengths, sequences)


# -- the job ---------------------------------------------------------------------------------


def pack(docs: DataFrame, vocabulary_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: one row per piece."""
    cut = written(pieces(docs, vocabulary_file, capacity), "packing_pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = written(counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "packing_counts")
    histogram = np.zeros(capacity + 1, np.int64)
    for row in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most capacity rows
        histogram[row["length"]] = row["n"]
    runs = sorted(plan(histogram, capacity))
    table = docs.sparkSession.sparkContext.broadcast(np.array(runs, np.int64).reshape(-1, 5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan_rows = table.value
        keys = plan_rows[:, 0] * 2**48 + plan_rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(keys, length * 2**48 + rank, side="right") - 1
            sequence = plan_rows[at, 3] + rank - plan_rows[at, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequence), pa.array(plan_rows[at, 4])], names=[*names, "sequence_id", "offset"]
            )

    # the counts grow with the partitions, so they are shuffled rather than broadcast
    ranked = cut.join(firsts.select("part", "length", "first").hint("merge"), ["part", "length"]).withColumn("rank", F.col("first") + F.col("place"))
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return ranked.mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
