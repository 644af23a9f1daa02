"""Secret scans: fixed patterns, and a randomness test battery with false-discovery control.

Base spans come from three patterns (assign, access, hex).  The battery looks at every
maximal run of key characters of MIN_LENGTH or more and adds spans of kind ``random``:

1. An encoding (hex, base32, base36, base62 or base64) is inferred: the smallest alphabet
   that holds the run's symbols; - and _ may part them (as in a UUID) and say nothing.
2. The null hypothesis of the battery is ordinary text of that encoding: a first-order model of
   symbols and pairs, counted by Spark in the distinct words of every text of the table, outside
   base spans and the runs under test (whose own pairs would hide them), folded to the alphabet's case and
   restricted to its symbols.  A prior of PRIOR pairs per symbol, which changes character class
   at TEXT_CHANGE_RATE, stands in where a table is small.
3. Each of the three tests weighs "drawn uniformly" against that null on what it looks at:
   chi-squared the symbols within their classes, runs the changes of side about the alphabet's
   middle, serial the adjacent pairs.  Each weight is a likelihood ratio with mean 1 under the
   null (for the symbols, if they are independent given their class).  The geometric mean of
   the three then has a mean of 1 at most, however they depend on each other, so its inverse
   is a p-value at any length; a fluke of one test does not outweigh the other two.
4. The same three statistics tested against uniformity itself reject repeated, sequential or
   worded runs at BATTERY_ALPHA: unlike text is not enough.
5. Benjamini-Hochberg at FDR over all runs of the table, within length strata, so that the
   many short runs do not set the bar for long ones.  P-values enter as integer decibel
   grades (rounded up to the less significant side), so the corpus-wide count is a table of
   at most strata x grades rows, whatever the input.

A run that overlaps a base span adds nothing; base spans always stay.

Defined cases: a null text is empty; texts of any length are scanned whole; of overlapping base spans of two kinds both
stay, and spans that start together are in the order of the kinds; positions are code points, ends exclusive; repeated
rows give repeated results; an empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_VALUE = 6
KINDS = ("assign", "access", "hex", "random")

#: Every assignment holds this; texts without it skip the slower pattern.
ASSIGN_SIGN = re.compile(r"""[:=]\x20*["']?[A-Za-z0-9+/_.=-]""")
MIN_LENGTH = 16
RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)

BATTERY_ALPHA = 0.003
TEXT_CHANGE_RATE = 0.2
#: Pairs per symbol that the text model's prior counts for.
PRIOR = 50
FDR = 0.01
STRATA = (16, 20, 24, 32, 40, 48, 64, 96, 128, 256)
MAX_GRADE = 3000

HEX_LOWER, HEX_UPPER = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36_LOWER, BASE36_UPPER = "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
BASE64 = BASE62 + "+/-_"
ALPHABETS = [
    ("hex", HEX_LOWER),
    ("hex", HEX_UPPER),
    ("base32", BASE32),
    ("base32", BASE32.lower()),
    ("base36", BASE36_LOWER),
    ("base36", BASE36_UPPER),
    ("base62", BASE62),
    ("base64", BASE64),
]
PLACE = {c: i for i, c in enumerate(BASE64)}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start and then kind as listed."""
    spans = []
    if ASSIGN_SIGN.search(text):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_VALUE]
    spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def infer_encoding(run: str) -> tuple[str, str]:
    """The smallest alphabet that holds the run; - and _ may stand between its parts."""
    symbols = set(run) - set("-_")
    for name, alphabet in ALPHABETS:
        if symbols <= set(alphabet):
            if name == "base64":  # without the signs of the other, url-safe pair, which are separators here
                alphabet = BASE62 + "+/"
            return name, alphabet
    return "base64", BASE64


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def chi_squared_p(counts: list[int], k: int, n: int) -> float:
    """Upper tail of the uniformity statistic, Wilson-Hilferty approximation."""
    expected = n / k
    statistic = sum(c * c for c in counts) / expected - n
    df = k - 1
    z = ((statistic / df) ** (1 / 3) - (1 - 2 / (9 * df))) / math.sqrt(2 / (9 * df)) if statistic > 0 else -9.0
    return normal_tail(z)


def runs_p(values: list[int], k: int) -> float:
    """Two-sided Wald-Wolfowitz test about the alphabet's middle."""
    above = [2 * v >= k for v in values]
    n1 = sum(above)
    n2 = len(above) - n1
    if not n1 or not n2:
        return 2.0 ** (1 - len(above))
    n = n1 + n2
    runs = 1 + sum(a != b for a, b in zip(above, above[1:]))
    mean = 1 + 2 * n1 * n2 / n
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return 2 * normal_tail(abs(runs - mean) / math.sqrt(variance)) if variance > 0 else 1.0


def serial_p(values: list[int]) -> float:
    """Two-sided lag-one serial correlation test."""
    n = len(values)
    mean = sum(values) / n
    spread = sum((v - mean) ** 2 for v in values)
    if not spread:
        return 0.0
    r = sum((a - mean) * (b - mean) for a, b in zip(values, values[1:])) / spread
    return 2 * normal_tail(abs(r + 1 / n) * math.sqrt(n))


def is_uniform(run: str, alphabet: str) -> bool:
    place = {c: i for i, c in enumerate(alphabet)}
    values = [place[c] for c in run if c in place]
    if len(values) < 2:
        return False
    k = len(alphabet)
    tests = (chi_squared_p(list(Counter(values).values()), k, len(values)), runs_p(values, k), serial_p(values))
    return min(tests) >= BATTERY_ALPHA


def class_of(c: str) -> int:
    return 0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if "0" <= c <= "9" else 3


class TextModel:
    """Ordinary text as the null: what each test gains by "uniform" over it, per alphabet."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.pairs, self.gains = pairs, {}

    def __getstate__(self) -> dict:
        return {"pairs": self.pairs, "gains": {}}

    def of(self, alphabet: str) -> tuple[dict[str, int], list[float], list[list[float]], list[list[float]]]:
        """Places of the symbols; log gains by symbol, by symbol and next side, by symbol and next symbol."""
        if alphabet not in self.gains:
            k, place = len(alphabet), {c: i for i, c in enumerate(alphabet)}
            fold = str.lower if alphabet.islower() else str.upper if alphabet.isupper() else str
            to = [place.get(fold(c), -1) for c in BASE64]
            counts = np.zeros((k, k))
            for (a, b), n in self.pairs.items():
                if to[a] >= 0 and to[b] >= 0:
                    counts[to[a], to[b]] += n
            kinds = np.array([class_of(c) for c in alphabet])
            same = kinds[:, None] == kinds[None, :]
            size = same.sum(1)
            others = np.maximum(k - size, 1)
            prior = np.where(same, (1 - TEXT_CHANGE_RATE * (size < k))[:, None] / size[:, None], TEXT_CHANGE_RATE / others[:, None])
            p = (counts + PRIOR * prior) / (counts.sum(1, keepdims=True) + PRIOR)
            high = 2 * np.arange(k) >= k
            sides = np.stack([p[:, ~high].sum(1), p[:, high].sum(1)], 1)
            uniform = np.array([np.mean(~high), np.mean(high)])
            seen = counts.sum(0) + PRIOR / k
            within = seen / (same @ seen)
            self.gains[alphabet] = (
                place,
                (-np.log(size) - np.log(within)).tolist(),
                (np.log(uniform) - np.log(sides)).tolist(),
                (-np.log(k) - np.log(p)).tolist(),
            )
        return self.gains[alphabet]

    def grade(self, run: str, alphabet: str) -> int:
        """-10 log10 of the battery's p-value under text, rounded down: higher is less like text."""
        place, by_symbol, by_side, by_pair = self.of(alphabet)
        k = len(alphabet)
        values = [place.get(c, -1) for c in run]  # a sign that is not in the alphabet parts its neighbours
        pairs = [(a, b) for a, b in zip(values, values[1:]) if a >= 0 and b >= 0]
        logs = (
            sum(by_symbol[v] for v in values if v >= 0),
            sum(by_side[a][2 * b >= k] for a, b in pairs),
            sum(by_pair[a][b] for a, b in pairs),
        )
        return min(MAX_GRADE, max(0, int(10 * sum(logs) / len(logs) / math.log(10))))


def stratum_of(length: int) -> int:
    return max(s for s in STRATA if s <= length)


def random_runs(text: str, model: TextModel) -> list[tuple[int, int, int, int]]:
    """(start, end, stratum, grade) of every run; grade 0 where the battery rejects it."""
    out = []
    for m in RUN.finditer(text):
        run = m.group().rstrip("=")
        if len(run) < MIN_LENGTH:
            continue
        alphabet = infer_encoding(run)[1]
        grade = model.grade(run, alphabet)
        if grade and not is_uniform(run, alphabet):
            grade = 0
        out.append((m.start(), m.end(), stratum_of(len(run)), grade))
    return out


#: Number of each symbol by its byte, from 1; 0 for all others.
BYTES = np.zeros(256, np.int64)
for _c, _i in PLACE.items():
    BYTES[ord(_c)] = _i + 1
SIDE = len(BASE64) + 1


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adjacent symbols of ordinary text: one row per pair that the partition holds."""
    counts = np.zeros(SIDE * SIDE, np.int64)
    for batch in batches:
        for text in batch.column("text").to_pylist():
            text = text or ""
            parts, at = [], 0
            for start, end in sorted([(s, e) for s, e, _ in base_spans(text)] + [m.span() for m in RUN.finditer(text)]):
                if start > at:
                    parts.append(text[at:start])
                at = max(at, end)
            parts.append(text[at:])
            # the distinct words of each text: one that it repeats says no more about the language
            parts = set(" ".join(parts).split())
            codes = BYTES[np.frombuffer(" ".join(parts).encode(errors="replace"), np.uint8)]
            counts += np.bincount(codes[:-1] * SIDE + codes[1:], minlength=SIDE * SIDE)
    counts = counts.reshape(SIDE, SIDE)[1:, 1:]
    a, b = counts.nonzero()
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(counts[a, b])], names=["a", "b", "n"])


def text_model(docs: DataFrame) -> TextModel:
    """The model of the whole table."""
    counts = docs.select("text").mapInArrow(_pairs, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    return TextModel({(r["a"], r["b"]): r["n"] for r in counts.collect()})  # at most one row per pair of symbols


def clear_of(spans: list[tuple[int, int, str]], start: int, end: int) -> bool:
    return all(end <= s or e <= start for s, e, _ in spans)


SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("kind", T.StringType())])
RUN_TYPE = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "end", "stratum", "grade")])
ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
ARROW_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "end", "stratum", "grade")]))


def scan(docs: DataFrame, model: TextModel) -> DataFrame:
    """doc_id, base spans and graded runs of every whole text."""
    doc_id = docs.schema["doc_id"]
    schema = T.StructType([doc_id, T.StructField("base", T.ArrayType(SPAN)), T.StructField("runs", T.ArrayType(RUN_TYPE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, runs = [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text or "")
                base.append([{"start": s, "end": e, "kind": k} for s, e, k in spans])
                runs.append([dict(zip(("start", "end", "stratum", "grade"), r)) for r in random_runs(text or "", model)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, ARROW_SPANS), pa.array(runs, ARROW_RUNS)], names=["doc_id", "base", "runs"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def thresholds(scanned: DataFrame, fdr: float = FDR) -> dict[int, int]:
    """Benjamini-Hochberg: the least grade that is a discovery, for each length stratum that has one."""
    counts = (
        scanned.select(F.explode("runs").alias("r"))
        .groupBy(F.col("r.stratum").alias("stratum"), F.col("r.grade").alias("grade"))
        .agg(F.count("*").alias("n"))
        .collect()  # at most len(STRATA) x (MAX_GRADE + 1) rows
    )
    found: dict[int, int] = {}
    for stratum in sorted({r["stratum"] for r in counts}):
        grades = sorted(((r["grade"], r["n"]) for r in counts if r["stratum"] == stratum), reverse=True)
        total, seen = sum(n for _, n in grades), 0
        for grade, n in grades:
            seen += n
            if grade > 0 and 10 ** (-grade / 10) <= fdr * seen / total:
                found[stratum] = grade
    return found


def with_random(base: list, runs: list, least: dict[int, int]) -> list[tuple[int, int, str]]:
    """Base spans and the runs that are discoveries, by start and then kind."""
    spans = [(s["start"], s["end"], s["kind"]) for s in base or []]
    spans += [
        (r["start"], r["end"], "random")
        for r in runs or []
        if r["grade"] and r["grade"] >= least.get(r["stratum"], MAX_GRADE + 1) and clear_of(spans, r["start"], r["end"])
    ]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def find_secrets(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, spans array<struct<start, end, kind>> of every document."""
    scanned = written(scan(docs, text_model(docs)), "secret_runs")
    least = thresholds(scanned, fdr)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [
                [{"start": s, "end": e, "kind": k} for s, e, k in with_random(base, runs, least)]
                for base, runs in zip(batch.column("base").to_pylist(), batch.column("runs").to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(spans, ARROW_SPANS)], names=["doc_id", "spans"])

    schema = T.StructType([scanned.schema["doc_id"], T.StructField("spans", T.ArrayType(SPAN))])
    return scanned.mapInArrow(run, schema)


def redact(docs: DataFrame, mark: str = "[SECRET]", fdr: float = FDR) -> DataFrame:
    """docs with every secret in the text replaced by a mark, and n_chars, if present, to match.

    One pass over the texts counts the text model, the next keeps only graded runs, for the
    thresholds; the last one rewrites the texts, so no text is shuffled.  Overlapping spans become one mark; a null
    text stays null.
    """
    model = text_model(docs)
    least = thresholds(written(scan(docs, model), "secret_runs"), fdr)
    names = docs.columns

    def clean(text: str) -> str:
        runs = [dict(zip(("start", "end", "stratum", "grade"), r)) for r in random_runs(text, model)]
        base = [{"start": s, "end": e, "kind": k} for s, e, k in base_spans(text)]
        out, at = [], 0
        for start, end, _ in with_random(base, runs, least):
            if end <= at:
                continue
            if start >= at:
                out += [text[at:start], mark]
            at = end
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(n) for n in names}
            texts = [None if t is None else clean(t) for t in columns["text"].to_pylist()]
            columns["text"] = pa.array(texts, pa.string())
            if "n_chars" in columns:
                lengths = [old if t is None else len(t) for t, old in zip(texts, columns["n_chars"].to_pylist())]
                columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    return docs.mapInArrow(run, docs.schema)

