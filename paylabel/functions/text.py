"""Accent stripping and whole-word keyword matching.

``strip_accents`` is lower-case + NFKD + removal of combining marks.  Spark has
no NFKD function, so most rows take one JVM ``translate`` whose table is
generated from Python's own ``unicodedata`` by rule: every BMP character whose
NFKD form, minus combining marks, is a single different character maps to it,
and every combining mark is deleted.  Only rows that hold a character beyond
such a table (ligatures such as ``ﬁ``, Hangul syllables, mathematical letters)
send their text through the real normalisation, an Arrow-batched pandas UDF.
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


def strip_accents_py(text: str) -> str:
    nfkd = unicodedata.normalize("NFKD", text.lower())
    return "".join(c for c in nfkd if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _translate_table() -> tuple[str, str]:
    src, dst, marks = [], [], []
    for cp in range(0x80, 0x10000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF:
            continue
        if unicodedata.combining(ch):
            marks.append(ch)
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if len(base) == 1 and base != ch:
            src.append(ch)
            dst.append(base)
    # characters listed in src beyond len(dst) are deleted by translate
    return "".join(src) + "".join(marks), "".join(dst)


def _java_class(spans: list[list[int]], negated: bool = False) -> str:
    return ("[^" if negated else "[") + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in spans) + "]"


@lru_cache(maxsize=1)
def _beyond_spans() -> list[list[int]]:
    """The characters whose stripped form the table cannot give."""
    spans: list[list[int]] = []
    for cp in range(0x80, 0x30000):
        ch = chr(cp)
        if 0xD800 <= cp <= 0xDFFF or (cp < 0x10000 and unicodedata.combining(ch)):
            continue
        base = "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))
        if base != ch and (cp >= 0x10000 or len(base) != 1):
            if spans and spans[-1][1] == cp - 1:
                spans[-1][1] = cp
            else:
                spans.append([cp, cp])
    return spans


#: Blocks whose characters most texts are written in: Latin and its accented letters.
USUAL_BLOCKS = ((0x00, 0x24F), (0x1E00, 0x1EFF))


@lru_cache(maxsize=1)
def _unusual_class() -> str:
    """Java class, of few spans, that holds every character beyond the table: what is not in the usual blocks, or is beyond."""
    usual: list[list[int]] = []
    for first, last in USUAL_BLOCKS:
        at = first
        for a, b in [*(s for s in _beyond_spans() if first <= s[0] <= last), [last + 1, last + 1]]:
            if a > at:
                usual.append([at, a - 1])
            at = b + 1
    return _java_class(usual, negated=True)


def strip_accents(c: str | Column) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    src, dst = _translate_table()
    # null for the rows that translate serves: their texts never leave the JVM
    # (the long class is tested only where the short one, which holds it, was met)
    rest = F.when(column.rlike(_unusual_class()) & column.rlike(_java_class(_beyond_spans())), column)
    return F.coalesce(_strip_exact(rest), F.translate(F.lower(column), src, dst))


@pandas_udf(StringType())
def _strip_exact(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else strip_accents_py(t))


def keyword_pattern(keyword: str) -> str:
    """Java regex for a whole word/phrase match, Unicode-aware word class."""
    return "(?U)(?<!\\w)" + re.escape(keyword).replace("\\ ", " ") + "(?!\\w)"


def keyword_match(c: str | Column, keyword: str) -> Column:
    column = F.col(c) if isinstance(c, str) else c
    return column.rlike(keyword_pattern(keyword))


def duckdb_keyword_regex(keyword: str) -> str:
    """The same test for the DuckDB oracle (RE2 has no look-behind)."""
    return "(^|[^\\p{L}\\p{N}_])" + re.escape(keyword).replace("\\ ", " ") + "($|[^\\p{L}\\p{N}_])"
