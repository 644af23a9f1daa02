"""Rule tables of the first cascade layer and their column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylabel.functions.text import keyword_match, strip_accents

# Fixed values (must equal the reference's rule layer).
# Transaction type -> label code; transfer_in deliberately has no rule.
TYPE_RULES = {
    "bill_payment": "BIL",
    "mobile_topup": "BIL",
    "cashback": "FIN",
    "loan_repayment": "FIN",
    "opensaving": "FIN",
    "stock": "FIN",
    "qrcode_payment": "SHP",
}

# Label -> keywords, in priority order (label order first, then keyword order).
KEYWORD_RULES = [
    ("BIL", ["hoa don", "bill", "dien", "nuoc", "evn", "vnpt", "viettel", "internet", "cap quang"]),
    ("FOO", ["an uong", "do an", "am thuc", "cafe", "tra sua", "food", "nha hang", "com", "pizza", "bun", "pho"]),
    ("TRN", ["grab", "be ", "taxi", "xe bus", "bus", "metro", "samsung pay", "xang", "bot"]),
    ("HLT", ["benh vien", "hospital", "clinic", "thuoc", "y te"]),
    ("INS", ["bao hiem", "insurance", "thue", "tax"]),
    ("SHP", ["sieu thi", "mall", "aeon", "vinmart", "shop", "mua sam", "tiki", "lazada"]),
    ("ENT", ["xem phim", "cinema", "karoke", "karaoke", "game", "nhac", "giai tri"]),
    ("EDU", ["hoc phi", "university", "hoc", "khoa hoc", "education", "course"]),
    ("FIN", ["vay", "loan", "tiet kiem", "dau tu", "fin"]),
]

RULE_CONFIDENCE = 0.9


def ordered_keywords() -> list[tuple[int, str, str]]:
    """(priority, label, keyword) in evaluation order."""
    out, p = [], 0
    for label, kws in KEYWORD_RULES:
        for kw in kws:
            out.append((p, label, kw))
            p += 1
    return out


def type_rule(tranx_type: str | Column) -> Column:
    """Label for a transaction type, null when no rule (or null type)."""
    m = F.create_map(*[x for kv in TYPE_RULES.items() for x in (F.lit(kv[0]), F.lit(kv[1]))])
    t = F.col(tranx_type) if isinstance(tranx_type, str) else tranx_type
    return F.when(t.isNotNull(), m[t])


def keyword_hit_index(cleaned: Column) -> Column:
    """1-based position of the first matching keyword in priority order, 0 if none.

    The text is bound once, as the one element of an array, so that the optimizer cannot
    repeat its cleaning in every test, wherever it moves the expression.  A word is searched as plain
    text before its pattern is, and the first match ends the search.
    """

    def first(text: Column) -> Column:
        out = None
        for p, _, kw in ordered_keywords():
            hit, at = text.contains(kw) & keyword_match(text, kw), F.lit(p + 1)
            out = F.when(hit, at) if out is None else out.when(hit, at)
        return out.otherwise(F.lit(0))

    return F.get(F.transform(F.array(cleaned), first), 0)


def apply_rules(df: DataFrame, msg: str, tranx_type: str, label_codes: list[str] | None = None, out: str = "rule") -> DataFrame:
    """Adds struct ``out`` = (success, label, reason) of the rule layer.

    The cleaned text and the keyword hit index are separate projections and each is bound
    once where it is used: inlined into a filter, an expression is repeated for each of its
    references, and the text was cleaned anew for every keyword.
    ``label_codes`` gates the type rule the way the reference checks
    membership in its label map.
    """
    t = F.col(tranx_type)
    by_type = type_rule(t)
    if label_codes is not None:
        by_type = F.when(F.array_contains(F.array(*[F.lit(c) for c in label_codes]), by_type), by_type)
    staged = (
        df.withColumn("_rule_clean", strip_accents(F.coalesce(F.col(msg), F.lit(""))))
        .withColumn("_rule_type", by_type)
        # rows that the type decides test no keyword
        .withColumn("_rule_kw", F.when(F.col("_rule_type").isNull(), keyword_hit_index(F.col("_rule_clean"))))
    )
    labels = F.array(*[F.lit(lbl) for _, lbl, _ in ordered_keywords()])
    words = F.array(*[F.lit(kw) for _, _, kw in ordered_keywords()])

    def decided(kw: Column) -> Column:
        return (
            F.when(
                F.col("_rule_type").isNotNull(),
                F.struct(F.lit(True).alias("success"), F.col("_rule_type").alias("label"), F.concat(F.lit("Matched tranx_type="), t).alias("reason")),
            )
            .when(
                kw > 0,
                F.struct(
                    F.lit(True).alias("success"),
                    F.element_at(labels, kw).alias("label"),
                    F.concat(F.lit("Keyword match '"), F.element_at(words, kw), F.lit("'")).alias("reason"),
                ),
            )
            .otherwise(F.struct(F.lit(False).alias("success"), F.lit(None).cast("string").alias("label"), F.lit("No rule matched").alias("reason")))
        )

    # the hit is bound once too: a filter on the result, moved to the scan, tests the words once
    res = F.get(F.transform(F.array("_rule_kw"), decided), 0)
    return staged.withColumn(out, res).drop("_rule_clean", "_rule_kw", "_rule_type")
