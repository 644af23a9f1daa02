"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, adjacent turns of one role are
merged into a block, and the blocks are concatenated:

    ### user:
    first text<next/>second text of the same role</turn>
    ### assistant:
    answer</turn>

Texts (and roles) are escaped so that neither ``#`` nor ``<`` ever stands in them: ``\\``
becomes ``\\b``, ``#`` becomes ``\\h`` and ``<`` becomes ``\\l`` (in roles also ``:`` becomes
``\\c``).  A marker is thus never part of a text, and the escape is undone exactly by three
plain replacements.  The loss mask is an array of code-point spans (start, end exclusive)
over the formatted string: one span per non-empty assistant text, nothing of the template.

Defined cases: a null text is empty and a null role is the role ''; turns are ordered by
(turn, role, text), a null turn first; repeated rows are repeated turns; rows without
conv_id form one conversation whose id is null; an empty table gives no row.  Only conv_id,
turn, role and text are read, so further columns cannot clash.  A conversation is one output
row, so it must fit a Spark row (2 GB).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's markers.
HEAD, HEAD_END, NEXT, END = "### ", ":\n", "<next/>", "</turn>\n"

LOSS_ROLE = "assistant"


def _plain_replace(col: Column, pairs: list[tuple[str, str]]) -> Column:
    for old, new in pairs:
        col = F.replace(col, F.lit(old), F.lit(new))
    return col


def escape(text: Column) -> Column:
    return _plain_replace(text, [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")])


def unescape(text: Column) -> Column:
    return _plain_replace(text, [("\\l", "<"), ("\\h", "#"), ("\\b", "\\")])


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(":"), F.lit("\\c"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\c"), F.lit(":")))


def indices(n: Column) -> Column:
    """0, 1, .. n-1; an empty array for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def sum_longs(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda acc, x: acc + x)


def exclusive_prefix_sums(values: Column) -> Column:
    """Running sums before each element, in chunks of sqrt(n): O(n sqrt n) without appending to an array."""
    n = F.size(values)
    width = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
    chunk_sums = F.transform(indices(F.ceil(n / width)), lambda c: sum_longs(F.slice(values, c * width + 1, width)))
    return F.transform(
        indices(n),
        lambda i: sum_longs(F.slice(chunk_sums, 1, F.floor(i / width).cast("int")))
        + sum_longs(F.slice(values, F.floor(i / width).cast("int") * width + 1, i % width)),
    )


def collect_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turns array<struct<turn, role, text>> in order."""
    turn = F.struct(
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    return conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def _over(df: DataFrame, name: str, make: Callable[[], Column]) -> DataFrame:
    return df.withColumn(name, make())


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans array<struct<start, end>>."""
    c = F.col
    df = collect_turns(conversations)
    n = F.size("turns")
    df = df.withColumn(
        "starts",
        F.filter(indices(n), lambda i: (i == 0) | (c("turns")[i]["role"] != c("turns")[F.greatest(i - 1, F.lit(0))]["role"])),
    )
    df = df.withColumn(
        "blocks",
        F.transform(
            "starts",
            lambda s, k: F.struct(
                c("turns")[s]["role"].alias("role"),
                F.slice(
                    c("turns"),
                    s + 1,
                    F.when(k + 1 < F.size("starts"), F.get(c("starts"), k + 1)).otherwise(n) - s,
                ).alias("turns"),
            ),
        ),
    )

    def segments(block: Column) -> Column:
        head = F.struct(F.concat(F.lit(HEAD), escape_role(block["role"]), F.lit(HEAD_END)).alias("text"), F.lit(False).alias("loss"))
        body = F.transform(
            block["turns"],
            lambda t, i: F.array(
                F.struct(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)).alias("text"), F.lit(False).alias("loss")),
                F.struct(escape(t["text"]).alias("text"), (block["role"] == LOSS_ROLE).alias("loss")),
            ),
        )
        end = F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss"))
        return F.concat(F.array(head), F.flatten(body), F.array(end))

    df = df.select("conv_id", F.flatten(F.transform("blocks", segments)).alias("segments"))
    df = df.withColumn("lens", F.transform("segments", lambda s: F.length(s["text"]).cast("bigint")))
    df = df.withColumn("offsets", exclusive_prefix_sums(c("lens")))
    spans = F.transform(
        F.filter(indices(F.size("segments")), lambda i: c("segments")[i]["loss"] & (c("lens")[i] > 0)),
        lambda i: F.struct(c("offsets")[i].alias("start"), (c("offsets")[i] + c("lens")[i]).alias("end")),
    )
    return df.select("conv_id", F.array_join(c("segments")["text"], "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>>: the turns that a formatted string holds, in order."""
    blocks = F.filter(F.split(formatted, END, -1), lambda b: b != "")
    per_block = F.transform(
        blocks,
        lambda b: F.transform(
            F.split(F.substring(b, F.locate(HEAD_END, b) + len(HEAD_END), F.length(b)), NEXT, -1),
            lambda t: F.struct(
                unescape_role(F.substring(b, F.lit(len(HEAD) + 1), F.locate(HEAD_END, b) - len(HEAD) - 1)).alias("role"),
                unescape(t).alias("text"),
            ),
        ),
    )
    return F.flatten(per_block)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped."""
    parts = F.transform(spans, lambda s: F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return unescape(F.array_join(parts, ""))
