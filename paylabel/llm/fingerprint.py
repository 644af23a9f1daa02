"""Document fingerprints: a Merkle tree over paragraphs and sections, in Spark expressions only.

A text is cut into sections at blank lines, into paragraphs at line ends, and into leaves after white space that follows
certain characters or after LEAF_CHARS characters, so that most cuts do not depend on what
stands elsewhere; no cut loses anything, so a tree stands for exactly one text.  A leaf's digest is a 64-bit hash of
its piece, a paragraph's the SHA-256 of its leaves' digests, a section's that of its paragraphs', and the root's that of its sections'.
Equal roots mean equal texts; where roots differ, ``differing`` walks down the differing
branches to the paragraphs that were edited, and ``edits`` says how many there are and where the first one stands.

Leaves under equal branches are equal, so two trees share those and what their differing branches
share: the likeness is the Dice coefficient of the distinct leaves (by 32 bits of their digests),
1 if the roots are equal.  The fingerprint string is the root's first 32 digits, a colon,
and the distinct leaves in order, 8 digits each.

Neighbours in descending doc_id are found with one shuffle: a job over the ids alone gives the
bounds of ranges (one row per range reaches the driver), documents go to their range, the
first document of each range also to the range before, and a window looks one row ahead.

Defined cases: a null text is empty; an empty text has one empty section, paragraph and
leaf; texts of any length are one tree in one row; rows that repeat a doc_id follow each other, ordered by text; a null doc_id stands
below all others; a single document is its own next one; an empty table gives no rows; only
doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of ids per shuffle partition.
RANGES_PER_PARTITION = 3
LEAF_CHARS = 48
#: White space after one of these characters ends a leaf and belongs to it; no leaf is longer than LEAF_CHARS.
LEAF_END = r"(?s)(?<=[adhlptx.,:;!?|)\]}0-9]\s)|(?<=\G.{" + str(LEAF_CHARS) + "})"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def sections(text: Column) -> Column:
    """array<struct<digest, paragraphs array<struct<digest, leaves array<bigint>>>>>: the levels below the root."""
    leaves = F.transform(
        F.split(text, "\n\n", -1),
        lambda s: F.transform(F.split(s, "\n", -1), lambda p: F.transform(F.split(p, LEAF_END, -1), lambda piece: F.xxhash64(piece))),
    )
    paragraphs = F.transform(
        leaves,
        lambda s: F.transform(s, lambda p: F.struct(_sha(F.array_join(F.transform(p, lambda x: F.lpad(F.hex(x), 16, "0")), "")).alias("digest"), p.alias("leaves"))),
    )
    return F.transform(paragraphs, lambda ps: F.struct(_sha(F.array_join(F.transform(ps, lambda p: p["digest"]), "")).alias("digest"), ps.alias("paragraphs")))


def root(tree: Column) -> Column:
    return _sha(F.array_join(F.transform(tree, lambda s: s["digest"]), ""))


def differing(left: Column, right: Column) -> Column:
    """array<struct<section, paragraph>> of the positions (from 0) whose paragraphs differ between two trees."""
    none = F.array().cast("array<string>")
    at = lambda tree, i: F.coalesce(F.transform(F.get(tree, i)["paragraphs"], lambda p: p["digest"]), none)
    steps = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    branches = F.filter(
        steps(F.greatest(F.size(left), F.size(right))),
        lambda i: ~F.get(left, i)["digest"].eqNullSafe(F.get(right, i)["digest"]),
    )
    return F.flatten(
        F.transform(
            branches,
            lambda i: F.transform(
                F.filter(
                    steps(F.greatest(F.size(at(left, i)), F.size(at(right, i)))),
                    lambda j: ~F.get(at(left, i), j).eqNullSafe(F.get(at(right, i), j)),
                ),
                lambda j: F.struct(i.alias("section"), j.alias("paragraph")),
            ),
        )
    )


def edits(positions: Column) -> Column:
    """struct<n, section, paragraph>: how many paragraphs ``differing`` found, and the first one (null if none)."""
    first = F.get(positions, 0)
    return F.struct(F.size(positions).alias("n"), first["section"].alias("section"), first["paragraph"].alias("paragraph"))


def leaves(tree: Column) -> Column:
    """The distinct leaves, 32 bits of each."""
    short = F.transform(tree, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: F.transform(p["leaves"], lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))))))
    return F.array_distinct(F.flatten(short))


def as_string(root_digest: Column, leaf_digests: Column) -> Column:
    digits = F.transform(leaf_digests, lambda t: F.lpad(F.hex(t), 8, "0"))
    return F.concat(F.substring(root_digest, 1, 32), F.lit(":"), F.lower(F.array_join(digits, "")))


def likeness(left_root: Column, left_leaves: Column, right_root: Column, right_leaves: Column) -> Column:
    shared = F.size(F.array_intersect(left_leaves, right_leaves)).cast("double")
    return F.when(left_root == right_root, F.lit(1.0)).otherwise(2 * shared / (F.size(left_leaves) + F.size(right_leaves)))


def with_tree(docs: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Adds the tree of a text column, its root and its distinct leaves."""
    tree = docs.withColumn(f"{prefix}sections", sections(F.col(text)))
    return tree.withColumn(f"{prefix}root", root(F.col(f"{prefix}sections"))).withColumn(f"{prefix}leaves", leaves(F.col(f"{prefix}sections")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, sections, root, leaves of every whole text."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return with_tree(base.withColumn("n_chars", F.length("text").cast("bigint")), "text")


def range_heads(keys: DataFrame, ranges: int) -> list[int]:
    """The greatest key of each of at most ``ranges`` ranges of about equal size, descending."""
    dealt = keys.repartitionByRange(ranges, F.desc("key")).groupBy(F.spark_partition_id().alias("range"))
    return sorted({r["head"] for r in dealt.agg(F.max("key").alias("head")).collect()}, reverse=True)  # one row per range


def range_of(key: Column, heads: list[int]) -> Column:
    """The number of the range that holds a key: a coarse search, then a fine one."""
    step = max(1, int(len(heads) ** 0.5))
    reached = lambda some: F.size(F.filter(some, lambda h: h >= key))
    coarse = reached(F.lit(heads[::step])) - 1
    return coarse * step + reached(F.slice(F.lit(heads), coarse * step + 1, F.lit(step))) - 1


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_chars of each document and ``next``, the text of its neighbour in descending doc_id.

    Rows go to the range of their id, and the rows of a range's greatest id also, as guests,
    to the end of the range before (the first range's to the last): one shuffle, no join.
    """
    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    own = own.withColumn("n_chars", F.length("text").cast("bigint"))
    key = F.coalesce(F.col("doc_id"), F.lit(-(2**63)))
    ranges = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    heads = range_heads(docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("key")), ranges) or [0]
    home = range_of(key, heads)
    seat = lambda at, guest: F.struct(at.alias("range"), F.lit(guest).alias("guest"))
    seats = F.when(
        F.get(F.lit(heads), F.col("home")) == key,
        F.array(seat(F.col("home"), 0), seat(F.pmod(F.col("home") - 1, F.lit(len(heads))), 1)),
    ).otherwise(F.array(seat(F.col("home"), 0)))
    seated = own.withColumn("home", home).withColumn("seat", F.explode(seats)).drop("home").select("*", "seat.range", "seat.guest").drop("seat")
    order = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("doc_id"), "text")
    following = F.lead("text").over(order)
    return seated.withColumn("next", following).where("guest = 0").drop("range", "guest")


def with_edits(docs: DataFrame) -> DataFrame:
    """Each document beside its edited text (its second half replaced by the next document's start) and likenesses."""
    both = with_next(docs)
    edit = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - edit).cast("int")), F.substring(F.col("next"), F.lit(1), edit))
    both = with_tree(with_tree(with_tree(both.withColumn("edited", edited), "text"), "edited", "edited_"), "next", "next_")
    both = both.withColumn("edit", edits(differing(F.col("sections"), F.col("edited_sections"))))
    return both.select(
        "doc_id",
        "n_chars",
        _sha(F.col("edited")).alias("edited_sha256"),
        as_string(F.col("root"), F.col("leaves")).alias("fingerprint"),
        as_string(F.col("edited_root"), F.col("edited_leaves")).alias("edited_fingerprint"),
        likeness(F.col("root"), F.col("leaves"), F.col("edited_root"), F.col("edited_leaves")).alias("near_edited"),
        likeness(F.col("root"), F.col("leaves"), F.col("next_root"), F.col("next_leaves")).alias("near_next"),
        F.col("edit.n").alias("n_differing"),
        F.col("edit.section").alias("first_section"),
        F.col("edit.paragraph").alias("first_paragraph"),
    )
