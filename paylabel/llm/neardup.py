"""Near-duplicate detection with circulant MinHash and exact verification.

A document's set is its distinct word shingles (64-bit hashes of whole five-word windows).

1. *Circulant MinHash.*  One permutation (a 64-bit mixing bijection, of which the top bits
   are the place) scatters the shingles; a second one, a table over the places, is shifted
   circularly by 0, 1, .. K-1, and the minimum under each shift is a signature coordinate.
   Two permutations make the whole signature: a shingle's K table values are one contiguous
   slice.
2. *Classes.*  Documents with equal sets (128-bit digest) form one class; only its smallest
   id goes on.  Copies are thus never paired with each other.
3. *Banding.*  Each class has one key for each band of coordinates; rows and bands follow
   from the least linked similarity (``scheme``), at which a pair shares no key with
   probability MISS or less.
4. *Leaders.*  In every bucket each member is paired with the bucket's smallest member: at
   most one pair per class and band, whatever the bucket's size.  Pairs are confirmed by
   exact Jaccard over the full sets, and confirmed links give first components.
5. *The rest.*  Buckets that still span several components are open.  Open buckets that share
   members form regions, and each region is searched completely: its members outside the
   region's largest component against all its members, in cells of two blocks of bounded
   size.  A pair of different components whose signatures agree in at least ``agree`` of K
   coordinates (five standard deviations below the least linked similarity) is confirmed by
   exact Jaccard in the cell, which returns links only.  No partner or candidate is capped or
   dropped, and no pairs are emitted.
6. *Components* over the confirmed links give each document the smallest id it can reach.

Defined cases: a null or blank text has an empty set, is linked with nothing and kept; a text
of fewer than five words is one shingle; equal texts are linked; rows that repeat a doc_id
are one document, which takes part with each of its texts and reports the smallest component
and the largest set; a null doc_id comes out once, with a null component, and is kept; an
empty table gives no rows.  Only doc_id and the text column are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache, written
from .components import connected_components

WORDS = 5
#: Least linked similarity, in percent, where the caller names none.
PERCENT = 80
#: Probability that a pair at the least linked similarity shares one band, about, and none.
BAND, MISS = 0.35, 1.2e-5
PLACE_BITS = 22
#: Low bits of a coordinate that the signature comparison keeps.
BYTE = 0xFF
#: Members of one block of a complete bucket search.
BLOCK = 512
#: Shingles of such a block, about: bounds a cell's memory when documents are long.
BLOCK_ITEMS = 500_000
#: Partners that one route of a confirmed text serves, about.
PARTNERS = 256

# Odd multipliers of the hash of a window and of the mixing bijections.
STEP, MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Scheme(NamedTuple):
    percent: int
    rows: int
    bands: int

    @property
    def k(self) -> int:
        """Coordinates of a signature."""
        return self.rows * self.bands

    @property
    def agree(self) -> int:
        """Agreeing coordinates, five standard deviations below a pair at the least similarity."""
        mean = self.k * self.percent / 100
        return int(mean - 5 * (mean * (1 - self.percent / 100)) ** 0.5)


def scheme(percent: int = PERCENT) -> Scheme:
    """6 rows and 24 bands at 85 percent, 5 and 29 at 80."""
    if not 0 < percent < 100:
        raise ValueError(f"percent must lie between 1 and 99, not {percent}")
    rows = max(1, round(math.log(BAND) / math.log(percent / 100)))
    return Scheme(percent, rows, math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word windows; A-Z is lower-cased, white space is ASCII's."""
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    size = min(words, len(h))
    with np.errstate(over="ignore"):
        acc = np.zeros(len(h) - size + 1, np.uint64)
        for i in range(size):
            acc = mix(acc * STEP + h[i : len(h) - size + 1 + i])
    return np.unique(acc + np.uint64(size < words and size))


def second_permutation(shifts: int, places: int = 2**PLACE_BITS) -> np.ndarray:
    """The shifted permutation: a table over the places, wrapped so that every shift is a slice."""
    table = np.random.default_rng(20240917).permutation(places).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[: shifts - 1]]), shifts)


def signature(sets: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """One minimum for each shift; the first permutation is applied here."""
    with np.errstate(over="ignore"):
        places = mix(sets * STEP + MIX_B) >> np.uint64(64 - PLACE_BITS)
    out = np.full(windows.shape[1], np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(places), 1024):
        np.minimum(out, windows[places[i : i + 1024]].min(axis=0), out=out)
    return out


def band_keys(sig: np.ndarray, bands: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        acc = np.arange(1, bands + 1, dtype=np.uint64) * MIX_A
        for column in sig.reshape(bands, -1).T.astype(np.uint64):
            acc = mix(acc * STEP + column + np.uint64(1))
    return acc.view(np.int64)


def _sign(plan: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = worker_cache(f"circulant{plan.k}", lambda: second_permutation(plan.k))
        for batch in batches:
            sizes, digests, sigs, keys = [], [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text)
                sizes.append(len(s))
                if len(s):
                    sig = signature(s, windows)
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sigs.append((sig & BYTE).astype(np.uint8).tobytes())
                    keys.append(band_keys(sig, plan.bands))
                else:
                    digests.append(None)
                    sigs.append(None)
                    keys.append(np.empty(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = np.concatenate(keys) if keys else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc_id", "n_shingles", "digest", "sig", "keys"],
            )

    return run


def sign(docs: DataFrame, plan: Scheme) -> DataFrame:
    """doc_id, n_shingles, digest, sig (low bytes of the K coordinates), keys (bands)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(_sign(plan), "doc_id bigint, n_shingles bigint, digest binary, sig binary, keys array<bigint>")


def _route_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The set of each routed text; routes of one text are neighbours, so each is shingled once."""
    last_text, last = None, b""
    for batch in batches:
        items = []
        for text in batch.column("text").to_pylist():
            if text != last_text:
                last_text, last = text, shingles(text).tobytes()
            items.append(last)
        names = ["v", "salt", "lead", "doc"]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(items, pa.binary())], names=[*names, "items"])


def _compare(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by (v, salt), the set of v first: one leader set is held at a time."""
        at, leaders = None, {}
        for batch in batches:
            us, vs = [], []
            for v, salt, lead, doc, items in zip(*(batch.column(n).to_pylist() for n in ("v", "salt", "lead", "doc", "items"))):
                if at != (v, salt):
                    at, leaders = (v, salt), {}
                if lead:
                    leaders[hashlib.blake2b(items, digest_size=16).digest()] = np.frombuffer(items, np.uint64)
                    continue
                mine = np.frombuffer(items, np.uint64)
                for leader in leaders.values():
                    common = len(np.intersect1d(mine, leader, assume_unique=True))
                    if 100 * common >= percent * (len(mine) + len(leader) - common) and common:
                        us.append(doc)
                        vs.append(v)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def confirm(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose full sets have 100 * intersection >= percent * union.

    Each text goes to its partners' v, where v's own text stands first; a v with many partners
    is salted into routes of about PARTNERS each.
    """
    salts = pairs.groupBy("v").agg(F.count("*").alias("n")).select("v", F.ceil(F.col("n") / PARTNERS).cast("int").alias("n_salts"))
    members = pairs.join(salts, "v").select(
        F.col("u").alias("doc"), "v", F.pmod(F.xxhash64("u"), F.col("n_salts")).cast("int").alias("salt"), F.lit(False).alias("lead")
    )
    leads = salts.select(
        F.col("v").alias("doc"), "v", F.explode(F.sequence(F.lit(0), F.col("n_salts") - 1)).alias("salt"), F.lit(True).alias("lead")
    )
    routes = members.union(leads)
    routed = texts.join(routes.hint("merge"), texts["doc_id"] == routes["doc"]).select("v", "salt", "lead", "doc", "text")
    sets = routed.mapInArrow(_route_sets, "v bigint, salt int, lead boolean, doc bigint, items binary")
    ordered = sets.repartition("v", "salt").sortWithinPartitions("v", "salt", F.desc("lead"), "doc")
    return ordered.mapInArrow(_compare(percent), "u bigint, v bigint").distinct()


def _label(reps: DataFrame, components: DataFrame) -> DataFrame:
    """rep -> component, itself where no link is."""
    return reps.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        "rep", F.coalesce("component", "rep").alias("component")
    )


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        items = [shingles(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(items, pa.binary())], names=["rep", "items"])


def _search(plan: Scheme):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells of a region: each row holds a block of outsiders and a block of members."""
        for batch in batches:
            for row in batch.to_pylist():
                left, right = row["x"], row["y"]
                ls = np.frombuffer(b"".join(m["sig"] for m in left), np.uint8).reshape(-1, plan.k)
                rs = np.frombuffer(b"".join(m["sig"] for m in right), np.uint8).reshape(-1, plan.k)
                sets = [np.frombuffer(m["items"], np.uint64) for m in right]
                sizes = np.array([len(s) for s in sets])
                component = np.array([m["component"] for m in right], np.int64)
                root: dict[int, int] = {}

                def find(c: int) -> int:
                    while (up := root.get(c, c)) != c:
                        c = up
                    return c

                us, vs = [], []
                for k, x in enumerate(left):
                    mine = np.frombuffer(x["items"], np.uint64)
                    agree = (rs == ls[k]).sum(axis=1)
                    near = (agree >= plan.agree) & (100 * np.minimum(sizes, len(mine)) >= plan.percent * np.maximum(sizes, len(mine)))
                    for at in np.flatnonzero(near & (component != x["component"])):
                        a, b = find(x["component"]), find(int(component[at]))
                        if a == b:
                            continue
                        common = len(np.intersect1d(mine, sets[at], assume_unique=True))
                        if 100 * common >= plan.percent * (len(mine) + len(sets[at]) - common):
                            root[max(a, b)] = min(a, b)
                            us.append(x["component"])
                            vs.append(int(component[at]))
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return run


def _rest(members: DataFrame, reps: DataFrame, labels: DataFrame, texts: DataFrame, plan: Scheme) -> DataFrame:
    """Links (u, v) between first components whose members share an open bucket."""
    m = members.join(labels, "rep").join(labels.select(F.col("rep").alias("leader"), F.col("component").alias("home")), "leader")
    is_open = m.groupBy("key").agg(F.max((F.col("component") != F.col("home")).cast("int")).alias("open")).where("open = 1")
    ends = written(m.join(is_open.select("key"), "key").select("rep", "leader").distinct(), "neardup_open")
    regions = connected_components(ends, "rep", "leader").select(F.col("node").alias("rep"), F.col("component").alias("region"))
    regions = regions.join(labels, "rep").join(reps.groupBy("rep").agg(F.first("sig").alias("sig"), F.max("n").alias("n")), "rep")
    regions = written(regions, "neardup_regions")

    sizes = regions.groupBy("region", "component").agg(F.count("*").alias("n"), F.sum("n").alias("items"))
    sizes = sizes.groupBy("region").agg(
        F.max_by("component", F.struct("n", "component")).alias("home"),
        F.sum("n").alias("n_y"),
        F.sum("items").alias("items_y"),
        F.max(F.struct("n", "component", "items")).alias("most"),
    )
    blocks = lambda n, items: F.greatest(F.ceil(n / BLOCK), F.ceil(items / BLOCK_ITEMS)).cast("int")
    sizes = sizes.where(F.col("n_y") > F.col("most.n")).select(
        "region",
        "home",
        blocks(F.col("n_y") - F.col("most.n"), F.col("items_y") - F.col("most.items")).alias("bx"),
        blocks(F.col("n_y"), F.col("items_y")).alias("by"),
    )
    dealt = regions.join(sizes, "region")
    wanted = dealt.select("rep").hint("merge")
    items = texts.join(wanted, texts["doc_id"] == wanted["rep"]).select("rep", "text")
    items = items.mapInArrow(_items, "rep bigint, items binary")
    m = dealt.join(items, "rep")
    entry = F.struct("rep", "component", "sig", "items")
    spread = lambda seed, n: F.pmod(F.xxhash64("rep", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    m = written(m, "neardup_rest_items")
    x = m.where(F.col("component") != F.col("home")).select("region", every("by").alias("j"), spread(1, "bx").alias("i"), entry.alias("e"))
    y = m.select("region", spread(2, "by").alias("j"), every("bx").alias("i"), entry.alias("e"))
    x = x.groupBy("region", "i", "j").agg(F.collect_list("e").alias("x"))
    y = y.groupBy("region", "i", "j").agg(F.collect_list("e").alias("y"))
    return x.join(y, ["region", "i", "j"]).select("x", "y").mapInArrow(_search(plan), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document; sets link from ``percent`` Jaccard on."""
    plan = scheme(percent)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(sign(texts, plan), "neardup_signatures")

    reps = written(
        signed.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("keys").alias("keys"), F.max("n_shingles").alias("n")),
        "neardup_classes",
    )
    bands = reps.select("rep", F.explode("keys").alias("key"))
    buckets = bands.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).where("n > 1").select("key", "leader")
    members = written(bands.join(buckets, "key").distinct(), "neardup_members")

    first = members.where("rep <> leader").select(F.col("rep").alias("u"), F.col("leader").alias("v")).distinct()
    links = written(confirm(written(first, "neardup_pairs"), texts, percent), "neardup_links")
    labels = written(_label(reps.select("rep").distinct(), connected_components(links, "u", "v")), "neardup_labels")

    bridges = written(_rest(members, reps, labels, texts, plan), "neardup_bridges")
    joined = connected_components(bridges, "u", "v")
    final = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("root")), "component", "left").select(
        "rep", F.coalesce("root", "component").alias("component")
    )

    by_digest = reps.select("digest", "rep").join(final, "rep").select("digest", "component")
    out = signed.select("doc_id", "n_shingles", "digest").join(by_digest, "digest", "left")
    out = out.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component").alias("component_id"))
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
