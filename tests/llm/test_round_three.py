"""Tokenizer alignment, ball-tree search and the metric join against brute force, and on their defined cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from paylabel.llm import align, balltree, metricjoin
from paylabel.llm.common import bounded_batches

A_FILE, B_FILE = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
ODD = [None, "", " \t\n", "one", "a b c", "A\nb  c", "Gleich " * 30, "Gleich " * 30, "x" * 20_000, "é ß 日本 \U0001f600 \x00", "NOID"]
DOCS = "doc_id long, text string, item_id long, score double, rep long, chunk string"


@pytest.fixture(scope="module", autouse=True)
def _small_batches(spark):
    bounded_batches(spark)


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(None if t == "NOID" else first + i, t, 1, 1.0, 2, "c") for i, t in enumerate(texts)], DOCS)


# -- alignment -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A_FILE)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=B_FILE)
    return a, b


def brute_alignment(tokenizers, texts):
    a, b = tokenizers
    alphabet = align.byte_alphabet()
    raw_a = {i: bytes(alphabet[c] for c in t) for t, i in a.get_vocab(False).items()}
    raw_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    docs, counts = [], Counter()
    for text in texts:
        text = "" if text is None else text
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw = (" " + text).encode()
        if not text or b"".join(raw_a[i] for i in ids_a) != raw or b"".join(map(raw_b, ids_b)) != raw:
            docs.append(((0, 0, 0), [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(raw_a[i]) for i in ids_a]).tolist(), np.cumsum([len(raw_b(i)) for i in ids_b]).tolist()
        links, groups, i, j, side_a, side_b = [], [], 0, 0, [], []
        while i < len(ids_a):
            links.append((ids_a[i], ids_b[j]))
            x, y = ends_a[i], ends_b[j]
            if x <= y:
                side_a.append(ids_a[i])
                i += 1
            if y <= x:
                side_b.append(ids_b[j])
                j += 1
            if x == y:
                groups.append(",".join(map(str, side_a)) + "|" + ",".join(map(str, side_b)))
                side_a, side_b = [], []
        counts.update(links)
        docs.append(((len(ids_a), len(ids_b), len(groups)), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    return [(*head, len(links), sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links), sha) for head, links, sha in docs], counts


def hostile_texts():
    rnd = random.Random(11)
    parts = ["the", " ", "  ", "\n", "\t", "ssss", "ss", "naïve", "日本", "١٢", "<s>", "<|endoftext|>", "it's", " ", "　", "\x1c", "\x85", "ﬁ", "'ll", "…", "\U0001f600", "aaaaa"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(1, 40))) for _ in range(400)]
    return texts + ODD + ["▁", "a▁b", "<0x41>", "\n ", "\n  a", " a", "a ", "\t b", "x  \n  y"]


@pytest.mark.parametrize("limit", [None, 40])
def test_alignment_matches_brute_force(spark, tokenizers, monkeypatch, limit):
    if limit:  # many small chunks give the same rows
        monkeypatch.setattr(align, "CHUNK_SEGMENTS", limit)
        monkeypatch.setattr(align, "SLICE_CHARS", 200)
    texts = hostile_texts()
    want, counts = brute_alignment(tokenizers, texts)
    rows = align.align(docs_of(spark, texts), A_FILE, B_FILE).collect()
    got = {r.doc_id: tuple(r)[1:] for r in rows}
    assert len(rows) == len(texts)
    for i, (t, w) in enumerate(zip(texts, want)):
        assert got[None if t == "NOID" else i] == w, repr(t)
    if not limit:
        pairs = {(r.a, r.b): r.n for r in align.pair_counts(docs_of(spark, texts), A_FILE, B_FILE).collect()}
        assert pairs == dict(counts)


def test_segments_are_encoded_as_in_their_text(tokenizers):
    a, b = tokenizers
    pair = align.Pair(open(A_FILE, "rb").read(), open(B_FILE, "rb").read())
    assert pair.apart
    rnd = random.Random(3)
    spaces = [" ", " ", "\n", "\t", "\x1c", "\x1f", "\x85", " ", " ", " ", " ", "　", "a", "1", "!"]
    texts = ["".join(rnd.choice(spaces) for _ in range(12)) for _ in range(3000)]
    texts += [f"a{chr(c)} b {chr(c)}{chr(c)}  c" for c in range(1, 0x3000) if c != 0x2581]  # that one stands for a space in B: such texts have no tokens
    for text in texts:
        ids_a, ids_b = pair.encode(pair.segments(text))
        assert [i for ids in ids_a for i in ids] == a.encode(" " + text, add_special_tokens=False).ids, repr(text)
        assert [i for ids in ids_b for i in ids] == b.encode(text), repr(text)
        flat_a, flat_b, n_a, n_b = pair.flat(pair.segments(text))
        assert flat_a.tolist() == [i for ids in ids_a for i in ids] and flat_b.tolist() == [i for ids in ids_b for i in ids]
        assert n_a.tolist() == list(map(len, ids_a)) and n_b.tolist() == list(map(len, ids_b))


def test_alignment_of_nothing_and_of_repeats(spark, tokenizers):
    docs = docs_of(spark, ["a b"])
    assert align.align(docs.limit(0), A_FILE, B_FILE).count() == 0
    want, _ = brute_alignment(tokenizers, ["a b", "a b"])
    assert [tuple(r)[1:] for r in align.align(docs.union(docs), A_FILE, B_FILE).collect()] == want


# -- ranked search -------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    """docs: (doc_id, text); items: item -> terms."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, asked in items.items():
        scored = []
        for doc_id, bag in bags:
            m = 10 + (90 * sum(bag.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in asked if t in bag)
            if score > 0 and doc_id is not None:
                scored.append((-score, doc_id))
        out += [(item, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("small", [False, True])
def test_ranked_search_matches_brute_force(spark, monkeypatch, small):
    if small:  # several blocks of queries, several trees of several levels
        monkeypatch.setattr(balltree, "BLOCK_TERMS", 60)
        monkeypatch.setattr(balltree, "TREE_DOCS", 100)
        monkeypatch.setattr(balltree, "LEAF", 4)
        monkeypatch.setattr(balltree, "FANOUT", 4)
    rnd = random.Random(12)
    words = [f"w{int(rnd.expovariate(0.02))}" for _ in range(400)] + ["Über", "日本語", "x_y", "ÀB"]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 120))) for _ in range(350)]
    texts += texts[:8] + texts[:8] + ODD
    asked = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 30)))) for i in range(25)]
    asked += [(50, None), (51, ""), (52, "!? ."), (53, "unheard of"), (54, texts[3]), (54, texts[9]), (None, "w1"), (55, texts[5] * 3)]
    docs = docs_of(spark, texts)
    queries = spark.createDataFrame([(i, t, 5, 7) for i, t in asked], "item_id long, text string, doc_id long, rank int")
    items = {}
    for i, t in asked:
        if i is not None:
            items.setdefault(i, set()).update(terms(t))
    want = brute_search([(None if t == "NOID" else i, t) for i, t in enumerate(texts)], items, 10)
    assert sorted(map(tuple, balltree.search(docs, queries, 10).collect())) == want
    if not small:
        assert balltree.search(docs.limit(0), queries).count() == 0 == balltree.search(docs, queries.limit(0)).count()


def random_tree(rnd, n, groups, leaf_columns=30):
    lens, columns, values = [], [], []
    for i in range(n):
        base = 40 * (i % groups)
        own = sorted(rnd.sample(range(base, base + 40), rnd.randrange(1, leaf_columns)))
        lens.append(len(own))
        columns += own
        values += [rnd.randrange(1, 10**9) for _ in own]
    return balltree.Tree(np.arange(n), np.array(lens), np.array(columns), np.array(values))


def test_tree_bounds_hold_and_prune():
    rnd = random.Random(4)
    tree = random_tree(rnd, 3000, 30)
    assert sorted(tree.ids.tolist()) == list(range(3000))
    dense = np.zeros((3000, 1200), np.int64)
    rows = np.repeat(np.arange(3000), tree.lens)
    dense[rows, tree.terms] = tree.values
    seen = []
    for group in range(30):
        query = np.array(sorted(rnd.sample(range(40 * group, 40 * group + 40), 12)))
        scores = dense[:, query].sum(axis=1)
        at = np.flatnonzero(np.isin(tree.columns, query))
        bounds = tree.bounds(slice(0, len(tree.nodes)), at)
        for (start, end, *_), bound in zip(tree.nodes.tolist(), bounds):
            assert scores[start:end].max() <= bound
        best = np.lexsort((tree.ids, -scores))[:10]
        ids, got, leaves = tree.search(query, 10)
        assert ids.tolist() == tree.ids[best].tolist() and got.tolist() == scores[best].tolist()
        seen.append(leaves)
    assert sum(seen) < 0.5 * 30 * sum(1 for n in tree.nodes if not n[3])  # subtrees were left out
    back = balltree.Tree.read({n: tree.row().column(n)[0].as_py() for n in ["sizes", *balltree.TREE_PARTS]})
    assert (back.radii == tree.radii).all() and (back.nodes == tree.nodes).all()


# -- metric join ---------------------------------------------------------------------------


def brute_components(texts, percent, words=4):
    def shingles(text):
        w = (text or "").encode().lower().split()
        return frozenset(tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))) if w else frozenset()

    sets = {i: shingles(t) for i, t in enumerate(texts) if t != "NOID"}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in sets.items():
        for item in s:
            holders.setdefault(item, []).append(i)
    for a, s in sets.items():
        for b in {b for item in s for b in holders[item] if b > a}:
            if 100 * len(s & sets[b]) >= percent * len(s | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(rnd, base, edits, word):
    base = list(base)
    for _ in range(edits):
        base[rnd.randrange(len(base))] = word()
    return base


@pytest.mark.parametrize("percent, cell", [(85, None), (85, 12), (70, 12), (93, 12)])
def test_metric_join_matches_brute_force(spark, monkeypatch, percent, cell):
    if cell:  # regions are split, dealt to pivots, and go to many cells
        monkeypatch.setattr(metricjoin, "CELL", cell)
        monkeypatch.setattr(metricjoin, "PIVOTS", 3)
        monkeypatch.setattr(metricjoin, "PARTNERS", 5)
        monkeypatch.setattr(metricjoin, "HOT_SEEN", 20)
    rnd = random.Random(13)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    texts = list(ODD)
    chain = [word() for _ in range(120)]
    for _ in range(60):  # chains of edits, so that components need more than one pivot
        chain = edited(rnd, chain, 1, word)
        texts.append(" ".join(chain))
    for edits in (2, 4, 5, 6, 9):  # families around the radius, seen from one base
        base = [word() for _ in range(150)]
        texts += [" ".join(edited(rnd, base, edits, word)) for _ in range(25)]
    passage = [word() for _ in range(60)]  # a passage that unrelated texts share, short and long
    texts += [" ".join([*passage, *(word() for _ in range(n))]) for n in (3, 4, 5, 8, 12, 20, 40, 80) for _ in range(6)]
    texts += ["  ".join(texts[12].upper().split()), "w1 w2 w3", "W1 w2\nw3", "w1 w2", "w1 w2 w3 w4", " ".join(["r"] * 500), " ".join(["r"] * 900)]
    rnd.shuffle(texts)
    rows = metricjoin.metric_join(docs_of(spark, texts), percent=percent).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert len(rows) == len(texts) and got.pop(None) == (1, None)
    assert got == brute_components(texts, percent)


def test_metric_join_defined_cases(spark):
    docs = docs_of(spark, ["a b c d e", "a b c d e"])
    assert metricjoin.metric_join(docs.limit(0)).count() == 0
    twice = docs.withColumn("doc_id", F.lit(4).cast("long"))
    assert [tuple(r) for r in metricjoin.metric_join(twice).collect()] == [(4, 2, 4)]
    clash = docs.withColumnRenamed("text", "body").withColumn("text", F.lit("other"))
    assert {r.component_id for r in metricjoin.metric_join(clash, "body").collect()} == {0}
    with pytest.raises(ValueError):
        metricjoin.metric_join(docs, percent=100)


def test_linked_sets_share_their_sketches():
    """What liveness and meeting rest on, over random sets just above the radius."""
    rnd = random.Random(1)
    for percent in (70, 85, 93):
        for _ in range(300):
            n = rnd.randrange(2, 400)
            base = rnd.sample(range(10**6), 2 * n)
            drop = rnd.randrange(0, metricjoin.missing(n, percent) + 1)
            x, y = set(base[:n]), set(base[drop:n] + base[n : n + rnd.randrange(0, drop + 1)])
            if not y or 100 * len(x & y) < percent * len(x | y):
                continue
            first, sketch = [], []
            for s in (sorted(x), sorted(y)):
                lacks = metricjoin.missing(len(s), percent)
                first.append(set(s[: lacks + 1]))
                sketch.append(set(s[: lacks + max(metricjoin.MORE_LEAST, len(s) // metricjoin.MORE_SHARE)]))
            assert first[0] & first[1]
            for s in (x, y):
                least = -(-percent * len(s) // 100)
                need = min(least - metricjoin.missing(least, percent), max(metricjoin.MORE_LEAST, least // metricjoin.MORE_SHARE))
                assert len(sketch[0] & sketch[1]) >= need
