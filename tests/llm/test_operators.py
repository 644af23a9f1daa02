"""Each operator against brute force, and on nulls, empty texts, ties, repeats, empty tables and clashing columns."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from paylabel.llm import bpe, chat, components, fingerprint, htmlmain, neardup, packing, quality, secretscan, topk, urlfilter
from paylabel.llm.common import bounded_batches

DOCS = "doc_id long, text string, score double, component_id long, piece int"
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module", autouse=True)
def _small_batches(spark):
    bounded_batches(spark)


def docs_of(spark, texts, first=0):
    return spark.createDataFrame([(None if t == "NOID" else first + i, t, 1.0, 7, 3) for i, t in enumerate(texts)], DOCS)


ODD = [None, "", " \t\n", "one", "a b c d", "Gleich " * 30, "Gleich " * 30, "x" * 50_000, "é ß 日本 \U0001f600 \x00", "NOID"]


def test_top_k_is_exact(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.uniform(-1, 1) if rnd.random() < 0.7 else 0.0 for _ in range(8)], 1) for i in range(180)]
    rows += [(200, None, 1), (201, [None, 1.0], 1), (202, [float("nan")], 1), (203, [float("inf")], 1), (204, [], 1), (None, [1.0], 1)]
    rows += [(50, rows[3][1], 1), rows[7], (205, rows[7][1], 1)]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int"), F.col("vec_id") % 50 == 0, 5).collect()
    live = [(i, [int(np.floor(256 * x)) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = []
    for q in sorted({i for i, _ in live if i % 50 == 0}):
        mine = max(v for i, v in live if i == q)
        best = sorted((-dot(mine, v), i) for i, v in live if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(map(tuple, got)) == sorted(want)
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.top_k(empty, F.col("vec_id") % 50 == 0, 5).count() == 0


def test_quality_learns_and_scores_everything(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    texts = [" ".join(word() + ("!!" if i % 3 == 0 else "") for _ in range(60)) for i in range(300)]
    docs = docs_of(spark, texts + ODD)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(300)] + [(5, None, 0), (9999, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    trees = quality.train(docs, labels)
    rows = quality.score(docs.select("doc_id", "text", "score"), trees).collect()
    assert len(rows) == 310 and all(0 <= r.score <= 1 for r in rows)
    test = [(r.score >= 0.5) == (r.doc_id % 3 != 0) for r in rows if r.doc_id is not None and r.doc_id < 300 and zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert sum(test) / len(test) > 0.95
    assert {r.score for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.accepted(docs, labels).columns == docs.columns
    assert quality.score(docs.limit(0), trees).count() == 0
    flag = {r.doc_id: r.h for r in docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("h")).collect()}
    assert all(flag[i] == (zlib.crc32(str(i).encode()) % 5 == 0) for i in range(300)) and flag[None] is False


RULES = [urlfilter.Rule("block", "net", "/"), urlfilter.Rule("allow", "example.net", "/en/"), urlfilter.Rule("block", "example.com", "/de/")]


def test_url_rules_and_redirect_classes(spark):
    link = lambda u: f'<LINK href="{u}" rel="canonical">'
    rows = [
        (1, "http://A.Example.NET/en/x?q#f", ""),
        (2, "http://a.example.net/fr", None),
        (3, "http://z.org/a", link("http://y.org/b")),
        (4, "http://y.org/b", '<meta http-equiv="refresh" content="0; url=http://bad.net/c">'),
        (5, "http://w.org/a/b", link("../x") + link("http://example.com/de/1")),
        (6, "http://w2.org/", link("//w.org/a/b") + link("http://example.net/en/ok")),
        (7, None, "x"),
        (8, "no url", link("http://bad.net/")),
        (9, "http://netx/", ""),
        (10, "http://x.net", ""),
        (11, "http://example.com/de/2", link("http://example.net/en/ok")),
        (11, "http://example.com/de/2", link("http://example.net/en/ok")),
        (12, "http://y.org/b#frag", ""),
    ]
    pages = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, host string, verdict string")
    got = {r.page_id: r for r in urlfilter.judge(pages, RULES).collect()}
    assert urlfilter.judge(pages, RULES).count() == len(rows)
    verdicts = {i: r.verdict for i, r in got.items()}
    assert verdicts == {1: "allow", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "allow", 10: "allow", 11: "block", 12: "block"}
    assert (got[1].host, got[1].path, got[1].rule) == ("a.example.net", "/en/x", "example.net/en/")
    assert got[3].rule is None and (got[7].host, got[7].path) == ("", "")
    assert urlfilter.judge(pages.limit(0), RULES).count() == 0


def test_url_aliases_are_normalised(spark):
    link = lambda u: f'<link rel="canonical" href="{u}">'
    rows = [
        ("http://a.org/x/y/z", link("../../b/./c")),
        ("http://a.org/x/..", link("/")),
        ("http://b.org/dir/page?x=1", link("?y=2")),
        ("http://c.org", link("http://d.org")),
        ("http://e.org/p", link("/q&#x2f;r&sol;s?a=1&#38;b=2&amp;c=3&copy=4")),
        ("http://f.org/p", link("/login?next=http://bad.net/")),
        ("http://g.org/a/../../b/.", link("//h.org/b/../")),
        ("http://i.org/p#top", link("#top")),
    ]
    pages = spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.src: r.dst for r in urlfilter.link_edges(pages).collect()}
    want = {"a.org/x/y/z": "a.org/b/c", "b.org/dir/page?x=1": "b.org/dir/page?y=2", "c.org/": "d.org/", "g.org/b/": "h.org/"}
    want |= {"e.org/p": "e.org/q/r/s?a=1&b=2&c=3&copy=4", "f.org/p": "f.org/login?next=http://bad.net/"}
    assert got == want


def test_components_match_union_find(spark):
    rnd = random.Random(1)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 560)] + [(3, None)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for x in list(parent)}


def plain_spans(text):
    kinds = [
        ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(1)) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 24),
    ]
    found = [(m.start(), i, m.end()) for i, (_, p, ok) in enumerate(kinds) for m in re.finditer(p, text) if ok(m)]
    return [(s, e, kinds[i][0]) for s, i, e in sorted(found)]


def test_secrets_base_spans_and_random_runs(spark):
    rnd = random.Random(3)
    base62 = secretscan.BASE62
    key = "".join(rnd.choice(base62) for _ in range(40))
    texts = [
        f"é password: token=abcdef PASSWORD = 'xyz123' {'0af9' * 8} AKIA{'A1' * 10} AKIAAKIA{'B' * 16}",
        f"the key {key} stands here",
        "abcdefghijklmnopqrstuvwxyz0123456789 " + "qr" * 20 + " donaudampfschifffahrtsgesellschaft",
        "secret:short api_key=longer.value passwd\x20\x20=\x20q\u017f token",
        *(" ".join("".join(rnd.choice("etaoinshr") for _ in range(18)) for _ in range(5)) for _ in range(60)),
        *ODD,
    ]
    got = [tuple((s.start, s.end, s.kind) for s in r.spans) for r in secretscan.find_secrets(docs_of(spark, texts)).orderBy(F.col("doc_id").asc_nulls_last()).collect()]
    for text, spans in zip(["" if t in (None, "NOID") else t for t in texts], got):
        assert [s for s in spans if s[2] != "random"] == plain_spans(text)
    assert (8, 48, "random") in got[1] and not got[2]
    clean = {r.doc_id: r.text for r in secretscan.redact(docs_of(spark, texts)).collect()}
    assert clean[1] == "the key [SECRET] stands here" and clean[2] == texts[2] and clean[64] is None
    assert secretscan.find_secrets(docs_of(spark, texts).limit(0)).count() == 0


def test_random_runs_of_encodings_that_seldom_change_class(spark):
    rnd = random.Random(11)
    words = "the quick brown fox jumps over a lazy dog while nine zebras watch and keep very still in what might be just extra big boxes".split()
    prose = [" ".join(rnd.choice(words) for _ in range(60)) + f" {rnd.randrange(3000)}" for _ in range(300)]
    alphabets = [secretscan.BASE32, secretscan.BASE32.lower(), "0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", secretscan.HEX_LOWER, secretscan.BASE62]
    keys = ["".join(rnd.choice(a) for _ in range(n)) for a in alphabets for n in (20, 32) for _ in range(5) if (a, n) != (secretscan.HEX_LOWER, 32)]
    plain = ["".join(rnd.choice("0123456789") for _ in range(20)) for _ in range(20)] + ["".join(rnd.choice(words) for _ in range(8)) for _ in range(60)]
    texts = prose + [f"see {x} there" for x in keys + plain]
    rows = secretscan.find_secrets(docs_of(spark, texts)).collect()
    found = {texts[r.doc_id][s.start : s.end] for r in rows for s in r.spans if s.kind == "random"}
    assert not found & set(plain) and len(found & set(keys)) >= 0.95 * len(keys)


def test_bpe_equals_the_library_and_round_trips(spark):
    import tiktoken

    with open(RANKS, "rb") as f:
        data = f.read()
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})
    rnd = random.Random(4)
    alphabets = ["ab", "aé", "thereionandsuwh ", "0123456789", "#%&! \n", "日本語кот", "\x1c\x1f \x85\xa0²ª", "  \t\n a'"]
    texts = ["".join(rnd.choice(a) for _ in range(rnd.choice([3, 12, 60, 400]))) for a in alphabets for _ in range(60)]
    texts += [t for t in ODD if t != "NOID"] + ["a" * 20_000, "<|endoftext|>"]
    docs = docs_of(spark, texts)
    rows = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id] or "")
        assert bytes(r.decoded) == (texts[r.doc_id] or "").encode()
    assert len(rows) == len(texts) and bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_fingerprints_and_edits(spark):
    texts = ["A b, c.\nD e, f.\n\nG h, i.", "q " * 400, "q " * 400, "x" * 5000, None, "", "日本\U0001f600 z"]
    docs = docs_of(spark, texts).union(spark.createDataFrame([(None, "no id", 1.0, 7, 3)], DOCS))
    rows = {r.doc_id: r for r in fingerprint.with_edits(docs).collect()}
    order = list(range(6, -1, -1)) + [None]
    plain = {i: t or "" for i, t in enumerate(texts)} | {None: "no id"}
    for at, i in enumerate(order):
        text, after = plain[i], plain[order[(at + 1) % len(order)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert rows[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and rows[i].n_chars == len(text)
        assert 0 <= rows[i].near_edited <= 1 and 0 <= rows[i].near_next <= 1
        assert (rows[i].fingerprint == rows[i].edited_fingerprint) == (edited == text)
    assert rows[1].fingerprint == rows[2].fingerprint and rows[2].near_next == 1.0 and rows[0].fingerprint != rows[1].fingerprint
    pair = spark.createDataFrame([("a\nb\n\nc", "a\nX\n\nc\nd")], "l string, r string")
    cut = pair.select(fingerprint.differing(fingerprint.sections(F.col("l")), fingerprint.sections(F.col("r"))).alias("d")).first().d
    assert [tuple(x) for x in cut] == [(0, 1), (1, 1)]
    assert fingerprint.with_edits(docs.limit(0)).count() == 0
    twice = fingerprint.with_edits(docs_of(spark, ["one two", "one two"]).withColumn("doc_id", F.lit(1).cast("long"))).collect()
    assert len(twice) == 2 and all(r.near_next == 1.0 for r in twice)


def test_packing_places_every_piece_once(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORDS)
    tokenizer.encode_special_tokens = True
    rnd = random.Random(6)
    texts = [" ".join(rnd.choice(["Haus", "it's", "naïve", "ΑΣ", "x1", "a,b!"]) for _ in range(rnd.randrange(1, 900))) for _ in range(120)] + ODD
    docs = docs_of(spark, texts)
    rows = packing.pack(docs, WORDS, 256).collect()
    ids = {i: tokenizer.encode("" if t in (None, "NOID") else t, add_special_tokens=False).ids + [0] for i, t in enumerate(texts)}
    ids[None] = tokenizer.encode("NOID", add_special_tokens=False).ids + [0]
    used = {}
    for r in rows:
        piece = (ids[r.doc_id] if r.doc_id is not None else ids[None])[r.start : r.start + r.length]
        assert len(piece) == r.length <= 256 and r.start == 256 * r.piece
        assert zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= 256
    total = sum(r.length for r in rows)
    assert total == sum(len(x) for i, x in ids.items() if i != len(texts) - 1) and len(used) <= 1.02 * -(-total // 256)
    assert packing.pack(docs.limit(0), WORDS, 256).count() == 0


def test_main_text_of_pages(spark):
    shell = "<html><head><title>t</title><style>p {x}</style></head><body><nav><a>menu</a></nav>{}<footer>foot</footer></body></html>"
    rows = [
        (1, "http://a/1", shell.replace("{}", "<article><h1>H &amp; i</h1><p>x\n  y<br>z<p>w<div class='comment-list'><p>c</p></div></article>", 1)),
        (2, "http://a/2", shell.replace("{}", "<article><ul><li>one<li>two</ul><form>f</form><script>a<b</script></article><div id='sideBar'>s</div>", 1)),
        (3, "http://b/1", "<body><h4>same line</h4><div>first</div></body>"),
        (4, "http://b/2", "<body><h4>same line</h4><div>second</div></body>"),
        (5, "http://b/3", "<body><h4>same line</h4><div>third</div><p>more</p></body>"),
        (6, None, "<p>loose <b>text"),
        (7, "http://c/", None),
        (8, "http://c/", ""),
        (9, "http://c/", "<div>" * 2000 + "deep &lt;x&gt;"),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in htmlmain.extract(pages).collect()}
    assert got == {1: "H & i\nx y z\nw", 2: "one\ntwo", 3: "first", 4: "second", 5: "third\nmore", 6: "loose text", 7: "", 8: "", 9: "deep <x>"}
    assert htmlmain.extract(pages.limit(0)).count() == 0


def page_text(page):
    tree = htmlmain.parse(page)
    return htmlmain.main_text(tree, htmlmain.wrapper_of(tree))


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p style="overflow: hidden">a</p><p title="a hidden gem">b</p><p hidden>c</p><p HIDDEN="">d</p></article>', "a\nb"),
        ('<main class="has-sidebar"><p>a</p></main>', "a"),
        ('<div id="page" class="no-sidebar"><p>a</p></div>', "a"),
        ('<article class="post social"><p>a</p></article>', "a"),
        ('<div class="page social"><div class="share"><article>a</article></div><div class="comments"><div class="reply"><article>c</article></div></div></div>', "a"),
        ('<div class="related"><article>t</article></div><main>a<div class="related">r</div></main>', "a"),
        ('<div role="main" class="widget">a</div><div class="widget">w</div>', "a"),
        ('<aside><article>t</article></aside><div class=widget>w</div>b', "b"),
        ("<article>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</article>", "so x=1 holds"),
    ],
)
def test_marks_drop_only_what_they_name(page, want):
    assert page_text(page) == want


@pytest.mark.parametrize(
    "page, want",
    [
        ("<body><div><article>" + "<div>" * 60 + "</div>" * 60 + "<p>rest</p></article>", "rest"),
        ("<body>" + "<div>" * 80 + "<article>a<p>b</article>" + "</div>" * 80 + "<p>c", "a\nb"),
        ("<body><article>" + "<font>" * 100 + "a<nav>n</nav><p>b <b>c</b> d</p></article>e", "a\nb c d"),
        ("<body>" + "<div>" * 80 + "<article></article></div>x", ""),
        ("<div>" * 50_000 + "<article>deep</article>" + "</div>" * 50_000 + "<p>x", "deep"),
    ],
)
def test_pages_nest_to_any_depth(page, want):
    assert page_text(page) == want


@pytest.mark.parametrize("parts", [1, 3])
def test_constant_slots_need_different_pages(spark, parts):
    copies = [(i, "http://copies/" + str(i), f"<script>{i}</script><body><p>head</p><div>same text</div></body>") for i in range(3)]
    same = [(10 + i, "http://list/" + str(i), f"<body><ul><li>x</li><li>x</li><li>x</li></ul><p>p{i}</p></body>") for i in range(2)]
    few = [(20 + i, "http://few/" + str(i), f"<body><h2>{'part' if i < 3 else i}</h2><p>foot</p><div>t{i}</div></body>") for i in range(8)]
    mixed = [(30 + i, "http://mixed/" + str(i), f"<body><p>menu</p>{f'<div>d{i}</div>' if i else '<article>a</article>'}</body>") for i in range(4)]
    rows = copies + same + few + mixed
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts, "page_id")
    got = {r.page_id: r.text for r in htmlmain.extract(pages).collect()}
    want = {i: "head\nsame text" for i in range(3)} | {10 + i: f"x\nx\nx\np{i}" for i in range(2)}
    want |= {20 + i: f"{'part' if i < 3 else i}\nt{i}" for i in range(8)} | {30: "a", 31: "d1", 32: "d2", 33: "d3"}
    assert got == want


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_match_brute_force(spark, percent):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(4))
    texts = list(ODD)
    base = [word() for _ in range(120)]
    for _ in range(60):  # chains of edits, so that components need more than one leader
        base = list(base)
        base[rnd.randrange(len(base))] = word()
        texts.append(" ".join(base))
    texts += ["  ".join(texts[12].upper().split()), "w1 w2 w3 w4", "W1 w2\nw3 w4", "w1 w2 w3"]
    got = {r.doc_id: r for r in neardup.near_duplicates(docs_of(spark, texts), percent=percent).collect()}

    def shingles(text):
        words = (text or "").encode().lower().split()
        return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    sets = {i: shingles(t) for i, t in enumerate(texts) if t != "NOID"}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for i, s in sets.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), find(i), find(i) == i)
    assert got[None].kept and got[None].component_id is None and len(got) == len(texts)
    assert neardup.near_duplicates(docs_of(spark, texts).limit(0)).count() == 0
    twice = docs_of(spark, ["a b c d e f", "a b c d e f"]).withColumn("doc_id", F.lit(4).cast("long"))
    assert [(r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(twice).collect()] == [(4, 4, True)]


def test_chats_read_back(spark):
    hostile = r"\### Assistant: </turn> ok \h \l \b <next/> :"
    rows = [
        (1, 0, "user", hostile), (1, 1, "assistant", hostile), (1, 2, "assistant", "more\n"), (1, 3, "user", None),
        (2, None, None, "x"), (2, 1, "a:\n<b", ""), (None, 0, "assistant", ""), (3, 0, "assistant", "é\U0001f600"), (3, 0, "assistant", "é\U0001f600"),
        *((4, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(300)),
    ]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_chats(frame)
    back = done.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    for r in back.collect():
        want = sorted(((-1 if t is None else t, role or "", x or "") for c, t, role, x in rows if c == r.conv_id))
        assert [(t.role, t.text) for t in r.t] == [(role, x) for _, role, x in want]
        assert r.loss == "".join(x for _, role, x in want if role == "assistant")
    first = done.where("conv_id = 1").first().formatted
    assert first.count("### assistant:\n") == 1 and first.count("</turn>\n") == 3
    assert chat.format_chats(frame.limit(0)).count() == 0


def test_word_ids_equal_the_tokenizers_on_every_character():
    from tokenizers import Tokenizer

    with open(WORDS, "rb") as f:
        vocabulary = f.read()
    tokenizer = Tokenizer.from_buffer(vocabulary)
    tokenizer.encode_special_tokens = True
    rnd = random.Random(1)
    signs = [chr(c) for c in range(0x3000)] + [chr(c) for c in range(0xA640, 0xD800, 7)] + ["\U00010400", "\U0001F600"]
    texts = [f"a{c}b {c} x{c} {c}'s |{c}| {c}" for c in signs]
    texts += ["".join(rnd.choice(signs) if rnd.random() < 0.5 else rnd.choice("ab 'sA1|\n\t") for _ in range(30)) for _ in range(2000)]
    texts += ["Əliyev Bakıda", "a|b | c", "|", "", "| |", "<|endoftext|>"]
    got = packing.WordIds(vocabulary)(texts)
    want = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [e.ids for e in want]


def test_top_k_of_large_components(spark):
    rows = [(0, [1e8, 1.0]), (1, [1.0, 2.0]), (2, [3e4, 1.5]), (3, [-7.0, 1e9]), (50, [2.0**40, -3.0]), (4, [5.5, 0.25])]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>").where("vec_id <> 50"), F.col("vec_id") % 50 == 0, 5).collect()
    assert {r.vec_id: r.score for r in got}[1] == 25600000000 * 256 + 256 * 512
    weight = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    want = sorted(((-sum(a * b for a, b in zip(weight[0], weight[i])), i) for i in (1, 2, 3, 4)))
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(i, -s) for s, i in want]
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0, 5).collect()
