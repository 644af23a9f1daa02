"""Links as a browser reads them, separators in secrets, the fingerprint tree by hand, wrappers and their regions."""

import hashlib
import json
import random
import uuid

import pytest
import xxhash
from pyspark.sql import functions as F

from paylabel.llm import fingerprint, htmlmain, secretscan, urlfilter
from paylabel.llm.common import bounded_batches


@pytest.fixture(scope="module", autouse=True)
def _small_batches(spark):
    bounded_batches(spark)


# -- links -----------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "html, want",
    [
        ("""<link rel=canonical href="http://a.org/it's">""", ["http://a.org/it's"]),
        ("""<link rel="canonical" data-href="http://bad.net/x" href='http://a.org/y'>""", ["http://a.org/y"]),
        ("""<link rel="alternate canonical" href=/z>""", ["/z"]),
        ("""<link rel="alternate" title="canonical" href="/z">""", []),
        ("""<!-- <link rel="canonical" href="http://bad.net/"> --><p>x""", []),
        ("""<script>var s = '<link rel="canonical" href="http://bad.net/">'</script>""", []),
        ("""<META HTTP-EQUIV="Refresh" CONTENT="0; URL='http://a.org/?a=1&amp;b=2'">""", ["http://a.org/?a=1&b=2"]),
        ("""<meta http-equiv=refresh content="5">""", []),
        ("""<link rel=canonical href=""><link href="/c" rel='CANONICAL'/>""", ["/c"]),
    ],
)
def test_links_are_read_by_attribute(html, want):
    assert urlfilter.links_of(html)[0] == want


def test_base_and_hostless_pages(spark):
    rules = [urlfilter.Rule("block", "bad.net", "/")]
    rows = [
        (1, "http://a.org/x/1", '<base href="http://bad.net/b/"><link rel=canonical href="c">'),
        (2, "http://a.org/x/2", '<base href="../y/"><link rel=canonical href="c">'),
        (3, "http://a.org/y/c", '<meta http-equiv=refresh content="0;url=http://bad.net/q">'),
        (4, None, "canonical"), (5, "no host", "canonical"), (6, "http://a.org/z", None),
    ]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, class_id string")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, rules).collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


# -- secrets ---------------------------------------------------------------------------------


def test_separators_say_nothing():
    rnd = random.Random(8)
    runs = [str(uuid.UUID(int=rnd.getrandbits(128), version=4)) for _ in range(500)]
    assert all(secretscan.infer_encoding(r)[0] == "hex" for r in runs)
    assert sum(secretscan.is_uniform(r, secretscan.infer_encoding(r)[1]) for r in runs) > 480
    assert secretscan.infer_encoding("some_words_in_a_row")[0] == "base32" and secretscan.infer_encoding("aB3/+x_-")[0] == "base64"
    assert not secretscan.is_uniform("-" * 20, secretscan.infer_encoding("-" * 20)[1])


def test_false_discovery_control_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(i, [], [(0, 20, rnd.choice([16, 20, 32]), int(rnd.expovariate(0.2)) if rnd.random() < 0.9 else rnd.randrange(20, 90)) for _ in range(rnd.randrange(0, 9))]) for i in range(120)]
    schema = "doc_id long, base array<struct<start:long,end:long,kind:string>>, runs array<struct<start:long,end:long,stratum:long,grade:long>>"
    got = secretscan.thresholds(spark.createDataFrame(rows, schema), 0.05)
    for stratum in (16, 20, 32):
        p = sorted(10 ** (-g / 10) for _, _, runs in rows for _, _, s, g in runs if s == stratum)
        passed = [x for k, x in enumerate(p, 1) if x <= 0.05 * k / len(p)]
        found = {g for _, _, runs in rows for _, _, s, g in runs if s == stratum and 10 ** (-g / 10) <= max(passed, default=-1)}
        assert ({g for _, _, runs in rows for _, _, s, g in runs if s == stratum and stratum in got and g >= got[stratum]}) == found


# -- fingerprints ----------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def pieces(paragraph):
    out, last = [], 0
    for p in range(1, len(paragraph) + 1):
        if (p >= 2 and paragraph[p - 1] in " \t\r\x0b\x0c" and paragraph[p - 2] in "adhlptx.,:;!?|)]}0123456789") or p - last == 48:
            out.append(paragraph[last:p])
            last = p
    return [*out, paragraph[last:]]


def tree_of(text):
    sections = []
    for section in text.split("\n\n"):
        paragraphs = []
        for paragraph in section.split("\n"):
            leaves = [xxhash.xxh64_intdigest(x.encode(), 42) for x in pieces(paragraph)]
            paragraphs.append((sha("".join(f"{x:016X}" for x in leaves)), leaves))
        sections.append((sha("".join(d for d, _ in paragraphs)), paragraphs))
    return sha("".join(d for d, _ in sections)), sections


def leaves_of(tree):
    return list(dict.fromkeys(x & 0xFFFFFFFF for _, ps in tree[1] for _, leaves in ps for x in leaves))


def test_fingerprint_columns_equal_a_tree_by_hand(spark):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("adhlp.exyéß日") for _ in range(rnd.randrange(1, 9)))
    texts = ["\n".join(" ".join(word() for _ in range(rnd.randrange(0, 30))) + rnd.choice(["", "\n", "."]) for _ in range(rnd.randrange(1, 8))) for _ in range(40)]
    texts += ["", "\n\n", "a ", "x" * 96, "x" * 97, "d " * 60, texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in fingerprint.with_edits(docs).collect()}
    n = len(texts)
    for i, text in enumerate(texts):
        after, half = texts[(i - 1) % n], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        trees = [tree_of(t) for t in (text, edited, after)]
        leaves = [leaves_of(t) for t in trees]
        r = rows[i]
        assert r.edited_sha256 == sha(edited)
        for got, tree, own in ((r.fingerprint, trees[0], leaves[0]), (r.edited_fingerprint, trees[1], leaves[1])):
            assert got == tree[0][:32] + ":" + "".join(f"{x:08x}" for x in own)
        for got, k in ((r.near_edited, 1), (r.near_next, 2)):
            both = 2 * len(set(leaves[0]) & set(leaves[k])) / (len(leaves[0]) + len(leaves[k]))
            assert got == pytest.approx(1.0 if trees[0][0] == trees[k][0] else both)
        differ = []
        for s in range(max(len(trees[0][1]), len(trees[1][1]))):
            a, b = ([p for p, _ in t[1][s][1]] if s < len(t[1]) else [] for t in trees[:2])
            differ += [(s, p) for p in range(max(len(a), len(b))) if (a[p] if p < len(a) else None) != (b[p] if p < len(b) else None)]
        assert (r.n_differing, r.first_section, r.first_paragraph) == (len(differ), *(differ[0] if differ else (None, None)))
        assert "".join(x for s in text.split("\n\n") for p in s.split("\n") for x in pieces(p)) == text.replace("\n", "")


# -- wrappers --------------------------------------------------------------------------------


def accepts(items, keys):
    """Whether the union-free expression of a node's items gives the row of keys: backtracking, the plain way."""
    if not items:
        return not keys
    item, rest = items[0], items[1:]
    unit = item[2] if item[0].startswith("#group ") else [item]
    names = [u[0] for u in unit]

    def round_of(at):
        """Ends of one round of the unit from ``at``; optional members may be missing."""
        ends = {at}
        for u in unit:
            loose = u[1] in ("?", "*") if item[0].startswith("#group ") else False
            ends = {e + 1 for e in ends if e < len(keys) and keys[e] == u[0]} | (ends if loose else set())
        return {e for e in ends if e > at}

    assert names
    reached = {0} if item[1] in ("?", "*") else set()
    edge = round_of(0)
    reached |= edge
    while item[1] in ("+", "*") and edge:
        edge = {e for start in edge for e in round_of(start)} - reached
        reached |= edge
    return any(accepts(rest, keys[e:]) for e in reached)


def random_page(rnd):
    body = ["<p>" + rnd.choice("abc") + "</p>" * 1 for _ in range(rnd.randrange(0, 4))]
    if rnd.random() < 0.5:
        body.insert(0, "<h1>t</h1>")
    if rnd.random() < 0.5:
        body.append("<ul>" + "<li>x</li>" * rnd.randrange(1, 4) + "</ul>")
    if rnd.random() < 0.3:
        body.append("loose")
    return "<body><div>" + "".join(body) + "</div>" + ("<div>side</div>" if rnd.random() < 0.5 else "") + "</body>"


def test_wrappers_accept_their_pages_and_place_every_text():
    rnd = random.Random(2)
    pages = [random_page(rnd) for _ in range(40)]
    wrapper = None
    for page in pages:
        w = htmlmain.wrapper_of(htmlmain.parse(page))
        wrapper = w if wrapper is None else htmlmain.merged(wrapper, w)

    def check(node, w):
        keys, below = [], []
        for child in node[1]:
            keys.append("#text" if isinstance(child, str) else htmlmain.kind_of(child))
            below.append(child)
        assert accepts(w[2], keys), (keys, w[2])
        order, at = htmlmain.Places(w[2]), -1
        for key, child in zip(keys, below):
            at = order.next(key, at)
            assert at is not None and order.items[at][0] == key
            if not isinstance(child, str):
                check(child, order.items[at])

    for page in pages:
        tree = htmlmain.parse(page)
        check(tree, wrapper)
        got = htmlmain.slot_texts(tree, wrapper)
        assert [t for _, t, _ in got] == [t for t in htmlmain.main_text(tree, wrapper).split("\n") if t]
    assert json.loads(json.dumps(wrapper)) == wrapper


def test_plain_divs_give_the_article_alone(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n))
    rows, want = [], {}
    for i in range(30):
        title, body = line(5), [line(rnd.randrange(20, 60)) for _ in range(rnd.randrange(2, 9))]
        menu = "".join(f'<a href="/{k}">{word()}</a> ' for k in range(6))
        teasers = "".join(f"<div><b>{line(3)}</b> <span>{line(6)}</span></div>" for _ in range(3))
        extra = f"<div>{line(8)}</div>" if i % 3 == 0 else ""
        rows.append((i, f"http://plain/{i}", f"<body><div>{menu}</div>{extra}<div><h1>{title}</h1><div>{''.join(f'<p>{p}</p>' for p in body)}</div><div>{teasers}</div></div><div>All rights kept</div></body>"))
        want[i] = "\n".join([title, *body])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in htmlmain.extract(pages).collect()} == want


def page_text(page):
    tree = htmlmain.parse(page)
    return htmlmain.main_text(tree, htmlmain.wrapper_of(tree))


@pytest.mark.parametrize(
    "page, want",
    [
        ('<article><p>We <span class="search">searched</span> the <b id="notice-period">notice period</b></p><h2 class="section-header">Heading</h2><p>x</p></article>', "We searched the notice period\nHeading\nx"),
        ('<article><div class="share-price">12</div><div class="comment-analysis">on it</div><div class="share">f t</div></article>', "12\non it"),
        ('<article><p>a</p><div class="comments-area"><p>c</p></div><section id="comments">d</section><div class="ad-box">e</div></article>', "a"),
        ('<article><header><h1>T</h1></header><div class="menu">Soup</div><p class="footer">end</p></article>', "Soup\nend"),
    ],
)
def test_class_words_in_an_article(page, want):
    assert page_text(page) == want


def test_written_tables_leave_no_shuffle_files(spark):
    from paylabel.llm.common import FILES_GO, written

    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(k).getName() for k in range(found.size()) if found.apply(k).getName().startswith("shuffle_")}

    before, conf = files(), spark.conf.get(FILES_GO)
    table = written(spark.range(5000).groupBy((F.col("id") % 50).alias("k")).agg(F.count("*").alias("n")), "t")
    assert not files() - before and table.count() == 50 and spark.conf.get(FILES_GO) == conf
