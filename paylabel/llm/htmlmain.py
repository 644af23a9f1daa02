"""Main-text extraction by wrapper inference (union-free regular expressions over page structure).

Pages of one host share templates.  Every page is read as a token stream, nested by its
tags, and the streams of a host are aligned one after the other into a wrapper:

* equal tokens match (boxes such as div only if they hold mostly the same); a token on one side only becomes an optional;
* neighbouring repetitions of one token, or of a group of up to three, become a repeated group;
* text becomes a slot.

A wrapper holds no alternatives (it is union-free), no page texts, and at most WIDTH items
per node (a wider one becomes a repeated group of optionals), so it stays small however many
pages a host has.  Partitions infer partial wrappers in one pass, equal ones are merged by
key, and the rest are aligned in two rounds, the first of them salted, so that no task sees
all pages of a large host.

A page is then aligned with its host's wrapper, which gives each of its texts a slot.  If the wrapper has
article regions (article, main, or their roles), the page's text is what they hold.  On hosts with pages that
have none, Spark counts how the slots behave: a text is constant if it stands in its slot on CONSTANT_PAGES pages of the
host or more, and on CONSTANT_SHARE of them (copies of a page, and repetitions within one, count once); the
weight of a slot is its varying text outside links.  The host's region is found by walking from the top into the one
container that holds REGION_SHARE of the weight and REGION_BLOCKS texts of a page or more; a page gives the
region's whole text, with the headings beside and before it.  Where no container stands out, the page gives its body without constant texts.
Regions whose tag or
class marks menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles or
reader comments are left out in either case.  A class word is a loose mark: it must be the whole name but for words of
boxes; it never drops an article region, nor the only one's surroundings, and in an article no
heading and no run of text.  Character references are decoded, white space
inside a block becomes one space, and non-empty blocks are joined by one line end.

Defined cases: null or empty html gives an empty text; pages without a host share one
wrapper; markup that is cut off or wrongly nested is closed where HTML would close it;
a page may nest to any depth (a wrapper's own nesting beyond DEPTH is flattened); repeated rows give repeated results;
an empty table gives no rows; only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_cache, written
from .urlfilter import host_of

#: Items of a wrapper's node, levels of a wrapper, items of a repeated group.
WIDTH, DEPTH, GROUP = 64, 60, 3
#: Hosts whose partial wrappers a partition holds before it passes them on.
OPEN_HOSTS = 2000
#: Pages of different text that must agree before a slot counts as constant, and their share of the host's.
CONSTANT_PAGES, CONSTANT_SHARE = 3, 0.5
#: Share of a host's varying text that a container must hold to be its region, and texts of a page in it.
REGION_SHARE, REGION_BLOCKS = 0.6, 2
#: Tasks over which the partial wrappers of a host are dealt at first.
SALTS = 16

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr title legend summary".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
STOPS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
DROPPED = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe input menu nav noscript object script select style svg "
    "template textarea title video".split()
)
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies discussion disqus "
    "footer header login menu modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promotion related "
    "remark remarks replies reply respond search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Of these words the ones that name a region inside an article: reader comments, adverts, notices and links to elsewhere.
INSIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising comment comments consent cookie cookies discussion disqus newsletter notice notices "
    "promo promotion related remark remarks replies reply respond share sharing sidebar social sponsor sponsored subscribe subscription".split()
)
#: Beside a dropped word in one class name these name the box only (comment-list); any other word makes it a name of content (comment-analysis).
BOX_WORDS = frozenset("area bar block bottom box column container group holder inner item items left list outer panel right row section slot top unit wrap wrapper zone".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
MAIN = frozenset(["article", "main"])

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.DOTALL,
)
#: One attribute: its name, and its whole value (quoted or not).
ATTR = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
WORD = re.compile(r"[a-z]+")


def names_dropped(value: str, words: frozenset[str] = DROPPED_WORDS) -> bool:
    """Whether a class or id value names a region that is no article text."""
    for name in re.sub(r"(?<=[a-z])(?=[A-Z])", "-", value).lower().split():
        found = WORD.findall(name)
        if any(w in words for w in found) and all(w in words or w in BOX_WORDS for w in found):
            return True
    return False


def key_of(tag: str, attrs: str, inside: bool = False) -> tuple[str, bool]:
    """The tag, with ! if its attributes mark a region that is no article text, or * if they mark the main one;
    and whether only a class or id word says !.

    Inside an article a class word marks blocks only, never a heading or a run of text.
    """
    if not attrs or tag in ("html", "body"):
        return tag, False
    found: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(attrs):
        found.setdefault(name.lower(), a or b or c)  # of repeated attributes the first one counts
    role = found.get("role", "").strip().lower()
    if "hidden" in found or role in DROPPED_ROLES:
        return tag + "!", False
    if role in ("main", "article"):
        return tag + "*", False
    if tag in MAIN or (inside and (tag not in BLOCK or tag in HEADINGS)):
        return tag, False
    words = INSIDE_WORDS if inside else DROPPED_WORDS
    if names_dropped(found.get("class", ""), words) or names_dropped(found.get("id", ""), words):
        return tag + "!", True
    return tag, False


def parse(page: str | None) -> list:
    """The page as nested [key, children], however deep; a text is a plain string.

    A class word is a loose mark: where every article region stands inside loosely marked
    elements, those around the least enclosed ones lose their mark.
    """
    top: list = ["#page", []]
    stack = [top]
    # Per open element, the loosely marked ones around its content as (count, node, outer ones); None in a dropped one.
    around: list[tuple | None] = [(0, None, None)]
    regions: list[tuple] = []

    tags, within = ["#page"], [False]
    opened: Counter[str] = Counter()

    def pop_to(names: set[str], stops: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for at in range(len(stack) - 1, 0, -1):
            if tags[at] in names:
                opened.subtract(tags[at:])
                del stack[at:], tags[at:], around[at:], within[at:]
                return
            if tags[at] in stops:
                return

    raw_end = None
    at, page = 0, page or ""
    scan = TOKEN.match
    while at < len(page):
        m = scan(page, at)
        if m is None:  # an unclosed quote: the tag ends at the next >
            end = page.find(">", at)
            at = len(page) if end < 0 else end + 1
            continue
        at = m.end()
        if m.lastgroup == "text":
            stack[-1][1].append(m.group())
            continue
        tag = m.group("tag")
        if tag is None:
            continue
        tag = tag.lower()
        if m.group("close"):
            pop_to({tag}, set())
            continue
        if tag in CLOSES_P:
            pop_to({"p"}, {"article", "aside", "blockquote", "body", "button", "div", "footer", "form", "header", "li", "main", "nav", "section", "table", "td", "th"})
        if tag in SIBLINGS:
            pop_to(SIBLINGS[tag], STOPS[tag])
        key, loose = key_of(tag, m.group("attrs"), within[-1])
        node = [key, []]
        stack[-1][1].append(node)
        marks = around[-1]
        if marks is not None:
            if loose and tag not in DROPPED:
                marks = (marks[0] + 1, node, marks)
            elif is_dropped(key):
                marks = None
            elif is_main(key):
                regions.append(marks)
        if tag in RAW and not m.group().endswith("/>"):
            raw_end = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = len(page) if raw_end is None else raw_end.end()
        elif tag not in VOID and not m.group().endswith("/>"):
            stack.append(node)
            tags.append(tag)
            opened[tag] += 1
            around.append(marks)
            within.append(within[-1] or is_main(key))
    least = min((r[0] for r in regions), default=0)
    for marks in [r for r in regions if r[0] == least]:
        while marks[0] and marks[1][0].endswith("!"):
            marks[1][0] = marks[1][0][:-1]
            marks = marks[2]
    return top


# -- wrappers: [key, quantifier, items] and slots ["#text", quantifier] ----------------------


def squash(text: str) -> str:
    return " ".join(html_lib.unescape(text).split())


def more(a: str, b: str) -> str:
    """The quantifier that allows what both allow."""
    optional = a in ("?", "*") or b in ("?", "*")
    repeated = a in ("+", "*") or b in ("+", "*")
    return ("*" if repeated else "?") if optional else ("+" if repeated else "")


def merged(a: list, b: list, quantifier: str | None = None) -> list:
    """One node that stands for both; their keys are equal."""
    q = more(a[1], b[1]) if quantifier is None else quantifier
    if a[0] == "#text":
        return ["#text", q]
    return [a[0], q, aligned(a[2], b[2])]


def optional(item: list) -> list:
    return [item[0], more(item[1], "?"), *item[2:]]


def aligned(a: list, b: list) -> list:
    """Align two item lists: each item of b goes to the next equal one of a; what is passed over is optional."""
    places: dict[str, list[int]] = {}
    for i, item in enumerate(a):
        places.setdefault(item[0], []).append(i)
    out, at = [], 0
    for item in b:
        to = next((i for i in places.get(item[0], ()) if i >= at), None)
        if to is None:
            out.append(optional(item))
            continue
        out += [optional(x) for x in a[at:to]]
        out.append(merged(a[to], item))
        at = to + 1
    out += [optional(x) for x in a[at:]]
    return bounded(folded(out))


def folded(items: list) -> list:
    """Neighbouring repetitions, alone or in groups, become repeated items."""
    for size in range(1, GROUP + 1):
        out, i = [], 0
        while i < len(items):
            keys = [x[0] for x in items[i : i + size]]
            j = i + size
            if len(keys) == size and not (size > 1 and len(set(keys)) == 1):
                unit = items[i:j]
                while [x[0] for x in items[j : j + size]] == keys:
                    unit = [merged(u, x, more(more(u[1], x[1]), "+") if size == 1 else None) for u, x in zip(unit, items[j : j + size])]
                    j += size
                if j > i + size:
                    out.append(unit[0] if size == 1 else [f"#group {' '.join(keys)}", "+", unit])
                    i = j
                    continue
            out.append(items[i])
            i += 1
        items = out
    return items


def bounded(items: list) -> list:
    if len(items) <= WIDTH:
        return items
    by_key: dict[str, list] = {}
    for item in items:
        by_key[item[0]] = merged(by_key[item[0]], item, "*") if item[0] in by_key else [item[0], "*", *item[2:]]
    return [by_key[k] for k in sorted(by_key)]


def flattened(node: list) -> list:
    """All elements and texts below the node as its children, without what stands in dropped regions."""
    out, todo = [], node[1][::-1]
    while todo:
        child = todo.pop()
        out.append(child if isinstance(child, str) else [child[0], []])
        if not isinstance(child, str) and not is_dropped(child[0]):
            todo += child[1][::-1]
    return out


#: Boxes in which a page lays out its regions.
CONTAINERS = frozenset("html body div section center table tbody tr td".split())
#: Elements that say nothing of what they hold.
GENERIC = frozenset("div section td center".split())


def kind_of(node: list) -> str:
    """The key by which elements are aligned: boxes of different content (by their most frequent children) are different."""
    if node[0] not in GENERIC:
        return node[0]
    found = Counter(child[0].rstrip("!*") for child in node[1] if not isinstance(child, str))
    return f"{node[0]}~{min(found, key=lambda k: (-found[k], k)) if found else '#text'}"


def wrapper_of(node: list, level: int = 1) -> list:
    """The wrapper of one page."""
    items, texts = [], []

    def flush() -> None:
        if squash(" ".join(texts)):
            items.append(["#text", ""])
        texts.clear()

    for child in node[1] if level < DEPTH else flattened(node):
        if isinstance(child, str):
            texts.append(child)
        else:
            flush()
            items.append(wrapper_of(child, level + 1))
    flush()
    return [kind_of(node), "", bounded(folded(items))]


def has_main(wrapper: list) -> bool:
    """Whether an article region stands outside the dropped ones."""
    if wrapper[0] == "#text" or is_dropped(wrapper[0]):
        return False
    return is_main(wrapper[0]) or any(has_main(x) for x in wrapper[2])


def is_dropped(key: str) -> bool:
    return key.endswith("!") or key.rstrip("*") in DROPPED


def is_main(key: str) -> bool:
    return key.endswith("*") or key in MAIN


def _find_main(node: list) -> bool:
    todo = [node]
    while todo:
        for child in todo.pop()[1]:
            if not isinstance(child, str) and not is_dropped(child[0]):
                if is_main(child[0]):
                    return True
                todo.append(child)
    return False


def step(path: int, key: str) -> int:
    """The number of a path that goes one element on; of fixed size, so that a deep page's paths stay small."""
    return (path * 1_000_003 + zlib.crc32(key.encode()) + 1) % (2**61 - 1)


def number_of(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(" ".join(map(str, parts)).encode(errors="surrogatepass"), digest_size=8).digest(), signed=True)


#: Stands for the items of an element that the wrapper does not have.
NOWHERE: list = ["", "", []]


class Places:
    """The items of a wrapper's node as places in order, a repeated group's items side by side."""

    def __init__(self, items: list):
        self.items: list[list] = []
        self.names: list[str] = []
        self.group: list[tuple[int, int] | None] = []
        for i, item in enumerate(items):
            unit = item[2] if item[0].startswith("#group ") else [item]
            span = (len(self.items), len(self.items) + len(unit)) if item[0].startswith("#group ") else None
            for j, x in enumerate(unit):
                self.items.append(x)
                self.names.append(f"{i}.{j}")
                self.group.append(span)
        self.by_key: dict[str, list[int]] = {}
        for at, item in enumerate(self.items):
            self.by_key.setdefault(item[0], []).append(at)

    def next(self, key: str, at: int) -> int | None:
        """The place of an element after place ``at``: that one again if it repeats, in the same group's
        next round, or the next of its key; the first one where the order is lost."""
        places = self.by_key.get(key)
        if not places:
            return None
        if at >= 0 and self.items[at][0] == key and (self.items[at][1] in ("+", "*") or key == "#text"):
            return at
        later = [p for p in places if p > at]
        if at >= 0 and (span := self.group[at]):
            inside = [p for p in places if span[0] <= p < span[1]]
            if inside:
                return next((p for p in inside if p > at), inside[0])
        return later[0] if later else places[0]


def aligned_texts(page: list, wrapper: list, places: dict[int, Places] | None = None) -> Iterator[tuple]:
    """The page in its order, as the wrapper places it: ("open" | "close", path, key) around elements
    outside dropped regions and ("text", path, text, whether it stands in a link)."""
    known = places if places is not None else {}
    todo: list[tuple] = [("node", page, wrapper, 0, 1, False)]
    while todo:
        what, node, w, path, level, in_link = todo.pop()
        if what != "node":
            yield what, path, node
            continue
        key = node[0]
        if is_dropped(key):
            continue
        yield "open", path, key
        below: list[tuple] = []
        if id(w) not in known:
            known[id(w)] = Places(w[2])
        order, at = known[id(w)], -1
        in_link = in_link or key == "a"
        for child in node[1]:
            text = isinstance(child, str)
            if text and not squash(child):
                below.append(("text", child, None, path, 0, in_link))
                continue
            kind = "#text" if text else kind_of(child)
            found = order.next(kind, at)
            at = found if found is not None else at
            name = order.names[found] if found is not None else "?"
            to = step(path, f"{name} {kind}")
            if text:
                below.append(("text", child, None, to, 0, in_link))
            else:
                # what lies deeper than the wrapper is placed among the items of its last level
                deeper = w if level >= DEPTH else order.items[found] if found is not None else NOWHERE
                below.append(("node", child, deeper, to, level + 1, in_link))
        below.append(("close", key, None, path, 0, False))
        for item in reversed(below):
            todo.append(item if item[0] != "text" else ("text" + ("+" if item[5] else ""), item[1], None, item[3], 0, False))


class Region(NamedTuple):
    """Where a host's main text stands: a place of its wrapper and the one above; or its constant texts."""

    path: int | None = None
    above: int | None = None
    constant: frozenset[int] = frozenset()


def main_text(page: list, wrapper: list, constant: set[int] | frozenset[int] = frozenset(), region: Region | None = None, places: dict[int, Places] | None = None) -> str:
    """The blocks of the page's main text: its article regions; else the host's region; else the body without constant texts."""
    region = region or Region(constant=frozenset(constant))
    if has_main(wrapper) and _find_main(page):  # the region is optional: this page may lack it
        return _blocks(aligned_texts(page, wrapper, places), lambda key, path: is_main(key))
    events = list(aligned_texts(page, wrapper, places))
    if region.path is not None and any(e[0] == "open" and e[1] == region.path for e in events):
        return _blocks(_with_headings(events, region), lambda key, path: path == region.path)
    return _blocks(events, lambda key, path: True, region.constant)


def _with_headings(events: list[tuple], region: Region) -> Iterator[tuple]:
    """Headings beside the region and before it become part of it."""
    first = next(i for i, e in enumerate(events) if e[0] == "open" and e[1] == region.path)
    depth, keep = 0, -1
    for i, e in enumerate(events):
        if e[0] == "open":
            parent = depth
            depth += 1
            if i < first and keep < 0 and e[2].rstrip("*") in ("h1", "h2") and parents_are(events, i, region.above):
                keep = parent
                yield "open", region.path, "div"
        yield e
        if e[0] == "close":
            depth -= 1
            if depth == keep:
                keep = -1
                yield "close", region.path, "div"


def parents_are(events: list[tuple], at: int, path: int | None) -> bool:
    """Whether the element that opens at ``at`` stands directly in ``path``."""
    closed = 0
    for e in reversed(events[:at]):
        if e[0] == "close":
            closed += 1
        elif e[0] == "open":
            if not closed:
                return e[1] == path
            closed -= 1
    return False


def _blocks(events: Iterable[tuple], opens: Callable[[str, int], bool], constant: frozenset[int] = frozenset()) -> str:
    """The text by blocks, of the elements that ``opens`` names and what stands in them."""
    blocks: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        text = squash("".join(run))
        run.clear()
        if text:
            blocks.append(text)

    inside: list[bool] = [False]
    for kind, path, what in events:
        if kind.startswith("text"):
            if inside[-1] and not (constant and (text := squash(what)) and number_of(path, text) in constant):
                run.append(what)
            continue
        tag = what.rstrip("*")
        if tag == "br":
            if kind == "open":
                run.append(" ")
        elif tag in BLOCK:
            end_block()
        if kind == "open":
            inside.append(inside[-1] or opens(what, path))
        else:
            inside.pop()
    end_block()
    return "\n".join(blocks)


def slot_texts(page: list, wrapper: list, places: dict[int, Places] | None = None) -> list[tuple[int, str, bool]]:
    """(slot, text, whether in a link) of the page's texts outside dropped regions."""
    return [(path, squash(what), kind == "text+") for kind, path, what in aligned_texts(page, wrapper, places) if kind.startswith("text") and squash(what)]


def choose_region(wrapper: list, weight: dict[int, float], blocks: dict[int, float]) -> tuple[int | None, int | None]:
    """The place of the main text by how the slots behave, and the place above it.

    ``weight`` has each slot's characters of varying text outside links, ``blocks`` how often a page has it.
    From the top the walk goes on into the one container that holds REGION_SHARE of the
    weight, as long as it holds several texts of a page; None if it never leaves the top.
    """
    totals: dict[int, tuple[float, float]] = {}
    # what repeats in a page, and what is no box, belongs to the container around it
    children: dict[int, list[tuple[int, str]]] = {}
    blocked: set[int] = set()

    def add(node: list, path: int) -> tuple[float, float]:
        total = (0.0, 0.0)
        order = Places(node[2])
        children[path] = []
        for item, name in zip(order.items, order.names):
            to = step(path, f"{name} {item[0]}")
            own = (weight.get(to, 0.0), blocks.get(to, 0.0)) if item[0] == "#text" else (0.0, 0.0) if is_dropped(item[0]) else add(item, to)
            tag = item[0].split("~")[0].rstrip("*")
            if item[0] != "#text" and item[1] not in ("+", "*"):
                children[path].append((to, item[0]))
            if own[0] > 0 and tag not in CONTAINERS and tag not in ("h1", "h2"):
                blocked.add(path)
            total = (total[0] + own[0], total[1] + own[1])
        totals[path] = total
        return total

    add(wrapper, 0)
    at, above, chosen = 0, None, (None, None)
    while totals[at][0] > 0 and at not in blocked:
        best = max((c for c in children[at] if c[0] in totals), key=lambda c: totals[c[0]][0], default=None)
        if best is None or totals[best[0]][0] < REGION_SHARE * totals[at][0] or totals[best[0]][1] < REGION_BLOCKS:
            break
        above, at = at, best[0]
        if best[1] not in ("html", "body"):
            chosen = (at, above)
    return chosen


# -- the jobs ----------------------------------------------------------------------------------


WRAPPERS = "host string, wrapper string, whole boolean"


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[str, list] = {}
    whole: set[str] = set()

    def passed_on() -> pa.RecordBatch:
        hosts, wrappers = list(known), [json.dumps(w, separators=(",", ":")) for w in known.values()]
        columns = [pa.array(hosts, pa.string()), pa.array(wrappers, pa.string()), pa.array([h in whole for h in hosts], pa.bool_())]
        known.clear()
        whole.clear()
        return pa.RecordBatch.from_arrays(columns, names=["host", "wrapper", "whole"])

    for batch in batches:
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            tree = parse(page)
            w = wrapper_of(tree)
            known[host] = merged(known[host], w) if host in known else w
            if host not in whole and not _find_main(tree):
                whole.add(host)
        if len(known) > OPEN_HOSTS:
            yield passed_on()
    yield passed_on()


def _merge_all(group: pd.DataFrame) -> pd.DataFrame:
    out = None
    for text in sorted(group["wrapper"]):
        w = json.loads(text)
        out = w if out is None else merged(out, w)
    return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [json.dumps(out, separators=(",", ":"))], "whole": [bool(group["whole"].any())]})


def infer_wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper (JSON), whole (whether a page of the host lacks an article region): one row per host."""
    partial = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(_infer, WRAPPERS).distinct()
    salted = partial.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")).applyInPandas(_merge_all, WRAPPERS)
    return salted.groupBy("host").applyInPandas(_merge_all, WRAPPERS)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's digest and its slots' texts: slot, text's number, characters, whether in a link."""
    loaded = worker_cache("html-slots", dict)
    for batch in batches:
        digests, slots = [], []
        for page, wrapper in zip(batch.column("html").to_pylist(), batch.column("wrapper").to_pylist()):
            if wrapper not in loaded:
                if len(loaded) >= OPEN_HOSTS:
                    loaded.clear()
                loaded[wrapper] = json.loads(wrapper), {}
            found = slot_texts(parse(page), *loaded[wrapper])
            digests.append(number_of(*(f"{p} {t}" for p, t, _ in found)))
            slots.append([{"slot": p, "text": number_of(p, t), "chars": len(t), "link": link} for p, t, link in found])
        kind = pa.list_(pa.struct([("slot", pa.int64()), ("text", pa.int64()), ("chars", pa.int64()), ("link", pa.bool_())]))
        yield pa.RecordBatch.from_arrays([batch.column("host"), pa.array(digests, pa.int64()), pa.array(slots, kind)], names=["host", "page", "slots"])


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for wrapper, slots in zip(batch.column("wrapper").to_pylist(), batch.column("slots").to_pylist()):
            weight = {s["slot"]: s["weight"] for s in slots or []}
            blocks = {s["slot"]: s["often"] for s in slots or []}
            found.append(choose_region(json.loads(wrapper), weight, blocks))
        columns = [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([batch.column("host"), *columns], names=["host", "region", "above"])


def regions(pages: DataFrame, wrappers: DataFrame) -> DataFrame:
    """host, region, above, constant array<bigint>: where the main text of the given hosts stands.

    Copies of a page count once.  A slot's text is constant if it stands on CONSTANT_PAGES pages or more
    and on a share of CONSTANT_SHARE of the host's; constant ones and links have no weight.  A host's slots
    are as many as its wrapper has, its constant texts at most 1 / CONSTANT_SHARE times as many as a page holds on average.
    """
    of_hosts = pages.select(host_of(F.col("url")).alias("host"), "html").join(wrappers, "host")
    rows = of_hosts.select("host", "html", "wrapper").mapInArrow(
        _slots, "host string, page bigint, slots array<struct<slot:bigint,text:bigint,chars:bigint,link:boolean>>"
    )
    # one row of each page's copies, by an aggregate that sums where the rows lie
    rows = written(rows.groupBy("host", "page").agg(F.first("slots").alias("slots")), "html_slots")
    total = rows.groupBy("host").agg(F.count("*").alias("total"))
    texts = rows.select("host", "page", F.explode("slots").alias("s")).groupBy("host", "s.slot", "s.text", "s.link")
    texts = texts.agg(F.countDistinct("page").alias("n"), F.count("*").alias("times"), F.sum("s.chars").alias("chars")).join(total, "host")
    texts = texts.withColumn("constant", (F.col("n") >= CONSTANT_PAGES) & (F.col("n") >= F.col("total") * CONSTANT_SHARE))
    texts = written(texts, "html_texts")
    constant = texts.where("constant").groupBy("host").agg(F.sort_array(F.collect_set("text")).alias("constant"))
    weight = F.sum(F.when(F.col("constant") | F.col("link"), 0).otherwise(F.col("chars"))).cast("double")
    slots = texts.groupBy("host", "slot").agg(weight.alias("weight"), (F.sum("times") / F.max("total")).alias("often"))
    slots = slots.groupBy("host").agg(F.collect_list(F.struct("slot", "weight", "often")).alias("slots"))
    chosen = wrappers.join(slots, "host", "left").select("host", "wrapper", "slots").mapInArrow(_regions, "host string, region bigint, above bigint")
    return chosen.join(constant, "host", "left")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, host, text: the main text of every page."""
    wrappers = written(infer_wrappers(pages), "html_wrappers")
    whole = wrappers.where("whole").select("host", "wrapper")
    if whole.isEmpty():
        none = F.lit(None).cast("bigint")
        wrappers = wrappers.select("*", none.alias("region"), none.alias("above"), F.lit(None).cast("array<bigint>").alias("constant"))
    else:
        wrappers = written(wrappers.join(regions(pages, whole), "host", "left"), "html_readers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loaded = worker_cache("html-wrappers", dict)
        for batch in batches:
            texts = []
            columns = (batch.column(n) for n in ("html", "wrapper", "region", "above", "constant"))
            for page, wrapper, region, above, constant in zip(*(c.to_pylist() for c in columns)):
                key = wrapper, region, above, tuple(constant or ())
                if key not in loaded:
                    if len(loaded) >= OPEN_HOSTS:
                        loaded.clear()
                    loaded[key] = json.loads(wrapper) if wrapper else ["#page", "", []], Region(region, above, frozenset(key[3])), {}
                shape, place, known = loaded[key]
                texts.append(main_text(parse(page), shape, region=place, places=known))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), batch.column("host"), pa.array(texts, pa.string())],
                names=["page_id", "url", "host", "text"],
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    return rows.join(wrappers.drop("whole"), "host", "left").mapInArrow(run, "page_id bigint, url string, host string, text string")
