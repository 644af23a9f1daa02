"""URL filters: block and allow rules, carried to aliases through redirect equivalence.

A rule names a host (with all its subdomains) and a path prefix; the longest rule that fits
a url decides it, an allow before a block of the same length.  Urls that no rule fits take the
decision of their redirect-equivalence class: the connected component over canonical-link
and redirect edges.  A class that holds an explicitly allowed url allows, else one that holds
a blocked url blocks, else the url is allowed.  An explicit rule of the url itself always
stands.

A url's identity in the graph is its scheme-less form without fragment, host in lower case,
dot segments taken out and the empty path as /.  Links are resolved against their page's url,
with all character references decoded.  Rules judge a page by its path as written.
Rules are a policy of at most a few hundred entries, compiled into one expression; the pages
themselves never leave their partition except through equi-joins on the url.

Defined cases: a null url, or one without ``://``, has an empty host and path, fits no rule,
has no aliases and is allowed; null html has no links; repeated rows give repeated results;
an empty table gives no rows.  Only page_id, url and html are read, so further columns cannot
clash.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator, Sequence
from html.entities import html5
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components


class Rule(NamedTuple):
    action: str  # allow or block
    host: str
    path: str


URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Comments, elements whose content is no markup, and the tags that say where a page stands.
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|textarea|title|template|xmp)\b.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<tag>link|meta|base)\b(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>",
    re.DOTALL | re.IGNORECASE,
)
#: One attribute: its name, and its whole value (quoted or not).
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
REFRESH = re.compile(r"""\s*[\d.]*\s*[;,]?\s*url\s*=\s*(?:"([^"]*)|'([^']*)|(.*))""", re.IGNORECASE | re.DOTALL)


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def normal_path(path: Column) -> Column:
    """An absolute path without dot segments; the empty path is the root."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, 2, F.size(segments)),
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc).when(s == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(s))),
    )
    folder = path.rlike(r"/\.\.?$") & (F.size(kept) > 0)
    dotless = F.concat(F.lit("/"), F.array_join(kept, "/"), F.when(folder, F.lit("/")).otherwise(F.lit("")))
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(/|$)"), dotless).otherwise(path)


def url_key(url: Column) -> Column:
    """Identity of a url; null if it has no host."""
    key = F.concat(host_of(url), normal_path(path_of(url)), F.regexp_extract(url, URL, 3))
    return F.when(host_of(url) != "", key)


def resolve(base: Column, href: Column) -> Column:
    """An absolute form of href as found on the page at base; url_key takes out its dot segments."""
    root = F.regexp_extract(base, r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_replace(path_of(base), r"[^/]*$", "")
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^.*?:(?=//)", 0), href))
        .when(href.startswith("/"), F.concat(root, href))
        .when(href.startswith("?"), F.concat(root, path_of(base), href))
        .when(href.startswith("#"), base)
        .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href))
    )


def _decoded(m: re.Match) -> str:
    """A character reference as an attribute's value has it: without ; a name before = or a longer word stands."""
    name = m.group(1)
    if name.startswith("#"):
        return html_lib.unescape(m.group())
    if not name.endswith(";") and m.string[m.end() : m.end() + 1] == "=":
        return m.group()
    return html5.get(name, m.group())


REFERENCE = re.compile(r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]*;?)")


def attributes(text: str) -> dict[str, str]:
    """Decoded attributes by lower-case name; of repeated ones the first one counts."""
    found: dict[str, str] = {}
    for name, a, b, c in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), REFERENCE.sub(_decoded, a or b or c))
    return found


def links_of(html: str) -> tuple[list[str], str | None]:
    """The targets of a page's canonical links and refreshes, and of its first base element."""
    targets, base = [], None
    for m in TAG.finditer(html):
        if m.group("tag") is None:
            continue
        tag, given = m.group("tag").lower(), attributes(m.group("attrs"))
        if tag == "base":
            base = given.get("href") if base is None else base
        elif tag == "link" and "canonical" in given.get("rel", "").lower().split():
            targets.append(given.get("href", ""))
        elif tag == "meta" and given.get("http-equiv", "").strip().lower() == "refresh":
            if found := REFRESH.match(given.get("content", "")):
                targets.append(found.group(1) or found.group(2) or found.group(3) or "")
    return [t.strip() for t in targets if t.strip()], base


def _read_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        urls, hrefs, bases = [], [], []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            found, base = links_of(html)
            for href in found:
                urls.append(url)
                hrefs.append(href)
                bases.append(base)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in (urls, hrefs, bases)], names=["url", "href", "base"])


def link_edges(pages: DataFrame) -> DataFrame:
    """src, dst: identities that a canonical link or a redirect joins."""
    found = pages.where(F.col("html").rlike("(?i)canonical|refresh")).select("url", "html")
    links = found.mapInArrow(_read_links, "url string, href string, base string")
    base = F.when(F.col("base").isNotNull(), resolve(F.col("url"), F.col("base"))).otherwise(F.col("url"))
    edges = links.select(url_key(F.col("url")).alias("src"), url_key(resolve(base, F.col("href"))).alias("dst"))
    return edges.where("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").distinct()


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """struct<action, rule> of the longest fitting rule; null if none fits."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), r.action != "allow", r))
    hit = F.lit(None).cast("struct<action:string,rule:string>")
    for r in reversed(order):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        hit = F.when(fits, F.struct(F.lit(r.action).alias("action"), F.lit(r.host + r.path).alias("rule"))).otherwise(hit)
    return hit


def class_verdicts(edges: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """key, class_verdict, class_id for every url in an equivalence class with an edge."""
    nodes = connected_components(edges)
    as_url = F.concat(F.lit("x://"), F.col("node"))
    hit = best_rule(host_of(as_url), path_of(as_url), rules)
    votes = nodes.withColumn("action", hit["action"])
    verdict = (
        votes.groupBy("component")
        .agg(F.max((F.col("action") == "allow").cast("int")).alias("allow"), F.max((F.col("action") == "block").cast("int")).alias("block"))
        .select("component", F.when(F.col("allow") == 1, "allow").when(F.col("block") == 1, "block").otherwise("allow").alias("class_verdict"))
    )
    return nodes.join(verdict, "component").select(F.col("node").alias("key"), "class_verdict", F.col("component").alias("class_id"))


def judge(pages: DataFrame, rules: Sequence[Rule], edges: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, class_id (the class's smallest url, null without links).

    ``edges`` (src, dst urls) may add redirects from a crawl log to the links of the pages.
    """
    links = link_edges(pages)
    if edges is not None:
        links = links.union(edges.select(url_key(F.col("src")), url_key(F.col("dst"))))
    classes = class_verdicts(written(links, "url_links"), rules)
    judged = pages.select("page_id", "url").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), url_key(F.col("url")).alias("key")
    )
    judged = judged.withColumn("hit", best_rule(F.col("host"), F.col("path"), rules))
    # urls without a host have no aliases; as null keys they would all meet in one task
    alone = judged.where("key IS NULL").withColumn("class_verdict", F.lit(None).cast("string")).withColumn("class_id", F.lit(None).cast("string"))
    judged = judged.where("key IS NOT NULL").join(classes, "key", "left").unionByName(alone)
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", "class_verdict", F.lit("allow")).alias("verdict"),
        "class_id",
    )
