"""Main text of web pages by the path that most pages of a host agree on.

Each page's containers are scored by the text in their paragraphs, less links.
Pages vote for the generalised path of tags and classes of their best containers;
Spark sums the votes by host. The pages are then read again, each with its host's
winning path; a page without such a container falls back to its own best one.

An element that a class or id calls a menu, an advert or the like goes only if it does
not hold most of the page's text: a word in a class does not outweigh an article.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lopside.llm.common import given_back, guarded, small_batches, stored

# Elements of HTML by what they do to a text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe object svg canvas audio video textarea title".split())
ENDLESS = frozenset("script style iframe textarea title".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
                   "search section select summary table tbody td tfoot th thead tr ul caption").split())
CONTAINERS = frozenset("article main section div td body dd center blockquote form".split())
PARAGRAPHS = frozenset("p pre h1 h2 h3 h4 h5 h6 li dt dd blockquote td th figcaption caption".split())
DROPPED = frozenset("nav aside footer header button select option menu head search annotation annotation-xml".split())
WRAPPERS = frozenset("form dialog".split())
NOISE = frozenset((
    "ad ads advert adverts advertisement advertising adsense banner promo promoted promotion sponsor sponsored sponsors nav navbar "
    "navigation menu menus breadcrumb breadcrumbs sidebar sidebars aside side rail footer header masthead topbar cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay comment comments commentlist disqus reply replies respond "
    "discussion share sharing social related recommended recommendations more newsletter subscribe subscription signup login "
    "form search toolbar pagination pager skip copyright legal disclaimer widget tags byline-share outbrain taboola").split())
COMMENTS = frozenset("comment comments commentlist disqus replies respond".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising adsense sponsored cookie cookies consent gdpr newsletter popup "
                    "modal outbrain taboola".split())
UNSURE = frozenset("more legal form side tags discussion reply response skip rail header".split())
NEGATIONS = frozenset("has no not with without hide show is".split())
STATES = frozenset("open closed enabled disabled on off".split())
ARTICLES = frozenset("entry post article story content body text page".split())
ROLES = frozenset("navigation banner complementary contentinfo search form dialog alert alertdialog menu menubar".split())
_TOKEN = re.compile(
    r"<!--(?:.*?(?:-->|--!>)|.*\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S)
_ATTRIBUTE = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PIECES = re.compile(r"[^a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


# What the mark-up says of an element, before its text is weighed.
PLAIN, SUSPECT, FOREIGN, GONE = range(4)


class Node:
    __slots__ = ("tag", "label", "parent", "depth", "verdict", "dropped", "linked", "block", "container", "articles")

    def __init__(self, tag: str, label: str, parent: Node | None, verdict: int = PLAIN):
        self.tag, self.label, self.parent, self.verdict = tag, label, parent, verdict
        self.depth = 0 if parent is None else parent.depth + 1
        self.dropped = False
        self.articles = (tag in ("article", "main") and verdict == PLAIN) + (0 if parent is None else parent.articles)
        self.linked = tag == "a" or (parent is not None and parent.linked)
        self.block = self if tag in BLOCK or parent is None else parent.block
        self.container = self if tag in CONTAINERS or parent is None else parent.container

    def path(self) -> str:
        names, node = [], self
        while node is not None:
            names.append(node.label)
            node = node.parent
        return ">".join(reversed(names[:-1]))


def _verdict(tag: str, attributes: dict[str, str], inside_article: bool) -> int:
    """``GONE``: never text; ``FOREIGN``: comments and adverts; ``SUSPECT``: depends on what the element holds."""
    if tag in DROPPED:
        return PLAIN if tag == "header" and inside_article else GONE
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(attributes.get("style", "")):
        return GONE
    found = SUSPECT if tag in WRAPPERS or attributes.get("role", "").lower() in ROLES else PLAIN
    if "class" not in attributes and "id" not in attributes:
        return found
    whole = tag in ("html", "body", "article", "main")
    for token in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        words = [w for w in _PIECES.split(token) if w]
        if not words or words[0] in NEGATIONS or words[-1] in STATES or not NOISE.intersection(words):
            continue
        ends = {words[0], words[-1]}
        if COMMENTS & ends or (ADVERTS & ends and not whole):
            return FOREIGN
        if whole or (inside_article and UNSURE.issuperset(NOISE.intersection(words))) or (
                words[-1] == "header" and ARTICLES.intersection(words)):
            continue
        found = SUSPECT
    return found


def weigh(root: Node, nodes: list[Node], texts: list[tuple[Node, str]]) -> None:
    """Settle which elements are dropped: suspects go, unless they hold most of what is left of the page.

    Comments and adverts go in any case, unless they hold the page's heading as well. An element beside an article
    or main element of the page never holds the page. All in one pass up and one down, without recursion.
    """
    lost = {root: False}
    for node in nodes:  # an element comes after its parent
        lost[node] = lost[node.parent] or node.verdict == GONE
    size, heads, articles = dict.fromkeys(lost, 0), dict.fromkeys(lost, 0), dict.fromkeys(lost, 0)
    for node, text in texts:
        if not (node.linked or lost[node]):
            size[node] += len(text) - text.count(" ") - text.count("\n")
    for node in reversed(nodes):
        if not lost[node]:
            heads[node] += node.tag == "h1"
            articles[node] += node.tag in ("article", "main") and node.verdict == PLAIN
        above = node.parent
        heads[above] += heads[node]
        articles[above] += articles[node]
        size[above] += size[node]
    foreign, kept = 0, set()
    out = {root: False}
    for node in nodes:  # foreign elements first: what they hold is no part of the page
        out[node] = out[node.parent] or lost[node]
        if node.verdict == FOREIGN and not out[node]:
            beside = articles[root] - articles[node] - node.articles > 0
            if heads[node] and not beside and 2 * size[node] > size[root]:
                kept.add(node)
            else:
                out[node] = True
                foreign += size[node]
    page = size[root] - foreign
    inner = dict.fromkeys(lost, 0)
    if foreign:
        for node in nodes:
            if out[node] and not out[node.parent] and not lost[node]:
                inner[node] = size[node]
        for node in reversed(nodes):
            inner[node.parent] += inner[node]
    for node in nodes:
        gone = node.parent.dropped or out[node]
        if node.verdict == SUSPECT and not gone:
            beside = articles[root] - articles[node] - node.articles > 0
            gone = beside or 2 * (size[node] - inner[node]) <= page
        node.dropped = gone


def parse(page: str) -> list[tuple[Node, str]]:
    """The page's texts in order, each with the element it stands in; scripts, styles and titles are left out.

    Unclosed and stray tags are taken as browsers do in the common cases; an unfinished tag at the end is dropped.
    An unclosed script, style, frame or title takes the rest of the page, other unclosed objects take nothing.
    """
    root = Node("", "", None)
    nodes: list[Node] = []
    out: list[tuple[Node, str]] = []
    _read(page, root, nodes, out)
    weigh(root, nodes, out)
    return out


def _read(page: str, root: Node, nodes: list[Node], out: list[tuple[Node, str]]) -> None:
    stack, at, lower, unclosed = [root], 0, None, set()
    while True:
        found = _TOKEN.search(page, at)
        if found is None:
            if at < len(page):
                out.append((stack[-1], page[at:]))
            return
        if found.start() > at:
            out.append((stack[-1], page[at:found.start()]))
        at = found.end()
        tag = found[2] or found[5]
        if not tag:
            continue
        tag = tag.lower()
        if found[1] or found[4]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in RAW:
            if tag in unclosed or (found[3] or found[6] or "").endswith("/"):
                continue
            lower = page.lower() if lower is None else lower
            end = lower.find(f"</{tag}", at)
            if end >= 0:
                at = end
            elif tag in ENDLESS:
                return
            else:
                unclosed.add(tag)
            continue
        if tag in VOID:
            out.append((stack[-1], " "))
            if tag == "hr":
                nodes.append(Node(tag, tag, stack[-1]))
                out.append((nodes[-1], ""))
            continue
        if tag in BLOCK:
            _close(stack, ("p",), ())
        if tag == "li":
            _close(stack, ("li",), ("ul", "ol", "menu"))
        elif tag in ("td", "th"):
            _close(stack, ("td", "th"), ("tr", "table"))
        elif tag == "tr":
            _close(stack, ("tr",), ("table",))
        elif tag in ("dt", "dd"):
            _close(stack, ("dt", "dd"), ("dl",))
        elif tag == "option":
            _close(stack, ("option",), ("select",))
        attributes = {a.lower(): b or c or d or "" for a, b, c, d in _ATTRIBUTE.findall(found[3] or found[6] or "")}
        first = next(iter(re.sub(r"[\d>]+", "", attributes.get("class", "")).split()), "")
        if tag == "body" or tag == "html":
            if any(n.tag == tag for n in stack):
                continue
        if tag == "body":
            _close(stack, ("head",), ())
        verdict = _verdict(tag, attributes, stack[-1].articles > 0)
        stack.append(Node(tag, f"{tag}.{first.lower()}" if first else tag, stack[-1], verdict))
        nodes.append(stack[-1])


def _close(stack: list[Node], tags: tuple, limits: tuple) -> None:
    """Close the nearest open element of ``tags``, unless one of ``limits`` stands between."""
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            del stack[k:]
            return
        if stack[k].tag in limits or (stack[k].tag in CONTAINERS and not limits):
            return


def blocks(texts: list[tuple[Node, str]]) -> list[tuple[Node, str, int]]:
    """(block element, text, characters in links), white space as single spaces, empty blocks left out."""
    out: list[tuple[Node, str, int]] = []
    block, parts, linked = None, [], 0

    def flush():
        text = " ".join(entities.unescape("".join(parts)).split())
        if text:
            out.append((block, text, min(linked, len(text))))

    for node, text in texts:
        if node.block is not block:
            if parts:
                flush()
            block, parts, linked = node.block, [], 0
        if not node.dropped:
            parts.append(text)
            linked += len(text) if node.linked else 0
    if parts:
        flush()
    return out


def scores(found: list[tuple[Node, str, int]]) -> list[tuple[str, int]]:
    """Containers' paths with their points: the unlinked text of their own blocks, half of what their inner ones hold."""
    points: dict[Node, int] = {}
    for block, text, linked in found:
        gain = max(len(text) - 2 * linked, 0)
        container = block.container if block.tag not in CONTAINERS else block
        if block.tag not in PARAGRAPHS:
            gain //= 2
        while gain and container is not None:
            points[container] = points.get(container, 0) + gain
            gain //= 2
            container = container.parent.container if container.parent is not None else None
    by_path: dict[str, int] = {}
    for node, gain in points.items():
        path = node.path()
        by_path[path] = max(by_path.get(path, 0), gain)
    return sorted(by_path.items(), key=lambda x: (-x[1], x[0]))


def extract(found: list[tuple[Node, str, int]], path: str | None) -> str:
    """The blocks inside the containers of ``path``; without any, inside the page's own best container."""
    inside: dict[Node, bool] = {}

    def within(node: Node, path: str) -> bool:
        """Whether the container of ``path`` is ``node`` or stands above it."""
        depth, seen = path.count(">") + 1 if path else 0, []
        while node not in inside and node.depth > depth:
            seen.append(node)
            node = node.parent
        if node not in inside:
            inside[node] = node.depth == depth and node.path() == path
        for lower in seen:
            inside[lower] = inside[node]
        return inside[node]

    if path is None or not any(within(b, path) for b, _, _ in found):
        best = scores(found)
        if not best:
            return ""
        path = best[0][0]
        inside.clear()
    return "\n".join(text for b, text, _ in found if within(b, path))


def host_of(url):
    return F.coalesce(F.lower(F.regexp_extract(url.cast("string"), r"^[^/]*//(?:[^/@]*@)?([^/:?#]*)", 1)), F.lit(""))


def votes(pages: DataFrame, best: int = 3) -> DataFrame:
    """(host, path, points): each page shares 1000 points out among its ``best`` containers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[tuple[str, str], int] = {}
            for host, page in zip(*(c.to_pylist() for c in batch.columns)):
                top = scores(blocks(parse(page)))[:best]
                whole = sum(p for _, p in top)
                for path, points in top:
                    total[host, path] = total.get((host, path), 0) + 1000 * points // whole
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in total], pa.string()), pa.array([k[1] for k in total], pa.string()),
                                              pa.array(total.values(), pa.int64())], names=["host", "path", "points"])

    rows = pages.select(host_of(pages["url"]).alias("host"), F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    return rows.mapInArrow(run, "host string, path string, points long").groupBy("host", "path").agg(F.sum("points").alias("points"))


def consensus(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most points on each host, ties to the first by name."""
    return (votes(pages).groupBy("host")
            .agg(F.max_by("path", F.struct("points", F.col("path"))).alias("path")))


def main_text(pages: DataFrame, salts: int = 32) -> DataFrame:
    """All columns of ``pages`` (url, html, ...) and ``text``, the main text of each page.

    ``text``: the blocks of the article, one per line, character references decoded; empty if there is none.
    Null and empty pages give an empty text; null urls share a host of their own; repeated rows are
    extracted alike; a column named ``text`` is replaced, other columns may have any name; an empty table gives no rows.
    """
    small_batches(pages.sparkSession, 500)
    pages, given = guarded(pages, "url", "html")
    winners = stored(consensus(pages)).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    names = pages.columns
    rows = pages.select(*names).withColumn("_host", host_of(F.col("url"))).withColumn(
        "_salt", F.pmod(F.xxhash64("url", "html"), F.lit(salts)).cast("int"))
    rows = rows.join(winners.select(F.col("host").alias("_host"), F.col("path").alias("_path"), "_salt"), ["_host", "_salt"], "left")
    rows = rows.select(*names, "_path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(blocks(parse(page or "")), path)
                     for page, path in zip(batch.column("html").to_pylist(), batch.column("_path").to_pylist())]
            yield batch.drop_columns(["_path"]).append_column("text", pa.array(texts, pa.string()))

    fields = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in names)
    return given_back(rows.mapInArrow(run, f"{fields}, text string"), given, "text")
