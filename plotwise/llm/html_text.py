"""Main text of web pages by site style trees.

The pages of a host are merged into one tree: a node is a path of tags and
classes, with the sequences of child tags seen under it (presentation) and the
text blocks seen in it (content). Presentation counts as important if it varies
over pages, content if blocks are not the same on many pages: both are entropies in base m, the number of pages
that have the node, drawn to 1 by a prior that weighs as much as one page. A text block belongs
to the innermost branch that could be a template, and is cut from every page of the host if
that branch's importance is low: a wrapper never goes with what it wraps. A branch on one page only is
important. Pages of a host with equal html count once. Branches that name themselves
as menus, adverts, forms and the like are cut wherever they are; of the rest the article is
taken, if the page marks one.

Counts travel as hashes; pages are never grouped by host.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plotwise.llm.common import materialise

#: A branch goes under this importance.
LEAST_IMPORTANCE = 0.5
#: Pages on which all differs that every branch is taken to have been seen on besides.
PRIOR_PAGES = 1.0
DAMPING = 0.9           # weight of content against presentation falls with the number of styles

# Elements by role.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp".split())
DROPPED = frozenset("head nav aside footer form script style textarea title noscript iframe noembed noframes template svg math object canvas select button dialog menu".split())
ARTICLE = frozenset(("article", "main"))
#: Elements that text is made of; without a class or id of their own they are never template branches.
PLAIN = frozenset("html body article main p h1 h2 h3 h4 h5 h6 li blockquote pre table tbody thead tfoot tr td th dl dt dd figcaption".split())
CLOSES_P = BLOCKS - {"caption", "dd", "dt", "li", "tbody", "td", "tfoot", "th", "thead", "tr", "body", "html"}
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
            "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"})}
NOISE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion cookie cookies
    consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation breadcrumb
    breadcrumbs footer masthead topbar comment comments disqus respond replies reply related recommended share sharing social toolbar pagination
    pager login signup search searchbox widget widgets contentinfo complementary""".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/<>]*)|<[/!?][^<>]*>?", re.DOTALL)
#: Attributes up to the next quoted value, whose quote is the group, or to the next angle bracket. Only after = does a quote open a value.
_ATTRIBUTES = re.compile(r"[^<>=]*+(?:=\s*+(?:[^\s\"'<>][^\s<>]*+|(?=>))[^<>=]*+)*+(?:=\s*+([\"']))?")
_BROKEN = re.compile(r"[^<>]*>?")
_ATTRIBUTE = re.compile(r"([^\s=/]++)(?:\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'<>][^\s<>]*)))?")
NAMES = frozenset(("class", "id", "role"))
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])", re.IGNORECASE) for t in RAW}
_TOKEN = re.compile(r"[^a-z0-9]+")


class _Node:
    __slots__ = ("tag", "path", "noise", "children", "features", "article", "plain")

    def __init__(self, tag: str, names: str, above: _Node | None):
        label = tag + ("." + ".".join(sorted(set(names.split()))) if names else "")
        self.tag, self.path = tag, f"{above.path}/{label}" if above else label
        inside = above is not None and above.article
        own = {x for n in names.split() for x in _TOKEN.split(n)}
        self.article = inside or tag in ARTICLE
        # a header inside the article holds its title
        self.noise = (above is not None and above.noise) or tag in DROPPED or (tag == "header" and not inside) or (
            bool(own & NOISE_NAMES) and tag not in ("html", "body"))
        self.plain = tag in PLAIN and not names
        self.children: list[str] = []
        self.features: set[int] = set()


def _closed(stack: list[_Node], tags: set[str] | frozenset[str], until: set[str] | frozenset[str]) -> int:
    """Length of the stack once the outermost of ``tags`` above the nearest of ``until`` is closed."""
    keep = len(stack)
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in until:
            break
        if stack[k].tag in tags:
            keep = k
    return keep


def _tag_end(html: str, at: int, dead: set[int]) -> int:
    """Place of the > that ends the tag whose name ends at ``at``, -1 if there is none. ``dead`` holds the
    quotes that earlier tags without an end went through, so that all tags of a page take linear time."""
    opened = []
    while True:
        m = _ATTRIBUTES.match(html, at)
        at = m.end()
        if m.group(1) is None:
            if html.startswith(">", at):
                return at
            break
        opened.append(at)
        close = -1 if at in dead else html.find(m.group(1), at)
        if close < 0:
            break
        at = close + 1
    dead.update(opened)
    return -1


def walk(html: str) -> tuple[list[tuple[str, list[_Node]]], list[_Node]]:
    """Text blocks in page order, each with its open elements, and all block
    elements. Missing end tags are implied as browsers do for p, li, dd, dt and table parts."""
    stack = [_Node("", "", None)]
    blocks: list[tuple[str, list[_Node]]] = []
    nodes: list[_Node] = []
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = " ".join(unescape("".join(pending)).split())
            pending.clear()
            if text:
                blocks.append((text, list(stack)))

    at, n = 0, len(html)
    dead: set[int] = set()
    while at < n:
        m = _TAG.search(html, at)
        if m is None:
            pending.append(html[at:])
            break
        if m.start() > at:
            pending.append(html[at:m.start()])
        at = m.end()
        tag = m.group(2)
        if tag is None:
            continue
        end = _tag_end(html, at, dead)
        if end < 0:
            at = _BROKEN.match(html, at).end()
            continue
        attrs, at = html[at:end], end + 1
        tag, closing = tag.lower(), m.group(1)
        if tag == "br":
            pending.append(" ")
            continue
        if closing:
            if any(x.tag == tag for x in stack[1:]):
                flush()
                while stack.pop().tag != tag:
                    pass
            continue
        names = ""
        if "=" in attrs:
            names = " ".join(a or b or c for k, a, b, c in _ATTRIBUTE.findall(attrs) if k.lower() in NAMES).lower()
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = end.start() if end else n
            if end:
                close = html.find(">", at)
                at = close + 1 if close >= 0 else n
            continue
        block = tag in BLOCKS
        if not block and tag not in DROPPED and not names:
            continue                                        # inline markup only
        if tag in VOID or attrs.endswith("/") and not block:
            if block:
                flush()
            continue
        if block:
            flush()
            if tag in CLOSES_P and any(x.tag == "p" for x in stack):
                del stack[_closed(stack, {"p"}, {"button", "td", "th", "table", "caption"}):]
            if tag in SIBLINGS:
                del stack[_closed(stack, *SIBLINGS[tag]):]
        node = _Node(tag, names, stack[-1])
        if not block and not node.noise:
            continue                                        # an inline element that is no noise
        if block:
            stack[-1].children.append(tag)
            nodes.append(node)
        else:
            flush()
        stack.append(node)
    flush()
    return blocks, nodes


def _hash(s: str) -> int:
    return xxhash.xxh3_64_intdigest(s) - (1 << 63)


def site_of(url: str | None) -> str:
    """Host of a URL without user and port, lower case; empty without one."""
    rest = (url or "").split("://", 1)[-1]
    return re.split(r"[/?#]", rest, maxsplit=1)[0].rsplit("@", 1)[-1].split(":", 1)[0].lower()


def _runs(tags: list[str]) -> str:
    return " ".join(t for i, t in enumerate(tags) if i == 0 or t != tags[i - 1])


def _branch(stack: list[_Node]) -> _Node | None:
    """Innermost of the open elements that may be a template branch."""
    return next((x for x in stack[:0:-1] if not x.plain), None)


def page_features(html: str) -> list[tuple[int, int, int]]:
    """(path, kind, value) of one page, each once: kind 0 the node is there, 1 its
    sequence of child tags, 2 a text block of it. Only branches that may be templates count."""
    blocks, nodes = walk(html)
    out = set()
    for text, stack in blocks:
        node = _branch(stack)
        if node is not None:
            node.features.add(_hash(text))
    for node in nodes:
        if not node.plain and node.features:
            p = _hash(node.path)
            out.add((p, 0, 0))
            out.add((p, 1, _hash(_runs(node.children))))
            out.update((p, 2, f) for f in node.features)
    return sorted(out)


def main_text(html: str, cut: set[int] | frozenset[int] = frozenset()) -> str:
    """The page's blocks outside noise and outside branches in ``cut`` (path hashes);
    only those in an article or main element if such a one has text."""
    blocks, _ = walk(html)
    known: dict[str, bool] = {}

    def gone(node: _Node | None) -> bool:
        if node is None:
            return False
        if node.path not in known:
            known[node.path] = _hash(node.path) in cut
        return known[node.path]

    kept = [(t, s) for t, s in blocks if not s[-1].noise and not (cut and gone(_branch(s)))]
    marked = [t for t, s in kept if s[-1].article]
    return "\n\n".join(marked or [t for t, _ in kept])


def low_branches(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path: branches of the hosts' style trees with low importance."""
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item = pa.struct([("path", pa.int64()), ("kind", pa.int32()), ("value", pa.int64())])
        for b in batches:
            found = [[{"path": p, "kind": k, "value": v} for p, k, v in page_features(h.as_py() or "")] for h in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array([site_of(u.as_py()) for u in b.column(0)], pa.string()),
                                              pa.array([_hash(h.as_py() or "") for h in b.column(1)], pa.int64()), pa.array(found, pa.list_(item))],
                                             names=["host", "page", "found"])

    rows = (pages.select(F.col(url_col), F.col(html_col))
                 .mapInArrow(features, "host string, page bigint, found array<struct<path bigint, kind int, value bigint>>")
                 .dropDuplicates(["host", "page"])
                 .select("host", F.explode("found").alias("f")).select("host", "f.path", "f.kind", "f.value"))
    counted = rows.groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    sums = counted.groupBy("host", "path").agg(
        F.max(F.when(F.col("kind") == 0, F.col("n"))).alias("m"),
        F.count_if(F.col("kind") == 1).alias("styles"),
        F.sum(F.when(F.col("kind") == 1, F.col("n") * F.log("n"))).alias("s"),
        F.sum(F.when(F.col("kind") == 2, F.col("n") * F.log("n"))).alias("c"), F.sum(F.when(F.col("kind") == 2, F.col("n"))).alias("blocks"))
    log_m = F.log("m")
    # entropies in base m of the styles over pages and of the blocks over their occurrences, near 1 if all differ, 0 if all are one
    presentation = F.lit(1.0) - F.col("s") / (F.col("m") * log_m)
    content = F.lit(1.0) - F.col("c") / (F.col("blocks") * log_m)
    damp = F.pow(F.lit(DAMPING), F.col("styles"))
    seen = (1 - damp) * presentation + damp * content
    importance = (F.col("m") * seen + PRIOR_PAGES) / (F.col("m") + PRIOR_PAGES)
    return sums.filter(F.col("m") >= 2).filter(importance < LEAST_IMPORTANCE).select("host", "path")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: id, url, text, n_chars.

    Null or empty html, and pages without main text, give an empty text. Pages
    without a host count as one site. Repeated rows and null ids are kept;
    extra columns are not read. An empty table gives an empty table.
    """
    # written before the join, so that its size is known: Spark broadcasts it if small and splits a hot host if not
    low = materialise(low_branches(pages, url_col, html_col).groupBy("host").agg(F.collect_set("path").alias("cut")), "low-branches")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [main_text(h.as_py() or "", frozenset(c.as_py() or ())) for h, c in zip(b.column(2), b.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.string())], names=["id", "url", "text"])

    bare = F.regexp_replace(F.coalesce(F.col(url_col), F.lit("")), "^.*?://", "")
    host = F.lower(F.regexp_extract(F.regexp_replace(F.regexp_extract(bare, "^[^/?#]*", 0), "^.*@", ""), "^[^:]*", 0))
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), host.alias("_host"))
    kind = src.schema["id"].dataType.simpleString()
    return (src.join(low, F.col("_host") == F.col("host"), "left").select("id", "url", "html", "cut")
               .mapInArrow(texts, f"id {kind}, url string, text string")
               .select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars")))
