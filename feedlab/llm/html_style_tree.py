"""Main text of web pages by a site style tree.

Pages of one host are merged into a style tree (Yi, Liu and Li, "Eliminating
Noisy Information in Web Pages for Data Mining", 2003): its nodes are element
paths (tag, id, classes), and each node gathers, over the host's pages, the
presentations (child sequences) and the contents (text blocks) seen there.  A
node whose contents repeat from page to page, or whose presentation never
varies, has low importance; a branch whose combined importance is low is
removed from every page of the host.

Every block element is judged, on hosts of two pages and more.  Markup is
evidence beside the entropies: the importance from the tree (drawn towards 1 as if
``PRIOR_PAGES`` more pages had spoken for the node) is multiplied by what the
element's tag, role and class words leave of it (``Element.factor``), and plain
article text has a floor (``ARTICLE_FLOOR``).  So a navigation element goes on any
host, a "related-work" section of an article goes only where its content repeats
from page to page, and an unmarked block goes if the tree says so.

The tree is never built in one place: pages emit their nodes as rows, and the
entropies are two nested aggregates by (host, path).  Copies of a page count
once.  Only the low-importance paths of a page travel back to it.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlab.llm.common import map_arrow, materialize

# Pages that speak for a node before any of its host's is seen, and the least
# importance of an article's own unclassed text.
PRIOR_PAGES = 2
ARTICLE_FLOOR = 0.9
# What markup leaves of a node's importance: elements and roles that are not
# content, class words that say so, and words that an article uses as well.
TAG_FACTOR, WORD_FACTOR, DOUBTFUL_FACTOR = 0.1, 0.2, 0.6
# Branches below this combined importance go.
MIN_IMPORTANCE = 0.35
# Weight that a level of the tree passes on to what is below it.
DECAY = 0.9

# --- fixed values: HTML element kinds and common class names ------------------
RAW_TAGS = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noembed", "noframes", "xmp"}
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK_TAGS = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre
search section select summary table tbody td tfoot th thead tr ul""".split())
NOISE_TAGS = set("""nav footer aside form head script style noscript template iframe object embed applet svg canvas
audio video button select option textarea input dialog menu search datalist fieldset""".split())
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alertdialog",
               "alert", "menu", "menubar", "toolbar", "note"}
NOISE_WORDS = set("""ad ads adv advert adverts advertisement advertising adsense adslot adbox banner banners sponsor
sponsored cookie cookies consent gdpr menu menus nav navbar navigation breadcrumb breadcrumbs sidebar sidebars masthead
footer footers comment comments commentlist respond replies disqus social sharing newsletter subscribe subscription
signup login popup modal overlay widget widgets toolbar pagination pager copyright""".split())
DOUBTFUL_WORDS = set("""alert disclaimer discussion header headers notice notices promo promotion recommendations
recommended related reply share""".split())
ARTICLE_WORDS = {"comment", "comments", "reply", "ad", "advert"}
CONTENT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "blockquote", "pre", "td", "tr", "table",
                "tbody", "thead", "th", "dl", "dt", "dd", "figure", "figcaption", "section", "article", "main"}
# An open element of the second set ends when one of the first begins.
IMPLIED_ENDS = (({"li"}, {"li"}), ({"dt", "dd"}, {"dt", "dd"}), ({"tr"}, {"tr", "td", "th"}), ({"td", "th"}, {"td", "th"}),
                ({"option"}, {"option"}), (BLOCK_TAGS - {"body", "html", "head"}, {"p"}))
SCOPE_TAGS = {"ul", "ol", "dl", "table", "div", "section", "article", "main", "body", "aside", "nav", "footer", "header",
              "blockquote", "select", "form", "td", "th"}
# -----------------------------------------------------------------------------

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
                     r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
                     r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|\b(hidden)\b", re.S)
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_ENDS = {tag: ended for tags, ended in reversed(IMPLIED_ENDS) for tag in tags}
_ENDS |= {tag: _ENDS.get(tag, set()) | {"p"} for tag in ("li", "dt", "dd", "tr", "td", "th")}


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


class Element:
    """``factor``: what the markup leaves of its importance; ``main``: it is within
    an article; ``plain``: it is the article's own text; ``up``: its parent."""
    __slots__ = ("tag", "path", "factor", "main", "plain", "up", "children")

    def __init__(self, tag, path, factor, main, plain, up):
        self.tag, self.path, self.factor, self.main, self.plain, self.up = tag, path, factor, main, plain, up
        self.children: list[str] = []


class Block:
    """Text between block boundaries: its element, and how much of it is links."""
    __slots__ = ("element", "text", "linked")

    def __init__(self, element, text, linked):
        self.element, self.text, self.linked = element, text, linked


def _element(tag: str, attrs: str, parent: Element) -> Element:
    names, role, marked = "", "", False
    if attrs.strip(" /"):
        for m in _ATTR.finditer(attrs):
            name, value = (m[1] or m[5]).lower(), m[2] or m[3] or m[4] or ""
            if name in ("class", "id"):
                names += " " + value
            elif name == "role":
                role = value.lower()
            elif name == "hidden" or name == "aria-hidden" and value == "true":
                marked = True
    main = parent.main or tag in ("article", "main") or role == "main"
    # an article's own header holds its title
    marked = marked or tag in NOISE_TAGS or role in NOISE_ROLES or tag == "header" and not parent.main
    factor = TAG_FACTOR if marked else 1.0
    if names and tag not in ("html", "body", "main"):
        words = set(re.split(r"[\s_\-:]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", names).lower()))
        if words & (NOISE_WORDS if parent.main or tag != "article" else ARTICLE_WORDS):
            factor *= WORD_FACTOR
        elif words & DOUBTFUL_WORDS and tag != "article":
            factor *= DOUBTFUL_FACTOR if parent.main else WORD_FACTOR
    step = tag + ("." + ".".join(sorted(names.split())) if names else "")
    plain = parent.plain and not names and tag in CONTENT_TAGS if parent.main else not names and tag in ("article", "main")
    return Element(tag, f"{parent.path}/{step}", factor, main, plain and factor == 1, parent)


def blocks(page: str) -> tuple[list[Block], list[Element]]:
    """The page's text blocks and block elements, in order."""
    root = Element("", "", 1.0, False, False, None)
    stack, found, elements = [root], [], []
    buf: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if buf:
            text = " ".join(html.unescape("".join(buf)).split())
            if text:
                holder = next(e for e in reversed(stack) if e.tag in BLOCK_TAGS or e is root)
                found.append(Block(holder, text, linked))
            buf.clear()
            linked = 0

    def text(s: str):
        nonlocal linked
        buf.append(s)
        if links:
            linked += len(s.strip())

    def close(to: int):
        nonlocal links
        for e in stack[to:]:
            links -= e.tag == "a"
        del stack[to:]

    at = 0
    while m := _MARKUP.search(page, at):
        if m.start() > at:
            text(page[at:m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1] or m[4]:                                # an end tag
            if tag in BLOCK_TAGS:
                flush()
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in SCOPE_TAGS and tag not in BLOCK_TAGS:
                    break
            continue
        if tag in RAW_TAGS:                             # its text is not markup
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            buf.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            ends = _ENDS.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                    break
                if stack[i].tag in SCOPE_TAGS:
                    break
        if tag in VOID_TAGS:
            continue
        e = _element(tag, m[3] or m[6] or "", stack[-1])
        if tag in BLOCK_TAGS:
            holder = next(x for x in reversed(stack) if x.tag in BLOCK_TAGS or x is root)
            holder.children.append(e.path.rpartition("/")[2])
            elements.append(e)
        stack.append(e)
        links += tag == "a"
    if at < len(page):
        text(page[at:])
    flush()
    return found, elements


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)


@lru_cache(maxsize=200_000)
def _path_hash(host: str, path: str) -> int:
    return _hash(host, path)


@lru_cache(maxsize=50_000)
def _above(host: str, path: str) -> tuple[int, ...]:
    steps = path.split("/")
    return tuple(_path_hash(host, "/".join(steps[:i])) for i in range(2, len(steps)))


def _judged(e: Element) -> bool:
    """Every block element but those that hold the whole page."""
    return e.tag not in ("html", "body", "") and e.tag in BLOCK_TAGS


def _in_doubt(e: Element) -> bool:
    """Whether the tree can change what becomes of the element: not where markup
    alone removes it or what it stands in, nor where the floor keeps it."""
    if not _judged(e) or importance_of(e, 0.0) >= MIN_IMPORTANCE:
        return False
    while e is not None:
        if importance_of(e, 1.0) < MIN_IMPORTANCE:
            return False
        e = e.up
    return True


def importance_of(e: Element, tree: float) -> float:
    """The element's importance by the tree and by its markup."""
    return e.factor * (max(tree, ARTICLE_FLOOR) if e.plain else tree)


_CONTENT, _STYLE, _SHOWN, _PLACE = range(4)
_NODE_DDL = "path long, kind int, feature long, page long, above array<long>, depth int"
_NODE = pa.schema([("path", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("page", pa.int64()),
                   ("above", pa.list_(pa.int64())), ("depth", pa.int32())])


def _nodes(batches):
    """Rows of the style tree: what a page shows of a node (a content, a
    presentation, itself), and once per batch a node's place in the tree."""
    for b in batches:
        rows, places = set(), {}
        for url, page in zip(b.column(0).to_pylist(), b.column(1)):
            host = host_of(url)
            if not host:
                continue
            found, elements = blocks(page.as_py())
            signature = _hash(*(x.text for x in found))
            for x in found:
                if _judged(x.element):
                    rows.add((_path_hash(host, x.element.path), _CONTENT, _hash(x.text), signature, None, None))
            for e in elements:
                if _judged(e):
                    path = _path_hash(host, e.path)
                    style = [c for c, before in zip(e.children, [None, *e.children]) if c != before]
                    rows.add((path, _STYLE, _hash(*style), signature, None, None))
                    rows.add((path, _SHOWN, 0, signature, None, None))
                    places[path] = _above(host, e.path), e.path.count("/") + 1
        rows = [*rows, *((p, _PLACE, 0, 0, above, depth) for p, (above, depth) in places.items())]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), _NODE)], schema=_NODE)


def importance(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """path, pages, importance: the combined importance of each node of each
    host's style tree (``path`` identifies host and path)."""
    src = pages.select(F.col(url).alias("url"), F.coalesce(F.col(page), F.lit("")).alias("html"))
    rows = map_arrow(src, _nodes, _NODE_DDL).distinct()
    # c: the distinct pages that show a feature; sums over a node's features are
    # all that its entropies need
    seen = rows.groupBy("path", "kind", "feature").agg(F.count(F.lit(1)).cast("double").alias("c"),
                                                       F.first("above").alias("above"), F.first("depth").alias("depth"))
    of = lambda kind, value: F.when(F.col("kind") == kind, value)
    c, log_c = F.col("c"), F.log(F.col("c"))
    sums = seen.groupBy("path").agg(
        F.max(of(_SHOWN, c)).alias("m"), F.avg(of(_CONTENT, log_c)).alias("log_c"), F.sum(of(_STYLE, c)).alias("styles"),
        F.sum(of(_STYLE, c * log_c)).alias("c_log_c"), F.max("above").alias("above"), F.max("depth").alias("depth"))
    log_m = F.log(F.col("m"))
    own = materialize(sums.filter("m > 1").select(
        "path", "m", "above", "depth",
        # contents: 1 - mean entropy; presentations: entropy of the choice of style
        (1 - F.col("log_c") / log_m).alias("content"),
        ((F.col("styles") * log_m - F.col("c_log_c")) / (F.col("m") * log_m)).alias("style")), "style-tree")
    # what hangs below a node passes its content importance up, less by DECAY a level
    below = (own.filter("content is not null").select(F.explode(F.concat("above", F.array("path"))).alias("path"),
                                                      F.col("content").alias("under"), F.col("m").alias("weight"),
                                                      F.col("depth").alias("leaf_depth")))
    merged = (below.join(own.select("path", "m", "depth", "style"), "path")
              .groupBy("path").agg(F.first("m").alias("pages"), F.first("style").alias("style"),
                                   (F.sum(F.col("under") * F.col("weight")) / F.sum("weight")).alias("under"),
                                   F.max(F.col("leaf_depth") - F.col("depth")).alias("levels")))
    keep = F.pow(F.lit(DECAY), F.col("levels"))
    return merged.select("path", "pages", ((1 - keep) * F.coalesce("style", F.lit(0.0)) + keep * F.col("under"))
                         .alias("importance"))


def _page_paths(batches):
    for b in batches:
        rows = set()
        for i, url, page in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            host = host_of(url)
            if host:
                rows.update((i, _path_hash(host, e.path)) for e in blocks(page.as_py())[1] if _in_doubt(e))
        if rows:
            ids, paths = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema.field(0).type), pa.array(paths)],
                                             names=["page_id", "path"])


def main_text(page: str, host: str = "", tree: dict[int, float] | None = None) -> str:
    """The article of a page; ``tree`` holds the importance of its host's nodes by
    the style tree, 1 where it says nothing."""
    found, _ = blocks(page)
    tree = tree or {}
    known: dict[int, bool] = {}

    def stays(e: Element | None) -> bool:
        if e is None:
            return True
        if id(e) not in known:
            value = tree.get(_path_hash(host, e.path), 1.0) if tree and _judged(e) else 1.0
            known[id(e)] = importance_of(e, value) >= MIN_IMPORTANCE and stays(e.up)
        return known[id(e)]

    left = [x for x in found if stays(x.element)]
    inside = [x for x in left if x.element.main]
    # blocks that are nothing but links are menus
    outside = [x for x in left if not x.element.main and x.linked < 0.8 * len(x.text)]
    # an article is the main text unless it is the smaller part, as a teaser is
    if sum(len(x.text) for x in inside) < sum(len(x.text) for x in outside):
        inside = [x for x in left if x.element.main or x.linked < 0.8 * len(x.text)]
    return "\n".join(x.text for x in inside)


def _extract(batches):
    for b in batches:
        texts = [main_text(p.as_py(), host_of(u), {x["path"]: x["importance"] for x in t or ()})
                 for u, p, t in zip(b.column("url").to_pylist(), b.column("html"), b.column("tree").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, one row per row.

    A null or empty page has an empty text; a very long one is parsed whole.  A null url, or one without a host,
    belongs to no style tree; its page is cleaned by its own markup alone.
    Null and repeated ids pass through (copies of a page count once in the
    tree); an empty table stays empty; other columns are ignored.
    """
    id_type = pages.schema[page_id].dataType.simpleString()
    src = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                       F.coalesce(F.col(page), F.lit("")).alias("html"))
    nodes = importance(src)
    shrunk = (F.col("importance") * F.col("pages") + PRIOR_PAGES) / (F.col("pages") + PRIOR_PAGES)
    # a node of more importance stays whatever doubt its markup casts on it
    low = materialize(nodes.select("path", shrunk.alias("importance"))
                      .filter(F.col("importance") * DOUBTFUL_FACTOR < MIN_IMPORTANCE), "style-low")
    if low.isEmpty():
        judged = src.withColumn("tree", F.lit(None).cast("array<struct<path:bigint,importance:double>>"))
    else:
        per_page = materialize(
            map_arrow(src, _page_paths, f"page_id {id_type}, path long").distinct().join(low, "path")
            .groupBy(F.col("page_id").alias("id")).agg(F.collect_list(F.struct("path", "importance")).alias("tree")),
            "style-judged")
        judged = src.join(per_page, F.col("page_id").eqNullSafe(F.col("id")), "left").drop("id")
    return map_arrow(judged.select("page_id", "url", "html", "tree"), _extract,
                     f"page_id {id_type}, url string, text string, n_chars long")
