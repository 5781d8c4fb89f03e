"""Main text of web pages with a style tree per site.

A page is parsed into a tree of elements. Pages of one host are merged: elements with the same path of tags and classes
are one node of the site's style tree, with the different sequences of children (its presentations) and the
different texts (its contents) seen on the site's pages. The entropy of either, over the logarithm of the number of pages, is the node's
importance: near 0 for what every page repeats, near 1 for what differs from page to page. A page's branch has the
composite importance of its own presentation and of its children's.

What the markup itself names as something else than the article (menus, headers, footers, sidebars, notices,
adverts, forms, comments) has no importance, whatever its entropy: such parts often change with every page. A class or id
alone does not remove the only article of a page or most of its text (``no-sidebar``), and inside an article only a whole class
name counts (``comments``, not ``search-theory``): there entropy decides.

Entropies are taken as if one more page had been seen that differs from all. So one page is evidence of nothing, and the more
pages repeat a node the less it is worth; there is no least number of pages.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikeflow.llm.common import map_batches
from bikeflow.plans.runtime import scratch

GAMMA = 0.9         # how much of an element's importance comes from its children
LOW = 0.3           # branches of less importance go

# Elements and words of markup by what they hold.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
OTHER = frozenset("nav footer aside form dialog menu button head header label input fieldset".split())
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices alert nav navbar navigation menu breadcrumb breadcrumbs sidebar aside footer header masthead comment comments "
    "reply replies respond disqus share sharing social related recommended newsletter subscribe subscription signup login "
    "search popup modal overlay toolbar pagination pager widget widgets copyright skip form".split()
)
HEADING_WORDS = frozenset(["header", "masthead"])
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus".split())  # can outgrow the article
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
OTHER_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar".split())
CLOSES = {  # an opening tag ends these open elements
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": (), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"), "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",)}

TAG = re.compile(
    r"""<!--(?:.*?-->|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?""", re.S
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
WORD = re.compile(r"[a-z0-9]+")


class Node:
    """An element: its style, children in order (nodes and texts) and what its markup says of it.

    ``named`` has the words for which it is ``other`` if only its class and id say so.
    """

    __slots__ = ("tag", "style", "path", "children", "other", "main", "named")

    def __init__(self, tag: str, style: str, path: int, other: bool, main: bool, named: frozenset = frozenset()) -> None:
        self.tag, self.style, self.path, self.other, self.main, self.named = tag, style, path, other, main, named
        self.children: list[Node | str] = []


def _node(tag: str, raw: str, parent: Node | None, in_article: bool) -> Node:
    words: list[str] = []
    names: list[str] = []
    role, hidden = "", False
    if raw:
        for name, *values in ATTRIBUTE.findall(raw):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("class", "id"):
                words += WORD.findall(value.lower())
                names += value.lower().split()
            elif name == "role":
                role = value.lower().strip()
            elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
                hidden = True
            elif name == "style" and "display:none" in value.lower().replace(" ", ""):
                hidden = True
    named = OTHER_WORDS.intersection(words)
    if in_article:  # it may have a heading of its own, and any word as part of a name
        named = OTHER_WORDS.intersection(names) - HEADING_WORDS
    plainly = hidden or role in OTHER_ROLES or (tag in OTHER and not (tag == "header" and in_article))
    other = plainly or bool(named)
    main = tag in ("article", "main") or role == "main" or "articlebody" in words
    if tag in ("body", "html"):
        other = False
    style = f"{tag}.{'.'.join(w for w in words if not w.isdigit())}"
    path = xxhash.xxh3_64_intdigest(style, seed=parent.path & 0xFFFFFFFF if parent else 0) >> 1
    return Node(tag, style, path, other, main, frozenset() if plainly else named)


def parse(page: str) -> Node:
    """The tree of a page. Unclosed and stray tags are mended as far as blocks are concerned."""
    root = Node("html", "html", 0, False, False)
    stack, articles = [root], 0
    open_tags: Counter[str] = Counter()  # tells at once that a tag to be closed is not open

    def close(i: int) -> None:
        nonlocal articles
        for n in stack[i:]:
            articles -= n.main
            open_tags[n.tag] -= 1
        del stack[i:]

    at, size = 0, len(page)
    while at < size:
        found = TAG.search(page, at)
        if not found:
            break
        if found.start() > at:
            stack[-1].children.append(html.unescape(page[at : found.start()]))
        at = found.end()
        tag = (found.group(2) or found.group(5) or "").lower()
        if not tag:
            continue
        if found.group(1) or found.group(4):
            for i in range(len(stack) - 1, 0, -1) if open_tags[tag] else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in ("article", "main", "table") and tag not in BLOCK:
                    break
            continue
        if tag in ("html", "body") and (tag == "html" or open_tags["body"]):
            continue
        ends = CLOSES.get(tag, ())
        if tag in BLOCK and tag not in ("body", "html"):
            ends = (*ends, "p")
        if any(open_tags[t] for t in ends):
            stops = SCOPES.get(tag, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in ends:
                    close(i)
                elif stack[i].tag in stops or (stack[i].tag in BLOCK and "p" in ends and not stops):
                    break
        if tag == "body":
            close(1)
        node = _node(tag, found.group(3) or found.group(6) or "", stack[-1], articles > 0)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        stack[-1].children.append(node)
        if tag not in VOID and not (found.group(3) or "").endswith("/"):
            stack.append(node)
            articles += node.main
            open_tags[tag] += 1
    if at < size:
        stack[-1].children.append(html.unescape(page[at:]))
    _spare(root)
    return root


def _spare(root: Node) -> None:
    """Clear ``other`` of elements for which only a class or id speaks, where they hold most of the page's text or its only articles."""
    order, todo = [], [root]
    while todo:  # all that is not plainly another part, parents first
        n = todo.pop()
        order.append(n)
        todo.extend(c for c in n.children if isinstance(c, Node) and (c.named or not c.other))
    doubtful = [n for n in order if n.other]
    if not doubtful:
        return
    size: dict[int, int] = {}
    holds: dict[int, bool] = {}
    for n in reversed(order):
        inner = [c for c in n.children if isinstance(c, Node) and id(c) in size]
        size[id(n)] = sum(len("".join(c.split())) for c in n.children if isinstance(c, str)) + sum(size[id(c)] for c in inner)
        holds[id(n)] = any(holds[id(c)] or (c.main and not c.other) for c in inner)
    for n in doubtful:
        if 2 * size[id(n)] > size[id(root)] and not n.named & COMMENT_WORDS:
            n.other = False
    if not articles(root):
        for n in doubtful:
            if holds[id(n)]:
                n.other = False


def blocks(node: Node, keep: set[int] | None = None) -> list[str]:
    """The texts of the blocks below ``node`` in order, without other parts; ``keep`` holds ids of nodes to pass through."""
    out: list[list[str]] = [[]]

    def walk(n: Node) -> None:
        todo: list = [iter(n.children)]
        open_nodes = [n]
        while todo:
            child = next(todo[-1], None)
            if child is None:
                todo.pop()
                if open_nodes.pop().tag in BLOCK:
                    out.append([])
            elif isinstance(child, str):
                out[-1].append(child)
            elif not child.other and (keep is None or id(child) in keep):
                if child.tag in BLOCK:
                    out.append([])
                elif child.tag in ("br", "wbr"):
                    out[-1].append(" " if child.tag == "br" else "")
                todo.append(iter(child.children))
                open_nodes.append(child)

    walk(node)
    joined = (" ".join("".join(parts).split()) for parts in out)
    return [b for b in joined if b]


def _elements(root: Node):
    """All nodes outside other parts, parents first."""
    todo = [root]
    while todo:
        n = todo.pop()
        yield n
        todo.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.other)


def articles(root: Node) -> list[Node]:
    """The outermost article elements, else the outermost main ones."""

    def outermost(test) -> list[Node]:
        found, todo = [], [root]
        while todo:
            n = todo.pop()
            if test(n):
                found.append(n)
            else:
                todo.extend(c for c in reversed(n.children) if isinstance(c, Node) and not c.other)
        return found

    return outermost(lambda n: n.tag == "article") or outermost(lambda n: n.main)


def observations(root: Node) -> dict[int, tuple[int, int]]:
    """Hash of the presentation and of the content by path, for each node of the page's style tree.

    Elements of one path on a page are one observation: their children's styles, and their own texts, together.
    """
    looks: dict[int, list[str]] = {}
    said: dict[int, list[str]] = {}
    for n in _elements(root):
        looks.setdefault(n.path, []).extend(c.style if isinstance(c, Node) else "#" for c in n.children)
        said.setdefault(n.path, []).extend(" ".join(c.split()) for c in n.children if isinstance(c, str))
    digest = xxhash.xxh3_64_intdigest
    return {p: (digest(" ".join(looks[p])) >> 1, digest("\x1f".join(said[p])) >> 1) for p in looks}


def page_text(root: Node, chosen: list[Node]) -> int:
    """A hash of the text in the articles, or of all text without one. Pages of a site with one text are copies."""
    return xxhash.xxh3_64_intdigest("\n".join(b for n in chosen or [root] for b in blocks(n))) >> 1


def main_text(page: str | None, importance: dict[int, tuple[float, float]] | None = None) -> str:
    """The main text of a page; ``importance`` has presentation and content importance of its site's nodes by path (1 if absent)."""
    if not page:
        return ""
    root = parse(page)
    chosen = articles(root)
    if chosen and not importance:
        return "\n".join(b for n in chosen for b in blocks(n))
    known = importance or {}
    order = list(_elements(root))
    worth: dict[int, float] = {}
    for n in reversed(order):
        look, content = known.get(n.path, (1.0, 1.0))
        inner = [worth[id(c)] for c in n.children if isinstance(c, Node) and id(c) in worth and c.tag not in VOID]
        own = content if any(isinstance(c, str) and c.strip() for c in n.children) else None
        parts = inner + ([own] if own is not None else [])
        share = GAMMA ** len(inner)
        worth[id(n)] = (1 - share) * look + share * (sum(parts) / len(parts)) if parts and inner else (own if own is not None else look)
        if inner:  # a branch is worth at least its best part: what is low in it goes by itself
            worth[id(n)] = max(worth[id(n)], max(parts))
    if not chosen:
        return "\n".join(blocks(root, {id(n) for n in order if worth[id(n)] >= LOW or n.tag in VOID}))
    # In an article whole blocks go, never a word out of a sentence, and no heading: articles of a kind share theirs.
    keep = {id(n) for n in order if worth[id(n)] >= LOW or n.tag not in BLOCK or n.tag in HEADINGS}
    return "\n".join(b for n in chosen for b in blocks(n, keep)) or "\n".join(b for n in chosen for b in blocks(n))


def host_of(url: Column) -> Column:
    """The host of an address in lower case; empty without one."""
    address = F.coalesce(url.cast("string"), F.lit(""))
    return F.lower(F.regexp_extract(address, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def site_trees(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``host``, ``nodes``: for each site the nodes of low importance, as (path, presentation, content).

    Of pages with one text a site's tree has one, so copies of an article do not make it a template. Observations are counted
    per value before entropies are taken, so a site with a third of all pages costs no task more than its number of different values.
    """

    def observe(batches):
        for b in batches:
            out = {c: [] for c in ("host", "said", "path", "look", "content")}
            for host, page in zip(b["host"], b["html"], strict=True):
                if page:
                    root = parse(page)
                    seen = observations(root)
                    out["host"].append(host)
                    out["said"].append(page_text(root, articles(root)))
                    out["path"].append(list(seen))
                    out["look"].append([look for look, _ in seen.values()])
                    out["content"].append([content for _, content in seen.values()])
            yield out

    picked = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))
    schema = "host string, said bigint, path array<bigint>, look array<bigint>, content array<bigint>"
    one = map_batches(picked, observe, schema).groupBy("host", "said").agg(F.min(F.struct("path", "look", "content")).alias("t"))
    nodes = one.select("host", F.explode(F.arrays_zip("t.path", "t.look", "t.content")).alias("o")).select("host", "o.*")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("value")) for k, c in ((0, "look"), (1, "content"))])
    values = nodes.select("host", "path", F.inline(kinds)).groupBy("host", "path", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
    m = F.sum("n") + 1  # the one more page adds 1 * log2(1)
    entropy = F.log2(m) - F.sum(F.col("n") * F.log2("n")) / m
    nodes = values.groupBy("host", "path", "kind").agg((entropy / F.log2(m)).alias("importance"))
    low = nodes.groupBy("host", "path").agg(
        F.min(F.when(F.col("kind") == 0, F.col("importance"))).alias("look"),
        F.min(F.when(F.col("kind") == 1, F.col("importance"))).alias("content"),
    ).filter((F.col("content") < LOW) | (F.col("look") < LOW))
    return low.groupBy("host").agg(F.collect_list(F.struct("path", "look", "content")).alias("nodes"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars``: the main text of every page, a row per input row.

    Blocks are joined by a line feed, white space in a block is one space, character references are decoded. A null or
    empty page has an empty text. A page without a readable address belongs to the site "". Rows that repeat an id or a whole page are
    extracted each by itself. All different pages of a site are counted. In an article, blocks of low importance go, headings never.
    """
    spark = pages.sparkSession
    trees = scratch(spark, "site-trees")
    site_trees(pages, url_col, html_col).write.parquet(trees)
    # Read back, the size of the trees is known: Spark sends them to all tasks if small and shuffles otherwise.
    trees = spark.read.parquet(trees).withColumnRenamed("host", "_host")
    picked = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(F.col(url_col)).alias("host"),
    )
    joined = picked.join(trees, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "nodes")

    def work(batches):
        for b in batches:
            out = []
            for page, nodes in zip(b["html"], b["nodes"], strict=True):
                known = {
                    n["path"]: (1.0 if n["look"] is None else n["look"], 1.0 if n["content"] is None else n["content"])
                    for n in nodes or []
                }
                out.append(main_text(page, known))
            yield {"page_id": b["page_id"], "url": b["url"], "text": out, "n_chars": [len(t) for t in out]}

    kind = dict(pages.dtypes)[id_col]
    return map_batches(joined, work, f"page_id {kind}, url string, text string, n_chars bigint")
