"""Main text of web pages by site style trees.

Each page is parsed once into its blocks of text and the elements around them.  The elements of all pages of a host are
merged into a style tree whose nodes are element paths (tag, id and classes from the root).  A node's importance combines
the entropy of its presentation (how its sequence of child tags varies over the host's pages) and of its content (a text
that returns on every page carries nothing).  A branch of low importance is removed from those pages on which its content is
one that returns on at least RETURNS of the host's pages; a page's own content under the same path stays.

Tags, roles and names that speak of menus, headers, footers, sidebars, notices, adverts, forms or reader comments are a
prior: it counts as PRIOR_PAGES pages without importance, so what the host's pages show overrules it, and it decides alone
only for nodes of fewer than MIN_PAGES pages.  It never holds for text-level elements, article, main, what is around an
article or main with most of the page's words, or (names and roles) what holds nearly all of the words.  Scripts, styles and hidden
elements are no text of the page and always go.

If main, or else the articles, hold at least half of the words that are left, the text is taken from there, with the
first-level headings outside; otherwise all that is left is the text.

Pages with the same main text (the largest blocks that hold NEARLY_ALL of the words) count once, a node needs MIN_PAGES different pages to be judged, and text-level elements (paragraphs,
headings, list items) are never judged, so a sentence that many articles share stays.  The counting is over
(host, path, value) with partial sums, so a host with a third of all pages is no hot key.

Defined results: null or empty html gives the empty text; elements nested deeper than DEPTH hide and close as others do, but are
judged by their tag, role and names alone, so that time follows the length of a page; unclosed elements, comments and scripts reach to the end of the
page; br and other inline elements are white space at most; rows with the same page_id are separate pages.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

MIN_PAGES = 8
#: Open elements beyond which further ones are no nodes of the style tree: they hide, are boilerplate or main as any others.
DEPTH = 128
#: Weight of the content in a node's importance, and the importance below which a branch goes.
CONTENT, LOW = 0.9, 0.2
#: Pages without importance that a tag, role or name of boilerplate is worth.
PRIOR_PAGES = 8
#: Share of a host's pages on which a content of low importance returns if it is to be removed.
RETURNS = 0.1
#: Share of a page's words above which main or articles are its text, and above which an element is as good as the page.
MOST, NEARLY_ALL = 0.5, 0.8

# fixed values: names of HTML elements
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "object", "svg", "math", "canvas", "audio", "video"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
TEXT_LEVEL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "pre", "blockquote", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "figcaption", "summary", "hr"}
NEVER_MAIN = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "option", "fieldset"}
CLOSED_BY_BLOCK = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
CLOSED_BY_SELF = {"li", "dt", "dd", "tr", "td", "th", "option"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices",
    "pagination", "popup", "promo", "promotion", "recommended", "related", "respond", "search", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe", "toolbar", "widget",
}

PARTS = {"area", "bar", "block", "body", "bottom", "box", "column", "container", "content", "inner", "item", "items", "left", "links", "list", "outer", "panel", "right", "row", "section", "top", "wrap", "wrapper"}

_TOKEN = re.compile(r"<!--|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_UNFINISHED = re.compile(r"</?[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PART = re.compile(r"[a-z]+")
#: Letters of scripts that put no spaces between words: each counts as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")

PARSED_SCHEMA = "page_id long, url string, host string, page long, whole long, blocks array<struct<text: string, words: long, contents: array<long>, named: array<long>, article: boolean, main: boolean, title: boolean>>, nodes array<struct<path: long, style: long, content: long, named: boolean>>"


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text) - (1 << 63)


def host_of(url: str | None) -> str:
    return re.split(r"[/?#:]", re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or ""), maxsplit=1)[0].lower()


class _Node:
    __slots__ = ("tag", "path", "key", "above", "gone", "named", "article", "main", "judged", "content", "words", "main_words", "holds_main", "kids", "text")

    def __init__(self, tag: str, above: "_Node | None", name: str | None, gone: bool, named: bool):
        """Without a name, an element beyond DEPTH: it has no path, and its name alone says whether it is boilerplate."""
        self.tag, self.above, self.kids, self.text = tag, above, [], []
        gone = gone or (name is None and named)
        self.path = "" if name is None else f"{above.path}/{name}" if above else name
        self.gone = gone or (above is not None and above.gone)
        self.named = named
        self.article = tag == "article" or (above is not None and above.article)
        self.main = tag == "main" or (above is not None and above.main)
        self.judged = above is not None and name is not None and tag not in INLINE and tag not in TEXT_LEVEL and tag not in ("html", "body", "article", "main")
        self.key = _hash(self.path) if self.judged else 0
        self.words = self.main_words = self.content = 0
        self.holds_main = False


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(raw)}


def _is_hidden(tag: str, at: dict[str, str]) -> bool:
    return tag == "head" or "hidden" in at or at.get("aria-hidden") == "true" or bool(_HIDDEN.search(at.get("style", "")))


def _is_named(tag: str, at: dict[str, str], above: _Node) -> bool:
    if tag in TEXT_LEVEL or tag in INLINE or tag in ("html", "body", "article", "main"):
        return False
    if tag in NEVER_MAIN or (tag == "header" and not above.article) or at.get("role") in ROLES:
        return True
    return bool(at) and any(map(_speaks, f"{at.get('class', '')} {at.get('id', '')}".split()))


def _speaks(name: str) -> bool:
    """Does a class or id name boilerplate: as a whole, by its last word (site-footer), or by its first before a word for a part
    (nav-list)?  What it has, lacks or is about (has-sidebar, ad-free, related-research) says nothing."""
    words = _PART.findall(name)
    if not words or words[0] in ("has", "no", "with", "without"):
        return False
    return words[-1] in NAMES or (words[0] in NAMES and words[-1] in PARTS)


def _words(text: str) -> int:
    return len(text.split()) + (0 if text.isascii() else len(_UNSPACED.findall(text)))


def parse(page: str) -> tuple[list[dict], list[dict]]:
    """(blocks: text, words, hashes of the paths and contents of the judged elements around it, paths of those with a prior, in an article, in main, a first-level
    heading; nodes: path, style, content, whether with a prior)."""
    root = _Node("", None, "", False, False)
    stack, blocks, nodes, line = [root], [], [], []
    open_: dict[str, int] = {}  # open elements by tag, so that what closes nothing is not looked for

    def push(node: _Node) -> None:
        stack.append(node)
        open_[node.tag] = open_.get(node.tag, 0) + 1

    def pop() -> _Node:
        node = stack.pop()
        open_[node.tag] -= 1
        return node

    def end_block() -> None:
        text = " ".join(html.unescape("".join(line)).split())
        line.clear()
        if text:
            top, tree = stack[-1], stack[: DEPTH + 1]
            for node in tree:
                if node.path and node.tag not in INLINE:
                    node.text.append(text)
            if not top.gone:
                words = _words(text)
                for node in tree:
                    node.words += words
                    node.main_words += words if top.article or top.main else 0
                blocks.append((text, words, [n for n in tree if n.judged], top.article, top.main, open_.get("h1", 0) > 0))

    def close(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1].tag not in INLINE:
                end_block()
            node = pop()
            if node.path and node.tag not in INLINE and node.tag not in TEXT_LEVEL:
                node.content = _hash("\n".join((node.path, *node.text)))
                nodes.append((node, _hash(" ".join(node.kids))))

    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            line.append(_UNFINISHED.split(page[at:], maxsplit=1)[0])
            break
        line.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            if m[0] == "<!--":
                at = page.find("-->", at)
                at = n if at < 0 else at + 3
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1) if open_.get(tag) else ():
                if stack[i].tag == tag:
                    close(i)
                    break
                if tag in INLINE and stack[i].tag not in INLINE:
                    break
            if tag not in INLINE:
                end_block()
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else n
            continue
        if tag == "br":
            line.append(" ")
        if tag in VOID:
            if tag not in INLINE:
                end_block()
            continue
        if tag not in INLINE:
            end_block()
            if tag in CLOSED_BY_SELF or tag not in INLINE:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag in CLOSED_BY_BLOCK or (tag in CLOSED_BY_SELF and stack[i].tag == tag):
                        close(i)
                        break
                    if stack[i].tag not in INLINE:
                        break
        above = stack[-1]
        at_ = _attributes(m[3]) if m[3].strip() else {}
        name = None if len(stack) > DEPTH else tag + (f"#{at_['id']}" if at_.get("id") else "") + "".join(f".{c}" for c in sorted(at_.get("class", "").split()))
        node = _Node(tag, above, name, _is_hidden(tag, at_), _is_named(tag, at_, above))
        if tag not in INLINE:
            above.kids.append(tag)
        if tag in ("article", "main"):
            for around in stack[: DEPTH + 1]:
                around.holds_main = True
        push(node)
        if m[3].endswith("/") and tag in INLINE:
            pop()
    end_block()
    close(1)
    for node, _ in nodes:
        own = node.main_words if node.holds_main else 0
        whole = node.words >= NEARLY_ALL * root.words and node.tag not in NEVER_MAIN
        node.named = node.named and not (root.words and (own > MOST * root.words or whole))
    return (
        [{"text": t, "words": w, "contents": [n.content for n in around], "named": [n.key for n in around if n.named], "article": a, "main": m, "title": h} for t, w, around, a, m, h in blocks],
        [{"path": n.key if n.judged else _hash(n.path), "style": s, "content": n.content, "named": n.named} for n, s in nodes],
    )


def main_text(blocks: list[dict]) -> int:
    """A hash of the largest blocks, in the order of the page, that hold NEARLY_ALL of its words: what copies that differ in a
    counter or a date have in common."""
    want, held = NEARLY_ALL * sum(b["words"] for b in blocks), []
    for i in sorted(range(len(blocks)), key=lambda i: (-blocks[i]["words"], i)):
        if want <= 0:
            break
        held.append(i)
        want -= blocks[i]["words"]
    return _hash("\n".join(blocks[i]["text"] for i in sorted(held)))


def parsed(pages: DataFrame) -> DataFrame:
    """PARSED_SCHEMA: each page with its blocks and elements."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for page_id, url, text in zip(f["page_id"].astype("Int64"), f["url"], f["html"]):
                blocks, nodes = parse(text or "")
                rows.append((page_id, url, host_of(url), main_text(blocks), _hash("\n".join(b["text"] for b in blocks)), blocks, nodes))
            out = pd.DataFrame(rows, columns=["page_id", "url", "host", "page", "whole", "blocks", "nodes"])
            out["page_id"] = out["page_id"].astype("Int64")
            yield out

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInPandas(run, PARSED_SCHEMA)


def contents(pages: DataFrame) -> DataFrame:
    """host, path, kind, value, c, named: on how many pages with different main texts an element has a style or content.  Of
    the pages with one main text, one stands for all."""
    seen = pages.select("host", "page", "whole", F.explode("nodes").alias("n")).select("host", "page", "whole", "n.*").distinct()
    stands = pages.groupBy("host", "page").agg(F.min("whole").alias("whole"))
    one = seen.join(stands, ["host", "page", "whole"])
    both = one.select("host", "path", "named", F.explode(F.array(F.struct(F.lit("style").alias("kind"), F.col("style").alias("value")), F.struct(F.lit("content").alias("kind"), F.col("content").alias("value")))).alias("v")).select("host", "path", "named", "v.kind", "v.value")
    return both.groupBy("host", "path", "kind", "value").agg(F.count("*").alias("c"), F.max("named").alias("named"))


def style_tree(counts: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """host, path, pages, named, presentation, content, importance of the nodes of contents() seen on at least min_pages different pages."""
    m = F.sum("c")
    # c * log(c) sums give both entropies: log(m) - sum(c log c) / m, divided by log(m)
    learned = (1 - CONTENT) * F.col("presentation") + CONTENT * F.col("content")
    return (
        counts.groupBy("host", "path", "kind").agg(m.alias("m"), F.sum(F.col("c") * F.log("c")).alias("l"), F.max("named").alias("named"))
        .where(F.col("m") >= min_pages)
        .withColumn("entropy", 1 - F.col("l") / (F.col("m") * F.log("m")))
        .groupBy("host", "path").agg(F.max("m").alias("pages"), F.max("named").alias("named"), F.max(F.when(F.col("kind") == "style", F.col("entropy"))).alias("presentation"), F.max(F.when(F.col("kind") == "content", F.col("entropy"))).alias("content"))
        .withColumn("importance", learned * F.when(F.col("named"), F.col("pages") / (F.col("pages") + PRIOR_PAGES)).otherwise(1.0))
    )


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, low: float = LOW) -> DataFrame:
    """page_id, url, text, n_chars of every page of pages(page_id, url, html)."""
    ready = written(parsed(pages), "html-parsed")
    counts = written(contents(ready), "html-contents")
    tree = written(style_tree(counts, min_pages).where((F.col("importance") < low) | F.col("named")).select("host", "path", "named", (F.col("importance") < low).alias("is_low")), "html-tree")
    on_host = ready.groupBy("host", "page").agg(F.lit(1).alias("n")).groupBy("host").agg(F.count("*").alias("n"))
    # few: at most 1 / RETURNS contents of a path return so often
    often = counts.where((F.col("kind") == "content") & (F.col("c") > 1)).join(on_host, "host").where(F.col("c") >= RETURNS * F.col("n"))
    returns = often.join(tree.where("is_low"), ["host", "path"], "left_semi").select("host", "value", F.lit(None).cast("long").alias("kept"))
    overruled = tree.where("named AND NOT is_low").select("host", F.lit(None).cast("long").alias("value"), F.col("path").alias("kept"))
    cut = written(returns.unionByName(overruled).groupBy("host").agg(F.collect_set("value").alias("gone"), F.collect_set("kept").alias("kept")), "html-low")
    joined = ready.select("page_id", "url", "host", "blocks").join(cut, "host", "left")
    none = F.array().cast("array<long>")
    gone, kept = F.coalesce("gone", none), F.coalesce("kept", none)
    left = joined.select("page_id", "url", F.filter("blocks", lambda b: ~F.arrays_overlap(b["contents"], gone) & (F.size(F.array_except(b["named"], kept)) == 0)).alias("b"))
    words = lambda blocks: F.aggregate(blocks, F.lit(0).cast("long"), lambda n, b: n + b["words"])
    most = lambda name: (words(F.filter("b", lambda b: b[name])) >= MOST * words(F.col("b"))) & F.exists("b", lambda b: b[name])
    chosen = left.select("page_id", "url", "b", most("article").alias("by_article"), most("main").alias("by_main"))
    inside = F.filter("b", lambda b: F.when(F.col("by_main"), b["main"] | b["title"]).when(F.col("by_article"), b["article"] | b["title"]).otherwise(True))
    text = F.array_join(F.transform(inside, lambda b: b["text"]), "\n")
    return chosen.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
