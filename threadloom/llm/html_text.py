"""Main text of pages by removing each site's template.

Pages become trees by a small tolerant parser. Every element outside the article is hashed with its
tag, attributes, text and children. Spark counts for each host with how many different main texts a
subtree stands; copies of one page thus count once. Subtrees that stand beside at least `SHARE` of a
host's different texts, and beside `LEAST` of them, are the host's template and are deleted. What
never holds main text by its meaning (navigation, forms, scripts, adverts, comments and the like) is
deleted on every page, so that a host with few pages is extracted too.

Inside an article only containers that are not text blocks can be template, so a paragraph that many
pages quote stays, and no text block goes by its id or class. A container there goes by its id only if
all words of the id name such parts, as section ids are link targets. The article is the outermost
`article`; where `main` holds more text beside its articles than all articles have, `main` is the
article, without those that are named cards. If deletion leaves nothing of a page without an article, as on hosts whose pages
are all alike, the page is kept whole but for what is deleted by meaning.

Cases: null and empty html have empty text; null url is a host of its own; unclosed, misplaced and
unknown tags are accepted; pages of any length are read whole; repeated rows give repeated results;
an empty table gives no rows; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from threadloom.llm.common import stored

SHARE = 0.3
LEAST = 4
PAGE_SCHEMA = "page_id long, url string, text string, n_chars long"

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>",
    re.DOTALL)
ATTRIBUTE = re.compile(r"(?:^|\s)(class|id|role|aria-label|itemprop|hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?",
                       re.IGNORECASE)
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes"}
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*+>?", re.IGNORECASE) for t in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
        "source", "track", "wbr"}
BLOCKS = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details",
          "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
          "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li",
          "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table",
          "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
# Elements that hold no main text by their meaning.
NEVER = {"script", "style", "noscript", "template", "nav", "footer", "aside", "form", "head",
         "title", "button", "select", "option", "textarea", "input", "iframe", "object", "embed",
         "svg", "math", "canvas", "audio", "video", "map", "dialog", "menu", "search", "noembed",
         "noframes", "datalist", "label", "fieldset", "xmp", "frameset"}
NEVER_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
               "alert", "alertdialog", "menu", "menubar", "toolbar"}
# Words of class and id that name such parts.
NEVER_WORDS = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|"
    r"banners?|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|footers?|cookies?|consent|gdpr|"
    r"notices?|popups?|modals?|overlays?|newsletters?|subscribe|subscription|social|share|sharing|"
    r"related|recommended|recommendations|comments?|commentlist|disqus|replies|respond|widgets?|"
    r"masthead|site-header|topbar|toolbar|pagination|pager|skip|login|signup|search)(?=$|[^a-z])")
ARTICLE = {"article", "main"}
# Words that name an article which is a comment or an advert.
NEVER_ARTICLES = re.compile(
    r"(?:^|[^a-z])(?:ads?|adverts?|sponsored|promos?|comments?|reply|replies|related|teasers?)"
    r"(?=$|[^a-z])")
# Words that may stand beside those in the id of a container.
ID_WORDS = {"area", "block", "box", "container", "content", "form", "items", "links", "list", "main",
            "section", "site", "wrap", "wrapper", "bottom", "left", "right", "top", "articles", "posts"}
# Words that name an article which leads to another page.
CARDS = re.compile(r"(?:^|[^a-z])(?:cards?|tiles?|previews?)(?=$|[^a-z])")
# Text blocks of an article are never template, however often they are quoted.
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "li", "dd", "dt", "table",
         "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "figcaption", "ol", "ul", "dl",
         "b", "i", "em", "strong", "a", "span", "code", "sub", "sup", "br", "q", "cite"}
# Those of them that no id or class of theirs deletes.
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "dd", "dt", "dl", "table",
               "tr", "td", "th", "tbody", "thead", "tfoot", "caption", "figcaption", "code", "q",
               "cite", "b", "i", "em", "strong", "sub", "sup"}
# Elements without text of their own that deleting would not show, and the page as a whole.
PLAIN = VOID | {"html", "head", "body", "script", "style", "title"}
CLOSES_P = BLOCKS - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
# What an opening tag closes, up to the container that it cannot leave.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
LIMITS = {"article", "main", "aside", "section", "div", "td", "th", "table", "body", "html", "form",
          "li", "blockquote", "footer", "header", "nav", "button", "object"}


class Node:
    __slots__ = ("tag", "names", "never", "children", "code", "within")

    def __init__(self, tag: str, attributes: str = "", within: bool = False):
        self.tag, self.children, self.code = tag, [], 0
        self.names = ""
        self.within = within  # inside an article or main
        self.never = tag in NEVER
        if attributes and "=" in attributes or "hidden" in attributes:
            names = []
            for m in ATTRIBUTE.finditer(attributes):
                name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if name in ("class", "id"):
                    names.append(f"{name}={value}")
                    if self._named_never(name, value):
                        self.never = True
                elif name == "role" and value in NEVER_ROLES:
                    self.never = True
                elif name == "itemprop" and value == "comment":
                    self.never = True
                elif name == "hidden":
                    self.never = True
                elif name == "style" and re.search(r"display\s*:\s*none", value):
                    self.never = True
            self.names = " ".join(names)

    def _named_never(self, name: str, value: str) -> bool:
        if self.tag in ARTICLE:
            return bool(NEVER_ARTICLES.search(value))
        if self.tag in ("html", "body") or self.within and self.tag in TEXT_BLOCKS:
            return False
        if self.within and name == "id":
            words = [w for w in re.split(r"[^a-z]+", value) if w and w not in ID_WORDS]
            return bool(words) and all(NEVER_WORDS.search(w) for w in words)
        return bool(NEVER_WORDS.search(value))


def parse(source: str) -> Node:
    """A tree of nodes and decoded strings; tolerant of any input."""
    root = Node("#root")
    stack = [root]
    at, size = 0, len(source)
    while at < size:
        m = TAG.search(source, at)
        if m is None:
            _text(stack, source[at:])
            break
        if m.start() > at:
            _text(stack, source[at:m.start()])
        at = m.end()
        name = m[2] or m[5]
        if not name:
            if m[0].startswith("<![CDATA["):
                _text(stack, m[0][9:].removesuffix("]]>"))
            continue
        tag = name.lower()
        if m[1] or m[4]:
            _close(stack, tag)
            continue
        _make_room(stack, tag)
        over = stack[-1]
        node = Node(tag, m[3] or m[6] or "", over.within or over.tag in ARTICLE)
        stack[-1].children.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            end = RAW_END[tag].search(source, at)
            inside = source[at:end.start()] if end else source[at:]
            if tag in ("title", "textarea"):
                node.children.append(html.unescape(inside))
            at = end.end() if end else size
            continue
        stack.append(node)
    return root


def _text(stack: list[Node], raw: str) -> None:
    stack[-1].children.append(html.unescape(raw) if "&" in raw else raw)


def _close(stack: list[Node], tag: str) -> None:
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag == tag:
            del stack[i:]
            return
        if stack[i].tag in LIMITS and tag not in BLOCKS:
            return


def _make_room(stack: list[Node], tag: str) -> None:
    """Closes what an opening tag ends: a paragraph before a block, an item before the next."""
    if tag in CLOSES_P:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == "p":
                del stack[i:]
                break
            if stack[i].tag in LIMITS:
                break
    if tag in SIBLINGS:
        ends, walls = SIBLINGS[tag]
        last = 0
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in walls:
                break
            if stack[i].tag in ends:
                last = i
        if last:
            del stack[last:]


def _outermost(root: Node, wanted: str) -> list[Node]:
    """Outermost elements of a tag that no deleted element holds, in page order."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.tag == wanted and not node.never:
            found.append(node)
            continue
        waiting += [c for c in reversed(node.children) if isinstance(c, Node) and not c.never]
    return found


def _articles(root: Node) -> list[Node]:
    """The elements that hold the page's article; none if no tag tells."""
    articles, mains = _outermost(root, "article"), _outermost(root, "main")
    if not articles or not mains:
        return articles or mains
    held = [a for m in mains for a in _outermost(m, "article")]
    whole, inside, of_articles = (
        sum(map(len, blocks(nodes, frozenset(), True))) for nodes in (mains, held, articles))
    if whole - inside <= of_articles:
        return articles
    for article in articles:
        article.never = bool(CARDS.search(article.names))
    return mains


def blocks(nodes: list[Node], template: frozenset[int] | set[int], article: bool) -> list[str]:
    """Text blocks in page order, without what is deleted by meaning or as template."""
    out: list[str] = []
    line: list[str] = []

    def end():
        if line:
            text = " ".join("".join(line).split())
            if text:
                out.append(text)
            line.clear()

    # Each entry is a node or string to enter, or None to end a block.
    waiting: list = list(reversed(nodes))
    while waiting:
        item = waiting.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            line.append(item)
        elif item.tag == "br":
            line.append(" ")
        elif item.never or item.tag == "header" and not article:
            if item.tag in BLOCKS:
                end()
        elif item.code in template and not (article and item.tag in PROSE):
            end()
        elif item.tag in BLOCKS:
            end()
            waiting.append(None)
            waiting += reversed(item.children)
        else:
            waiting += reversed(item.children)
    end()
    return out


def hash_subtrees(root: Node, skip: set[int] = frozenset()) -> None:
    """Sets the code of every element from its tag, names, text and children, leaves first."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        parts = [node.tag, node.names]
        for child in node.children:
            if isinstance(child, Node):
                parts.append(f"\x00{child.code}")
            else:
                parts.append(" ".join(child.split()))
        digest = xxhash.xxh64_intdigest("\x01".join(parts).encode("utf-8", "surrogatepass"))
        node.code = digest - (1 << 64) if digest >> 63 else digest


def candidates(source: str) -> tuple[int, list[int]]:
    """Hash of the page's main text, and codes of the subtrees that may be template."""
    root = parse(source)
    hash_subtrees(root)
    articles = _articles(root)
    main = "\n".join(blocks(articles or [root], frozenset(), bool(articles)))
    digest = xxhash.xxh64_intdigest(main.encode("utf-8", "surrogatepass"))
    inside = {id(a) for a in articles}
    codes, waiting = set(), [(root, False)]
    while waiting:
        node, within = waiting.pop()
        within = within or id(node) in inside
        for child in node.children:
            if isinstance(child, Node):
                if id(child) not in inside and not (within and child.tag in PROSE) \
                        and child.tag not in PLAIN:
                    codes.add(child.code)
                waiting.append((child, within))
    return digest - (1 << 64) if digest >> 63 else digest, sorted(codes)


def extract(source: str, template: set[int]) -> str:
    """Main text of a page, given the codes of its host's template."""
    root = parse(source)
    if template:
        hash_subtrees(root)
    articles = _articles(root)
    if articles:
        return "\n".join(blocks(articles, template, True))
    return "\n".join(blocks([root], template, False) or blocks([root], frozenset(), False))


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/:?#]*)"


def host():
    return F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)).alias("host")


def _rows(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"))


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, texts, codes = [], [], []
        for name, source in zip(batch.column(0), batch.column(1)):
            digest, found = candidates(source.as_py() or "")
            # Code 0 stands for the page itself.
            for code in [0, *found]:
                hosts.append(name.as_py())
                texts.append(digest)
                codes.append(code)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(texts, pa.int64()), pa.array(codes, pa.int64())],
            names=["host", "main", "code"])


def templates(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """host and its template codes. A host has at most (subtrees of a page) / share of them."""
    found = _rows(pages).select(host(), "html").mapInArrow(
        _subtrees, "host string, main long, code long")
    # Copies first, then sums per host and subtree, so a large host combines before the shuffle.
    counted = stored(found.distinct().groupBy("host", "code").count(), "subtrees")
    texts = counted.filter("code = 0").select("host", F.col("count").alias("texts"))
    return (
        counted.filter((F.col("code") != 0) & (F.col("count") >= least)).join(texts, "host")
        .filter(F.col("count") >= share * F.col("texts"))
        .groupBy("host").agg(F.collect_set("code").alias("template"))
    )


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(source.as_py() or "", set(codes.as_py() or ()))
                 for source, codes in zip(batch.column(2), batch.column(3))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"])


def main_text(pages: DataFrame, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    found = stored(templates(pages, share, least), "templates")
    rows = _rows(pages).withColumn("host", host())
    return rows.join(found, "host", "left").select(
        "page_id", "url", "html", "template").mapInArrow(_extract_batches, PAGE_SCHEMA)
