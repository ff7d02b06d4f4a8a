"""Main text of HTML pages by minimum-cut labelling of their blocks.

A page is cut into blocks of text at block elements. A classifier gives each block a cost for being called content and one for
being called boilerplate; the difference becomes a capacity from the source or to the sink. Edges between neighbouring
blocks, and between blocks with the same parent, weaken with their distance in the element tree. The minimum cut, found by
maximum flow, is the labelling of least total cost.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.llm.base import column, texts, tidy

_TAG = re.compile(
    r"""<!--(?:.*?-->|.*\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[='"])*+)(?P<close>>|\Z)""",
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[a-z]+|[0-9]+")

#: Element names of the markup language by what they do to text.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "noembed", "noframes", "canvas", "audio", "video"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "button", "caption", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset",
    "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu",
    "nav", "ol", "optgroup", "option", "p", "pre", "search", "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul",
}
#: An open element of the value's kinds ends where the key starts, up to the nearest of the stops.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_STOPS = {"ul", "ol", "menu", "dl", "table", "select", "body", "html"}

#: Log-odds of boilerplate (below 0) or content (above 0) that an enclosing element gives, by name and by class, id or role.
ELEMENT = {"nav": -16, "footer": -16, "aside": -16, "form": -16, "menu": -16, "select": -16, "button": -16, "dialog": -16, "search": -16, "head": -30,
           "title": -30, "header": -16, "fieldset": -16, "article": 6, "main": 4}
_BAD = """ad ads advert adverts advertisement advertisements advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist cookie cookies
consent copyright disclaimer disqus dropdown footer footnav gdpr header login masthead menu menubar modal nav navbar navigation navigations newsletter notice
notices pager pagination popup promo promoted promotion recommended related replies reply respond search share sharing sidebar sidebars signup skyscraper social
sponsor sponsored subscribe subscription tagcloud toolbar topbar widget widgets complementary contentinfo alert dialog alertdialog""".split()
_GOOD = """article articlebody content entry entrycontent maincontent post postbody postcontent story storybody""".split()
NAMES = dict.fromkeys(_GOOD, 4.0) | dict.fromkeys(_BAD, -5.5)  # a long paragraph outweighs one bad name
_PARTLY = -3.0  # a bad word that is only part of a name
_STATES = {"has", "no", "with", "without"}  # names that begin so tell what else there is
#: Elements whose text runs to the end of the page where their end is missing.
_TO_END = {"script", "style", "textarea"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}


class Block:
    __slots__ = ("text", "linked", "tag", "path", "bias")

    def __init__(self, text, linked, tag, path, bias):
        self.text, self.linked, self.tag, self.path, self.bias = text, linked, tag, path, bias


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def _named(values: list[str]) -> float:
    """Log-odds of the names in class, id and role: the best good one and the worst bad one, summed."""
    good = bad = 0.0
    for v in values:
        for token in re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", v).lower().split():
            parts = [p for p in _PARTS.findall(token) if not p.isdigit()]
            if not parts or len(parts) > 1 and parts[0] in _STATES:
                continue
            whole = NAMES.get("".join(parts), 0.0)
            each = [NAMES.get(p, 0.0) for p in parts]
            if not whole:
                whole = min(each) if max(each) < 0 else max(each) + (_PARTLY if min(each) < 0 else 0.0)
            good, bad = max(good, whole), min(bad, whole)
    return good + bad


def _element_bias(name: str, raw: str, inside_article: bool) -> tuple[float, float]:
    """Log-odds that one element gives by its kind, and by its class, id and role.

    Ids of headings, and of sections inside an article, are mostly made from the text of the heading and say nothing.
    """
    bias = float(ELEMENT.get(name, 0))
    if name == "header" and inside_article:
        bias = -1.0
    if not raw or raw.isspace():
        return bias, 0.0
    a = _attributes(raw)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", a.get("style", "")):
        return -30.0, 0.0
    if name in ("html", "body"):
        return bias, 0.0
    from_text = name in _HEADINGS or name == "section" and inside_article
    named = _named([a.get("class", ""), "" if from_text else a.get("id", ""), a.get("role", "")])
    return bias, min(named, 0.0) if name in ("article", "main") else named


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, with what their open elements say about them."""
    out: list[Block] = []
    stack: list[tuple[str, float, int, float]] = []  # name, log-odds summed by kind, number of the element, and summed by names
    text: list[str] = []
    state = {"number": 0}
    open_, seen = Counter(), Counter()
    linked: list[str] = []
    endless: set[str] = set()  # raw elements without an end in the rest of the page

    def flush() -> None:
        if text:
            body = " ".join(html.unescape("".join(text)).split())
            if body:
                holder = [e for e in stack if e[0] in BLOCK]
                out.append(Block(body, len(" ".join("".join(linked).split())), holder[-1][0] if holder else "", tuple(e[2] for e in holder), stack[-1][1] + stack[-1][3] if stack else 0.0))
            text.clear()
            linked.clear()

    def add(piece: str) -> None:
        if piece:
            text.append(piece)
            if open_["a"]:
                linked.append(piece)

    def close(names: set[str], stops: set[str] = frozenset()) -> None:
        if not any(open_[x] for x in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i][0] in names:
                if any(e[0] in BLOCK for e in stack[i:]):
                    flush()
                open_.subtract(e[0] for e in stack[i:])
                del stack[i:]
                return
            if stack[i][0] in stops:
                return

    at, n = 0, len(page)
    while at < n:
        m = _TAG.search(page, at)
        if m is None:
            rest = page[at:]
            add(rest)
            break
        add(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            if m["cdata"]:
                add(m["cdata"])
            continue
        if not m["close"]:
            break
        name = name.lower()
        if m["end"]:
            if name == "br":
                add(" ")
            elif name == "p" and not open_["p"]:
                flush()
            else:
                close({name}, {"body", "html"} if name not in ("body", "html") else frozenset())
            continue
        if name == "br":
            add(" ")
            continue
        if name in RAW:
            if not m["attrs"].rstrip().endswith("/") or name in ("script", "style", "textarea", "iframe", "noscript"):
                end = None if name in endless else re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
                if end:
                    at = end.end()
                elif name in _TO_END:
                    at = n
                else:
                    endless.add(name)
            if name in ("iframe", "object", "video", "canvas"):
                flush()
            continue
        if name in BLOCK:
            flush()
            if name in _ENDS:
                close(_ENDS[name], _STOPS)
            elif open_["p"]:
                close({"p"}, {"table", "td", "th", "li", "div", "article", "section", "blockquote", "body"})
        if name in VOID:
            continue
        state["number"] += 1
        kind, names = (stack[-1][1], stack[-1][3]) if stack else (0.0, 0.0)
        own, named = _element_bias(name, m["attrs"], open_["article"] + open_["main"] > 0)
        if name in ("article", "main") and not seen[name]:
            names = max(names, 0.0)  # wrappers of the first article are named for what else they hold
        if named < 0 and named <= NAMES["comment"]:
            own, kind, names = min(own, 0.0), min(kind, 0.0), min(names, 0.0)  # what the elements around it hold does not speak for it
        seen[name] += 1
        stack.append((name, kind + own, state["number"], names + named))
        open_[name] += 1
    flush()
    return out


def log_odds(b: Block) -> float:
    """Log-odds that a block is content: its enclosing elements, then length, links and sentence marks."""
    words = b.text.count(" ") + 1
    links = min(1.0, b.linked / len(b.text))
    own = -0.8 + 0.9 * min(words, 40) ** 0.5 - 6.0 * links + (0.8 if b.text[-1] in ".!?:;\"'”»…。" else 0.0)
    if b.tag in _HEADINGS:
        own += 1.0
    if b.text[0] in "©" or "all rights reserved" in b.text.lower():
        own -= 4.0
    return own + b.bias


def _affinity(a: Block, b: Block) -> float:
    """Smoothness between two blocks: weaker with every element that one has and the other has not."""
    shared = 0
    for x, y in zip(a.path, b.path):
        if x != y:
            break
        shared += 1
    apart = len(a.path) + len(b.path) - 2 * shared
    return 1.6 / (1 + apart)


class Flow:
    """Maximum flow by shortest augmenting paths in layers; capacities are integers."""

    def __init__(self, n: int):
        self.to, self.cap, self.out = [], [], [[] for _ in range(n)]

    def edge(self, a: int, b: int, cap: int, back: int = 0) -> None:
        for x, y, c in ((a, b, cap), (b, a, back)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.cap.append(c)

    def _layers(self, s: int) -> list[int]:
        level = [-1] * len(self.out)
        level[s] = 0
        todo = deque([s])
        while todo:
            x = todo.popleft()
            for e in self.out[x]:
                if self.cap[e] and level[self.to[e]] < 0:
                    level[self.to[e]] = level[x] + 1
                    todo.append(self.to[e])
        return level

    def source_side(self, s: int, t: int) -> list[bool]:
        """Nodes on the source side of the minimum cut with the fewest nodes there."""
        while (level := self._layers(s))[t] >= 0:
            following = [0] * len(self.out)
            path, x = [], s
            while True:
                if x == t:
                    push = min(self.cap[e] for e in path)
                    for e in path:
                        self.cap[e] -= push
                        self.cap[e ^ 1] += push
                    first = next(i for i, e in enumerate(path) if not self.cap[e])
                    x = self.to[path[first] ^ 1]
                    del path[first:]
                    continue
                edges = self.out[x]
                while following[x] < len(edges):
                    e = edges[following[x]]
                    if self.cap[e] and level[self.to[e]] == level[x] + 1:
                        break
                    following[x] += 1
                else:
                    if not path:
                        break
                    x = self.to[path.pop() ^ 1]
                    following[x] += 1
                    continue
                path.append(e)
                x = self.to[e]
        return [v >= 0 for v in level]


def label(found: list[Block]) -> list[bool]:
    """Whether each block is content: the labelling of least cost."""
    n = len(found)
    if not n:
        return []
    net = Flow(n + 2)
    for i, b in enumerate(found):
        cost = round(100 * log_odds(b))
        net.edge(n, i, max(cost, 0))
        net.edge(i, n + 1, max(-cost, 0))
    last: dict[int, int] = {}
    for i, b in enumerate(found):
        parent = b.path[-2] if len(b.path) > 1 else 0
        linked = {i - 1} if i else set()
        if parent in last:
            linked.add(last[parent])
        for j in linked:
            w = round(100 * _affinity(found[j], b))
            net.edge(j, i, w, w)
        last[parent] = i
    return net.source_side(n, n + 1)[:n]


def extract(page: str) -> str:
    """Text of the content blocks, one line each."""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, label(found)) if keep)


_TEXT = T.StructType([T.StructField("key", T.LongType()), T.StructField("url", T.StringType()), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract_pages(pages: DataFrame, body: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, url, text, n_chars): the main text of each whole page; ``n_chars`` counts code points.

    Null and empty pages, and pages without content, have an empty text. Markup may be broken: what is cut off inside a tag
    is dropped, elements left open end with the page. Repeated rows and null keys each keep their line; an empty table gives
    an empty table; other columns are not looked at.
    """

    def scan(batches):
        for b in batches:
            text = [extract(t.decode("utf-8", "replace")) for t in texts(b)]
            yield pa.RecordBatch.from_arrays(
                [column(b, "key"), column(b, "url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], _TEXT.fieldNames()
            )

    slim = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(body), F.lit("")).alias("text"))
    return slim.mapInArrow(tidy(scan), _TEXT).select(F.col("key").alias(key), F.col("url").alias(url), "text", "n_chars")
