"""Main text of web pages by equivalence-class template deduction (operator 4).

A page is a sequence of tokens: the start of a structural element, named by its
path (tags with id and class), and whole text nodes with their path.  Over the distinct pages of a host each token has an occurrence
vector (how often it occurs in each page).  Tokens with the same vector form an
equivalence class.  A class is valid if it occurs in at least half of the
host's pages and in two, has more than one token, and its tokens come in the same order in
every page; texts inside articles may change places (notices in rotation).  The valid classes, nested by their paths, are the host's template:
its text tokens are constant page furniture, its elements bound the slots.
Inside an article a slot goes if all its text is constant or links; the
article's own slot stays, and so do paragraphs that pages share beside text of
their own, unless nearly all of at least four pages have them and they are the
lesser part of the article.  A page that would keep less than a quarter of its
article is a near copy of others: what they share is the article, and it stays.

A slot is judged once per host: furniture by element or class name, or mostly
links, is dropped.  Of a page that has an article or main element with text,
only the slots in it are extracted, whatever layout the host's other pages
have.  A slot the template does not know (a host with one page, a page unlike
the others) is judged by the same rule on its page alone.  Names say nothing of
html, body, article and main, nor of an element that holds most of its page's
text: a class such as ``no-sidebar`` there tells of the layout.

Occurrence vectors are compared by an order-free sum of hashes, so they are
plain aggregates per host and token: no host is gathered anywhere.  What is
gathered per host is its template, at most twice the tokens of a mean page.
Exact copies of a page count once: they say nothing about a template.

Defined cases: null or empty html gives an empty text; a null url is a host of
its own (the empty one); an unclosed element ends with its parent, an unclosed
comment or script with the page, a quote only if it is closed; very long or
broken markup is read forwards once; a repeated row is extracted each time;
tokens of equal vectors are ordered by place, then by name; an empty table gives
no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardsentry.llm.common import materialize

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_TO_VALUE = re.compile(r"[^>=]*")
_BLANK = re.compile(r"\s*")
_NAME = re.compile(r"""(?:^|\s)(id|class)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

RAW = frozenset(["script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "select", "button", "object"])
VOID = frozenset(["br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr", "param"])
STRUCTURE = frozenset(["html", "head", "body", "article", "main", "section", "div", "nav", "header", "footer", "aside",
                       "form", "ul", "ol", "dl", "table", "fieldset", "figure", "menu", "dialog", "details", "blockquote"])
BLOCKS = STRUCTURE | frozenset(["p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "pre", "hr",
                                "caption", "thead", "tbody", "tfoot", "figcaption", "address", "summary", "legend", "option", "center"])
FURNITURE_TAGS = frozenset(["head", "nav", "footer", "aside", "form", "menu", "dialog"])
FURNITURE_NAMES = frozenset([
    "ad", "ads", "advert", "adverts", "advertisement", "banner", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb",
    "breadcrumbs", "header", "masthead", "footer", "notice", "cookie", "cookies", "consent", "popup", "modal", "comment",
    "comments", "reply", "replies", "share", "sharing", "social", "related", "recommended", "newsletter", "subscribe", "promo",
    "sponsor", "sponsored", "login", "signup", "pagination", "widget", "disclaimer", "gdpr",
])
CONTENT = frozenset(["article", "main"])
# Elements whose names tell of the whole page.
UNNAMED = CONTENT | frozenset(["html", "body"])
# Least share of a host's pages, and most link text in a slot.
SUPPORT = 0.5
LINK_SHARE = 0.5
# Least share of an article's text that its host's template leaves.
OWN_SHARE = 0.25
# A single text of an article's slot is furniture on that many pages at least and that share of the host's, and as the lesser part of the article.
WIDE_PAGES, WIDE_SHARE, LOOSE_SHARE = 4, 0.9, 0.5
# Names that tell of furniture inside an article too, as a part or as a whole, and never of a quotation.
INNER_NAMES = FURNITURE_NAMES - {"header", "reply", "replies", "notice", "disclaimer", "menu", "related"}
INNER_WHOLE = frozenset(["related", "related-posts", "related-articles", "related-links", "related-stories"])


def signature(tag: str, attributes: str) -> str:
    """Tag with its id and classes; attributes of any length, only usual ones are remembered."""
    return _signature(tag, attributes) if len(attributes) < 500 else _signature.__wrapped__(tag, attributes)


@lru_cache(maxsize=100_000)
def _signature(tag: str, attributes: str) -> str:
    names = sorted({w for m in _NAME.finditer(attributes) for w in (m[2] or m[3] or m[4] or "").lower().split()})
    return ".".join([tag, *names]).replace("/", "-").replace("|", "-")


@lru_cache(maxsize=100_000)
def named(part: str, inner: bool) -> bool:
    """Whether the id or class of an element says that it is page furniture."""
    tag, *names = part.split(".")
    if inner:
        return tag != "blockquote" and any(n in INNER_WHOLE or not INNER_NAMES.isdisjoint(re.split(r"[-_]", n)) for n in names)
    return any(w in FURNITURE_NAMES for n in names for w in re.split(r"[-_]", n))


def folded(path: str) -> str:
    """A very deep path as its hash."""
    return path if len(path) < 2000 else f"~{xxhash.xxh64_hexdigest(path)}"


# The border of a block, told from a text node by identity.
BORDER = (0, "\n", False)


class _Scanner:
    """Tags of a page, forwards only: every character is looked at a bounded
    number of times, whatever is left open."""

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in "><\"'"}
        self.ends: dict[str, re.Pattern] = {}

    def _end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin at ``at``;
        a quote counts only as a value's, and only if it is closed."""
        html, n, first = self.html, len(self.html), at
        while True:
            at = _TO_VALUE.match(html, at).end()
            if at >= n:  # the only > stand in quotes
                return html.find(">", first)
            if html[at] == ">":
                return at
            at = _BLANK.match(html, at + 1).end()
            if at < n and html[at] in "\"'":
                quote = html[at]
                at = html.find(quote, at + 1) + 1 if self.last[quote] > at else at + 1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """(start, end, tag, closing, attributes) of the next tag from ``at``
        (tag empty: a comment or declaration), or None."""
        html = self.html
        while 0 <= (lt := html.find("<", at)):
            if html.startswith("<!--", lt):
                end = html.find("-->", lt + 4)
                return lt, len(html) if end < 0 else end + 3, "", False, ""
            if lt > self.last[">"]:
                return None
            if html[lt + 1] in "!?":
                return lt, html.find(">", lt) + 1, "", False, ""
            m = _OPEN.match(html, lt)
            if m:
                gt = self._end(m.end())
                return lt, gt + 1, m[2], bool(m[1]), html[m.end():gt]
            at = lt + 1
        return None

    def after(self, tag: str, at: int) -> int:
        """Place behind the closing tag of a raw element."""
        if tag not in self.ends:
            self.ends[tag] = re.compile(f"</{re.escape(tag)}", re.I)
        m = self.ends[tag].search(self.html, at)
        end = self.html.find(">", m.end()) if m else -1
        return len(self.html) if end < 0 else end + 1


def read_page(html: str | None) -> tuple[list[tuple[str, int, str]], list[tuple[int, str, bool]]]:
    """The structural elements in order as (path, parent, own part of the
    path), after the page itself, and the text nodes as (element, raw text,
    whether a link holds it); BORDER is the border of a block."""
    html = html or ""
    elements: list[tuple[str, int, str]] = [("", 0, "")]
    nodes: list[tuple[int, str, bool]] = []
    stack: list[tuple[str, int]] = []
    open_tags: dict[str, int] = {}
    own, links, at, n = 0, 0, 0, len(html)
    scan = _Scanner(html)
    while at < n:
        found = scan.next(at)
        if found is None:
            nodes.append((own, html[at:], links > 0))
            break
        start, end, tag, closing, attributes = found
        if start > at:
            nodes.append((own, html[at:start], links > 0))
        at = end
        if not tag:
            continue
        tag = tag.lower()
        if tag == "a":
            links = max(0, links + (-1 if closing else 1))
        elif tag == "br":
            nodes.append((own, " ", links > 0))
        if closing:
            if open_tags.get(tag):
                last = ""
                while last != tag:
                    last, _ = stack.pop()
                    open_tags[last] -= 1
                own = stack[-1][1] if stack else 0
                links = 0
            if tag in BLOCKS:
                nodes.append(BORDER)
            continue
        if tag in RAW:
            if not attributes.endswith("/"):
                at = scan.after(tag, at)
            continue
        if tag in BLOCKS:
            nodes.append(BORDER)
            if tag in STRUCTURE:
                path, part = elements[own][0], signature(tag, attributes)
                elements.append((f"{folded(path)}/{part}" if path else part, own, part))
                own = len(elements) - 1
                stack.append((tag, own))
                open_tags[tag] = open_tags.get(tag, 0) + 1
    return elements, nodes


def hints(elements: list[tuple[str, int, str]], nodes: list[tuple[int, str, bool]]) -> tuple[list[bool], list[bool]]:
    """Of every element, whether an article or main element holds it, and
    whether it is page furniture by the names on its path."""
    size = [0] * len(elements)
    for e, raw, _ in nodes:
        size[e] += len(raw.strip())
    for e in range(len(elements) - 1, 0, -1):
        size[elements[e][1]] += size[e]
    inside, furniture = [False], [False]
    for e in range(1, len(elements)):
        _, parent, part = elements[e]
        tag = part.split(".", 1)[0]
        inside.append(inside[parent] or tag in CONTENT)
        furniture.append(
            furniture[parent] or tag in FURNITURE_TAGS or (tag == "header" and not inside[parent])
            or (tag not in UNNAMED and 2 * size[e] <= size[0] and named(part, inside[parent])))
    return inside, furniture


def clean(raw: str) -> str:
    return " ".join((unescape(raw) if "&" in raw else raw).split())


def text_token(path: str, text: str, inside: bool) -> str:
    return f"{path}{'||' if inside else '|'}{xxhash.xxh64_hexdigest(text)}"


def page_tokens(html: str | None) -> dict[str, list[int]]:
    """token -> [occurrences, first place, characters, characters in links]."""
    elements, nodes = read_page(html)
    inside, _ = hints(elements, nodes)
    out: dict[str, list[int]] = {}
    for place, (path, _, _) in enumerate(elements[1:]):
        out.setdefault(path, [0, place, 0, 0])[0] += 1
    for place, (e, raw, link) in enumerate(nodes):
        text = clean(raw)
        if not text:
            continue
        path = elements[e][0]
        slot = out.get(path)
        if slot:
            slot[2] += len(text)
            slot[3] += len(text) * link
        own = out.setdefault(text_token(path, text, inside[e]), [0, len(elements) - 1 + place, 0, 0])
        own[0] += 1
        own[2] += len(text)
    return out


def deduce(tokens: list[tuple[str, int, int, bool]]) -> tuple[list[str], list[str], list[str]]:
    """Template of a host from its valid tokens (token, characters, link
    characters, whether nearly all of several pages have it): constant text
    tokens, slots of links, and single constant texts of articles' slots.

    Inside an article a constant text is surely furniture only if its whole
    slot is constant; what pages share beside text of their own is mostly
    theirs."""
    slots = {t: c for t, c, _, _ in tokens if "|" not in t}
    shared: dict[str, int] = {}
    for t, c, _, _ in tokens:
        if "||" in t:
            path = t.rsplit("||", 1)[0]
            shared[path] = shared.get(path, 0) + c

    def fixed(path: str) -> bool:
        return path.rsplit("/", 1)[-1].split(".", 1)[0] not in CONTENT and shared[path] >= slots.get(path, shared[path] + 1)

    whole = {path: fixed(path) for path in shared}
    constants = [t for t, _, _, _ in tokens if (whole[t.rsplit("||", 1)[0]] if "||" in t else "|" in t)]
    dropped = [t for t, c, a, _ in tokens if "|" not in t and c and a > LINK_SHARE * c]
    loose = [t for t, _, _, wide in tokens if wide and "||" in t and not whole[t.rsplit("||", 1)[0]]]
    return constants, dropped, loose


def extract(html: str | None, constants: frozenset[str], dropped: frozenset[str], loose: frozenset[str] = frozenset()) -> str:
    """Text of the page's remaining slots, one block a line."""
    elements, nodes = read_page(html)
    inside, furniture = hints(elements, nodes)
    own_content = any(inside[e] and not furniture[e] and raw.strip() for e, raw, _ in nodes)
    # The page's own slots that its host's template does not have.
    share: dict[str, list[int]] = {}
    if not own_content:
        for e, raw, link in nodes:
            s = share.setdefault(elements[e][0], [0, 0])
            s[0] += len(raw)
            s[1] += len(raw) * link

    def keep(e: int) -> bool:
        if furniture[e]:
            return False
        if own_content:
            return inside[e]
        path = elements[e][0]
        return path not in dropped and share[path][1] <= LINK_SHARE * share[path][0]

    kept = {e: keep(e) for e in {e for e, _, _ in nodes}}
    texts = [clean(raw) if (constants or loose) and kept[e] else "" for e, raw, _ in nodes]
    names = [text_token(elements[e][0], t, inside[e]) if t else "" for t, (e, _, _) in zip(texts, nodes, strict=True)]
    constant = [t in constants for t in names]
    if own_content:
        # The article's own elements are slots of text by their tag.
        linked = {e for e in kept if elements[e][0] in dropped and elements[e][2].split(".", 1)[0] not in CONTENT}
        gone = [c or e in linked for c, (e, _, _) in zip(constant, nodes, strict=True)]
        sizes = [len(raw.strip()) * kept[e] for e, raw, _ in nodes]
        if sum(n for n, g in zip(sizes, gone, strict=True) if not g) >= OWN_SHARE * sum(sizes):
            constant = gone
        else:
            constant = [False] * len(nodes)
        left = sum(n for n, g in zip(sizes, constant, strict=True) if not g)
        if sum(n for n, t in zip(sizes, names, strict=True) if t in loose) < LOOSE_SHARE * left:
            constant = [g or t in loose for g, t in zip(constant, names, strict=True)]
    blocks: list[str] = []
    block: list[str] = []
    for node, leave in zip([*nodes, BORDER], [*constant, False], strict=True):
        e, raw, _ = node
        if node is BORDER:
            if block and (text := " ".join("".join(block).split())):
                blocks.append(text)
            block = []
        elif kept[e] and not leave:
            block.append(unescape(raw))
    return "\n".join(blocks)


def page_host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


_TOKENS = pa.schema([("host", pa.string()), ("page", pa.int64()), ("token", pa.string()), ("n", pa.int64()),
                     ("place", pa.int64()), ("chars", pa.int64()), ("link_chars", pa.int64())])
_TOKENS_DDL = "host string, page long, token string, n long, place long, chars long, link_chars long"


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        seen: set[tuple[str, int]] = set()
        for host, page, html in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if (host, page) in seen:
                continue
            seen.add((host, page))
            rows.extend((host, page, t, *v) for t, v in page_tokens(html.as_py()).items())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_TOKENS)], schema=_TOKENS)


def _templates(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        found = [deduce([(t["token"], t["chars"], t["link_chars"], t["wide"]) for t in tokens]) for tokens in frame["tokens"]]
        yield pd.DataFrame({"host": frame["host"], "constants": [f[0] for f in found], "dropped": [f[1] for f in found], "loose": [f[2] for f in found]})


def templates(pages: DataFrame, *, url: str = "url", html: str = "html") -> DataFrame:
    """host, constants, dropped, loose: the template of every host with at least two
    distinct pages."""
    rows = pages.select(page_host(F.col(url).cast("string")).alias("host"), F.xxhash64(F.col(html).cast("string")).alias("page"),
                        F.col(html).cast("string").alias("html")).where("html is not null")
    # One row per distinct page and token.
    seen = rows.mapInArrow(_emit, _TOKENS_DDL).groupBy("host", "page", "token").agg(
        *[F.max(c).alias(c) for c in ("n", "place", "chars", "link_chars")])
    seen = materialize(seen, "html-tokens")
    sizes = seen.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages"))
    vectors = seen.groupBy("host", "token").agg(
        F.count("*").alias("support"), F.sum(F.xxhash64("page", "n").cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"))
    frequent = vectors.join(sizes, "host").where((F.col("support") > 1) & (F.col("support") >= F.col("pages") * SUPPORT))
    wide = (F.col("pages") >= WIDE_PAGES) & (F.col("support") >= F.col("pages") * WIDE_SHARE)
    frequent = materialize(frequent.withColumn("wide", wide).drop("pages", "support"), "html-vectors")
    # A class is valid if its tokens, but for texts inside articles, come in one order in all pages.
    inner = F.col("token").contains("||")
    places = F.struct("place", "token")
    ordered = (
        seen.select("host", "page", "token", "place").join(frequent.select("host", "token", "vector"), ["host", "token"])
        .groupBy("host", "page", "vector")
        .agg(F.count("*").alias("size"), F.xxhash64(F.array_sort(F.collect_list(F.when(~inner, places)))["token"]).alias("order"))
        .groupBy("host", "vector").agg(F.max("size").alias("size"), F.min("order").alias("a"), F.max("order").alias("b"))
        .where(F.col("size") > 1).select("host", "vector", (F.col("a") == F.col("b")).alias("in_order"))
    )
    valid = frequent.join(materialize(ordered, "html-classes"), ["host", "vector"]).where(inner | F.col("in_order"))
    grouped = valid.groupBy("host").agg(F.collect_list(F.struct("token", "chars", "link_chars", "wide")).alias("tokens"))
    out = grouped.mapInPandas(_templates, "host string, constants array<string>, dropped array<string>, loose array<string>")
    return materialize(out, "html-templates")


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sets: dict[str, tuple[frozenset, frozenset, frozenset]] = {}
    for b in batches:
        texts = []
        columns = [b.column(n) for n in ("host", "html", "constants", "dropped", "loose")]
        for host, html, *template in zip(*columns, strict=True):
            key = host.as_py()
            if key not in sets:
                if len(sets) > 10_000:
                    sets.clear()
                sets[key] = tuple(frozenset(x.as_py() or ()) for x in template)
            texts.append(extract(html.as_py(), *sets[key]))
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("url"), pa.array(texts, pa.string())], names=["id", "url", "text"])


def main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    rows = pages.select(F.col(key).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    rows = rows.withColumn("host", page_host(F.col("url")))
    joined = rows.join(templates(pages, url=url, html=html), "host", "left")
    out = joined.mapInArrow(_extract, "id long, url string, text string")
    return out.select(F.col("id").alias(key), "url", "text", F.char_length("text").cast("long").alias("n_chars"))
