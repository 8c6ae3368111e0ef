"""Main text of web pages: site templates are found by counting and removed.

Method: every element subtree that holds text is hashed (tag, text and the hashes of its
children; no attributes).  Spark counts in how many pages of a host each hash occurs.  A
subtree that recurs in ``PAGES`` pages and a ``SHARE`` of its host's pages is
template and deleted.  Prose inside the article (paragraphs, headings, lists) recurs for good
reasons too -- quotations, licences, copies -- so it goes only past
``PROSE_PAGES`` and ``PROSE_SHARE``.  Elements that say what they are (``nav``, ``footer``, ``aside``, ``form``,
``script``, a class or id of adverts, notices or comments, ...) go before the counting.

The text is that of the page's outermost ``article`` elements; else of ``main``; else
of the body.  Character references are decoded, white space (as Unicode has it) inside a block becomes one
space, blocks are trimmed and joined by one newline; a line break is white space.  Nothing is cut.

How the templates reach the pages: up to ``BROADCAST`` of them (16 bytes each) are
broadcast; beyond, their rows are joined to the pages' hashes and each page's own hits to the page, hot
templates and repeated pages apart (``common.attach``).  Both ways give the same rows.

Defined results: a NULL page is empty, a page without text gives ''.  Tags that are not closed end as
browsers end them; a tag that the page's end cuts off is dropped.  Pages without a host (NULL url, no ``://``) have
no site, so nothing recurs there.  If all text of a page recurs, the page is a
copy, and its text stays.  Repeated rows count as pages each.  Inside an article, a ``header`` keeps its headings only.  An empty
table gives no rows.  Columns other than those named are ignored.
"""

from __future__ import annotations

import html as entities
import re
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from splitlens.llm.common import attach, ship_by_value, written

ship_by_value(__name__)

# Many pages of a host: at least so many, and such a share of them.
PAGES, SHARE = 4, 0.3
PROSE_PAGES, PROSE_SHARE = 10, 0.8
# Templates that are broadcast, 16 bytes each.
BROADCAST = 200_000
BATCH = 512

# Elements of HTML by their part in a page.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
CHROME = set("head script style noscript template title nav footer aside form button select input textarea xmp iframe noembed noframes "
             "svg canvas object embed audio video dialog menu fieldset label datalist search".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr "
             "ul caption option optgroup".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6 hgroup".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
             "header hgroup hr main menu nav ol p pre search section table ul".split())
# Start tags that end an open element of these kinds, up to the nearest boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
        "option": ({"option"}, {"select", "datalist"})}
SCOPE = {"html", "body", "table", "td", "th", "caption", "object", "template"}
ROOTS = {"html", "body", "main", "article"}
# Prose: what an article is made of.
PROSE = set("p h1 h2 h3 h4 h5 h6 hgroup li ul ol dl dt dd blockquote pre table thead tbody tr td th caption figure figcaption b i em strong a "
            "span u s small sub sup q cite code abbr time mark br".split())
ROLES = set("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())

# Words of class names and ids.  The first kind speaks for itself, the second only beside neutral words.
SURE = set("ad ads advert adverts advertisement advertising adsense sponsor sponsored comment comments commentlist commentform disqus replies "
           "respond cookie cookies gdpr newsletter breadcrumb breadcrumbs pagination paywall popup".split())
LIKELY = set("nav navbar navigation menu submenu sidebar footer header masthead banner notice notices alert consent promo promotion share "
             "sharing social related recommended recommendations subscribe subscription signup login modal overlay toolbar widget skip search "
             "teaser teasers trending popular tags copyright legal disclaimer".split())
NEUTRAL = set("site page top bottom main left right inner outer wrap wrapper container box block area section bar widgets list items item links "
              "link button buttons icons icon primary secondary global mobile desktop module panel group row col posts stories slot unit text "
              "message messages content form media us this to of the and".split())

_TAG = re.compile(r"""<(?:!--(?:-?>|.*?(?:--!?>|\Z))|[!?][^>]*+(?:>|\Z)|/(?![a-zA-Z])[^>]*+(?:>|\Z)
                       |(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)(?P<shut>>|\Z))""", re.S | re.X)
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


@lru_cache(maxsize=8192)
def _says(tag: str, attrs: str) -> str:
    """What an element says of itself: 'no' page text, 'header', or ''."""
    if tag in CHROME:
        return "no"
    found = "header" if tag == "header" else ""
    if not attrs.strip(" \t\r\n\f/"):
        return found
    values = {}
    for m in _ATTR.finditer(attrs):
        values.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    if "hidden" in values or values.get("aria-hidden", "").lower() == "true":
        return "" if tag in ROOTS else "no"
    if values.get("role", "").lower() in ROLES and tag not in ROOTS:
        return "no"
    for name in f"{values.get('class', '')} {values.get('id', '')}".split():
        parts = [p.lower() for p in _PART.findall(name)]
        if not parts:
            continue
        if SURE.intersection(parts) and tag not in {"html", "body", "main"}:
            return "no"
        if tag not in ROOTS and LIKELY.intersection(parts) and all(p in LIKELY or p in NEUTRAL for p in parts):
            if "header" not in parts:
                return "no"
            found = "header"
    return found


class Element:
    __slots__ = ("tag", "parent", "out", "lean", "article", "main", "items", "key")

    def __init__(self, tag, parent, out, lean):
        self.tag, self.parent, self.out, self.lean = tag, parent, out, lean
        self.article = tag == "article" or (parent is not None and parent.article)
        self.main = tag == "main" or (parent is not None and parent.main)
        self.items, self.key = [], None


class Page:
    """``pieces``: (element, text) in page order, text None where a block begins or
    ends; ``elements`` with text, their ``key`` set."""

    def __init__(self, text: str, host: str):
        self.pieces: list = []
        self.elements: list[Element] = []
        self.salt = host.encode()
        self.stack = [Element("html", None, False, False)]
        self.open: dict[str, int] = {}
        self._read(text)
        while self.stack:
            self._close()

    def _close(self) -> None:
        e = self.stack.pop()
        if self.stack:
            self.open[e.tag] -= 1
        if e.tag in BLOCKS and not e.out:
            self.pieces.append((e, None))
        if e.items:
            inner = blake2b(e.tag.encode() + b"".join(e.items), digest_size=16).digest()
            if e.parent is not None:
                e.parent.items.append(b"<" + inner)
            if e.tag not in ROOTS:
                e.key = blake2b(inner + self.salt, digest_size=16).digest()
                self.elements.append(e)
            e.items = None

    def _close_to(self, place: int) -> None:
        while len(self.stack) > place:
            self._close()

    def _innermost(self, tags, limits) -> int | None:
        if not any(self.open.get(t) for t in tags):
            return None
        for at in range(len(self.stack) - 1, 0, -1):
            tag = self.stack[at].tag
            if tag in tags:
                return at
            if tag in limits:
                return None
        return None

    def _start(self, tag: str, attrs: str) -> None:
        if tag == "html" or tag == "body":
            if tag == "body" and len(self.stack) > 1 and self.stack[1].tag == "head":
                self._close_to(1)
            return
        if tag in ENDS_P and (at := self._innermost({"p"}, SCOPE | {"button"})):
            self._close_to(at)
        if tag in ENDS:
            while at := self._innermost(*ENDS[tag]):
                self._close_to(at)
        if tag in HEADINGS and self.stack[-1].tag in HEADINGS:
            self._close()
        top = self.stack[-1]
        out, lean = top.out, top.lean
        if lean and tag in HEADINGS:
            out = lean = False
        says = _says(tag, attrs)
        if says and not out:
            out, lean = True, says == "header" and (top.article or top.main)
        e = Element(tag, top, out, lean)
        if tag in BLOCKS and not out:
            self.pieces.append((e, None))
        if tag == "br" and not out:
            self.pieces.append((top, " "))
        if tag not in VOID:
            self.stack.append(e)
            self.open[tag] = self.open.get(tag, 0) + 1

    def _end(self, tag: str) -> None:
        if self.stack[-1].tag == tag and len(self.stack) > 1:
            self._close()
            return
        if tag in ("html", "body"):
            return
        if tag == "p" and not self._innermost({"p"}, SCOPE | {"button"}):
            self.pieces.append((self.stack[-1], None))
            return
        if tag in HEADINGS:
            at = self._innermost(HEADINGS, SCOPE)
        else:
            at = self._innermost({tag}, SCOPE - {tag} if tag in BLOCKS else SCOPE | BLOCKS)
        if at:
            self._close_to(at)

    def _text(self, text: str) -> None:
        top = self.stack[-1]
        if top.out:
            return
        if "&" in text:
            text = entities.unescape(text)
        self.pieces.append((top, text))
        flat = " ".join(text.split())
        if flat:
            top.items.append(b" " + flat.encode("utf-8", "surrogatepass"))

    def _read(self, text: str) -> None:
        at, search = 0, _TAG.search
        while m := search(text, at):
            start, stop = m.span()
            if start > at:
                self._text(text[at:start])
            at = stop
            end, tag, attrs, shut = m.groups()
            if tag is None or not shut:
                continue
            tag = tag.lower()
            if end:
                self._end(tag)
                continue
            self._start(tag, attrs)
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(text, at)
                at = stop.start() if stop else len(text)
        if at < len(text):
            self._text(text[at:])

    def _gather(self, root: str, gone) -> str:
        out, block, deleted = [], [], {}

        def is_gone(e) -> bool:
            chain = []
            while e is not None and e not in deleted:
                chain.append(e)
                e = e.parent
            verdict = e is not None and deleted[e]
            for x in reversed(chain):
                verdict = deleted[x] = verdict or gone(x)
            return verdict

        for e, text in [*self.pieces, (None, None)]:
            if text is None:
                if flat := " ".join("".join(block).split()):
                    out.append(flat)
                block = []
            elif (root == "body" or getattr(e, root)) and not is_gone(e):
                block.append(text)
        return "\n".join(out)

    def main_text(self, recurring: dict[bytes, bool]) -> str:
        """``recurring``: the templates' keys, true for those past the prose bars."""
        def gone(e) -> bool:
            past = recurring.get(e.key) if e.key else None
            return past is not None and (past or not (e.tag in PROSE and (e.article or e.main)))

        for root in ("article", "main", "body"):
            if whole := self._gather(root, lambda e: False):
                return (self._gather(root, gone) or whole) if recurring else whole
        return ""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' if none."""
    host = F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _keys(batches):
    """(host, key) of the subtrees of each page, each once; with a page column
    in front where there is one, then with one row more, of an empty key."""
    for b in batches:
        marked = "page" in b.schema.names
        marks = b.column("page").to_pylist() if marked else [None] * b.num_rows
        out: dict[str, list] = {"page": [], "host": [], "key": []}
        for mark, host, text in zip(marks, b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
            found = {e.key for e in Page(text, host).elements} if host else set()
            if marked:
                found.add(b"")
            out["page"] += [mark] * len(found)
            out["host"] += [host] * len(found)
            out["key"] += found
        cols = {c: pa.array(v, pa.binary() if c == "key" else pa.string()) for c, v in out.items() if c != "page" or marked}
        yield pa.RecordBatch.from_pydict(cols)


def templates(pages: DataFrame, pages_least: int = PAGES, share: float = SHARE, prose_pages: int = PROSE_PAGES,
              prose_share: float = PROSE_SHARE) -> DataFrame:
    """(key, n, prose) of the subtrees that recur in many pages of their host;
    ``prose`` where they pass the prose bars as well.  ``pages``: host, html."""
    known = pages.where("host <> ''")
    counted = known.select("host", "html").mapInArrow(_keys, "host string, key binary").groupBy("key").agg(
        F.count("*").alias("n"), F.first("host").alias("host")).where(F.col("n") >= pages_least)
    hosts = known.groupBy("host").agg(F.count("*").alias("of"))
    judged = counted.join(hosts, "host").where(F.col("n") >= share * F.col("of"))
    prose = (F.col("n") >= prose_pages) & (F.col("n") >= prose_share * F.col("of"))
    return written(judged.select("key", "n", prose.alias("prose")), "html-templates")


_TEXTS = "page_id long, url string, text string"


def _texts(common: dict | None):
    known = common

    def run(batches):
        recurring = known.value if known is not None else None
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string())])
        for b in batches:
            own = b.column("hits").to_pylist() if recurring is None else [None] * b.num_rows
            texts = []
            for host, text, hits in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), own, strict=True):
                keys = recurring if hits is None and recurring is not None else {bytes.fromhex(h["key"]): h["prose"] for h in hits or ()}
                texts.append(Page(text, host).main_text(keys if host else {}))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], schema=schema)

    return run


def _with_hits(pages: DataFrame, found: DataFrame) -> DataFrame:
    """``pages`` with their own templates, joined by a digest of the page."""
    marked = pages.withColumn("page", F.sha2(F.concat("host", F.lit("\n"), "html"), 256))
    keys = marked.select("page", "host", "html").mapInArrow(_keys, "page string, host string, key binary")
    keys = keys.select("page", F.hex("key").alias("key"))
    found = found.withColumn("key", F.hex("key"))
    total = found.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    judged = attach(keys, found, "key", "n", ["page"], total, ["prose"])
    hit = F.when(F.col("prose").isNotNull(), F.struct("key", "prose"))
    hits = written(judged.groupBy("page").agg(F.collect_set(hit).alias("hits"), F.count("*").alias("rows")), "html-hits")
    return attach(marked, hits, "page", "rows", ["page_id", "url"], hits.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0], ["hits"])


def extract(pages: DataFrame, broadcast: int = BROADCAST, **bars) -> DataFrame:
    """(page_id, url, text) of ``pages`` (page_id, url, html); ``bars`` as in ``templates``."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host_of(F.col("url")).alias("host"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    found = templates(rows, **bars)
    if found.count() <= broadcast:
        recurring = {bytes(r["key"]): r["prose"] for r in found.select("key", "prose").collect()}
        known = pages.sparkSession.sparkContext.broadcast(recurring)
        return rows.mapInArrow(_texts(known), _TEXTS)
    return _with_hits(rows, found).select("page_id", "url", "host", "html", "hits").mapInArrow(_texts(None), _TEXTS)
