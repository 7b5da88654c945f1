"""Main text of web pages by consensus paths per host.

Every container of a page (an element that holds blocks) is scored by the text in it
that is not in links or boilerplate. From the best one the page climbs to the smallest
ancestor that also holds the text beside it (headings, leads, lists, other sections).
That element's generalised tag-class path ("body>div.post-#>article") is the page's vote;
Spark counts the votes per host, and every page is read again from its host's winning
path, with the same climb. A page without that path keeps its own best container, so one
odd page neither spoils a host nor is lost. Only divs with a class right under the body
compete: such a div is no reason to climb, so the winner's text is kept without theirs.

Boilerplate is what elements like nav, roles or hiding attributes say it is. Class and id
words (``sidebar``, ``widget``), and forms, only hint at it: page builders put such words
on wrappers of the whole article. So a hint counts as far as the page agrees: an element
that holds more than half of the page's text outside links does not count as a part of it
beside the article, for whole names from nine tenths on, or if an article stands in it that
holds that half. A header within an article or main is part of it (its title); a footer is not.

A null or empty page has the text ''; pages may be of any length. Repeated rows each give a
row and a vote. Other columns of ``pages`` are not read.
"""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import written
from .url_templates import host_and_path

#: Rows of a host are dealt to this many partitions for the join with its winner.
SALTS = 32
#: Winners of at most so many bytes are broadcast.
BROADCAST_BYTES = 8 << 20

# Element names by their role.
RAW = frozenset("script style noscript template textarea title iframe".split())
#: No text of the page; '/>' ends them, and so does the end of the element they stand in.
FOREIGN = frozenset("svg math object".split())
#: HTML inside svg or math; elsewhere a block's start tag ends those two.
INSIDE = frozenset("foreignobject annotation-xml desc".split())
BLOCK = frozenset("""
html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot
tr td th caption pre blockquote figure figcaption address details summary fieldset center hgroup
nav header footer aside form menu dialog search
""".split())
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption pre figcaption summary address".split())
BOILERPLATE = frozenset("nav header footer aside menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert".split())
HINTS = frozenset("""
ad ads advert advertisement adverts banner sponsor sponsored promo promotion nav navbar navigation
menu sidebar footer header masthead comment comments reply replies respond disqus cookie cookies
consent notice popup modal overlay share sharing social related recommended breadcrumb breadcrumbs
newsletter subscribe signup login widget widgets pager pagination skip toolbar
""".split())
#: Elements that a class never makes boilerplate.
NEVER = frozenset("html body main article".split())
#: Elements (the root is '') whose divs may be parts of the page rather than of its text.
LAYOUT = frozenset(("", "html", "body"))
#: A start tag closes an open element of these first, unless one of the second stands between.
CLOSES = {"p": ("p", "h1", "h2", "h3", "h4", "h5", "h6"), "li": ("li",), "dt": ("dt", "dd"),
          "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",)}
KEEPS = frozenset("ul ol dl table div section article main body blockquote".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*?)>", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
#: Values of attributes, and the attribute that hides an element.
_VALUE = re.compile(r"=\s*(?:\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_HIDDEN = re.compile(r"(?<![^\s\"'])hidden(?![^\s=/])", re.I)
_OBJECT_END = re.compile(r"</object(?=[\s/>])", re.I)


#: Shares of the page's text outside links above which a hint says nothing: of a word within
#: a name and of forms, and of a whole name.
PART, WHOLE = 0.5, 0.9
#: Words of readers' comments, where articles stand too.
READERS = frozenset("comment comments reply replies respond disqus".split())


class Element:
    __slots__ = ("tag", "path", "parent", "hard", "hint", "readers", "boilerplate", "named", "held",
                 "plain", "apart", "score", "unlinked", "article")

    def __init__(self, tag: str, path: str, parent: Element | None, hard: bool):
        self.tag, self.path, self.parent = tag, path, parent
        self.hard = hard  # boilerplate whatever it holds
        self.hint = 0.0  # boilerplate up to this share of the page's text; 0: no hint
        self.readers = False
        self.boilerplate: bool | None = None  # see _settle
        self.named = False  # a div with a class
        self.held = self.plain = self.apart = 0  # see _weigh
        self.score = 0.0
        self.unlinked = 0  # characters outside links in it
        self.article = 0  # the same of the largest article or main in it, or itself


def _general(name: str) -> str:
    return re.sub(r"[0-9]+", "#", name.lower())


def _in_article(e: Element | None) -> bool:
    while e is not None and e.tag not in ("article", "main"):
        e = e.parent
    return e is not None


def _open(tag: str, attrs: str, parent: Element | None) -> Element:
    found = {a.lower(): b or c or d for a, b, c, d in _ATTR.findall(attrs)} if attrs.strip() else {}
    classes = [_general(c) for c in found.get("class", "").split()]
    label = ".".join([tag, *sorted(set(classes))])
    hard = parent is not None and parent.hard
    hint, readers = 0.0, False
    if tag not in NEVER:
        hard = (hard or tag in BOILERPLATE and not (tag == "header" and _in_article(parent))
                or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true"
                or _HIDDEN.search(_VALUE.sub("", attrs)) is not None
                or "display:none" in found.get("style", "").replace(" ", ""))
        names = [*classes, _general(found.get("id", ""))]
        words = [[w for w in re.split(r"[-_#\s]+", name) if w] for name in names]
        if any(len(ws) == 1 and ws[0] in HINTS for ws in words):
            hint = WHOLE
        elif tag == "form" or any(w in HINTS for ws in words for w in ws):
            hint = PART
        readers = any(w in READERS for ws in words for w in ws)
    e = Element(tag, f"{parent.path}>{label}" if parent else label, parent, hard)
    e.hint, e.readers = hint, readers
    e.named = tag == "div" and bool(classes)
    return e


def _within(e: Element | None, outer: Element) -> bool:
    while e is not None and e is not outer:
        e = e.parent
    return e is outer


def blocks(page: str) -> list[tuple[Element, str, int]]:
    """(innermost block element, text, characters in links) in page order, boilerplate too.

    Text is decoded and its white space made single spaces; blank blocks are left out.
    """
    root = Element("", "", None, False)
    here, links = root, 0
    out: list[tuple[Element, str, int]] = []
    parts: list[str] = []
    linked = 0
    at = 0
    foreign: list[tuple[str, Element]] = []  # open ones, each with the element it stands in
    ends: list[int] | None = None  # where the end tags of objects are

    def text(piece: str) -> None:
        nonlocal linked
        if piece and not foreign:
            piece = html.unescape(piece)
            parts.append(piece)
            if links:
                linked += len(piece)

    def flush() -> None:
        nonlocal linked
        if parts:
            joined = " ".join("".join(parts).split())
            if joined:
                out.append((here, joined, linked))
            parts.clear()
        linked = 0

    while m := _TOKEN.search(page, at):
        text(page[at:m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        if tag in RAW:
            if not closing and not (foreign and foreign[-1][0] in ("svg", "math")
                                    and m[3].endswith("/")):
                # nothing but its own end tag ends a raw element
                end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
                at = end.end() if end else len(page)
        elif tag in FOREIGN or foreign and tag in INSIDE:
            if closing:
                k = max((k for k, x in enumerate(foreign) if x[0] == tag), default=None)
                if k is not None:
                    here = foreign[k][1]
                    del foreign[k:]
            elif not m[3].endswith("/"):
                if tag == "object":  # one that no end tag is left for holds nothing
                    if ends is None:
                        ends = [x.start() for x in _OBJECT_END.finditer(page)]
                    left = len(ends) - bisect.bisect_left(ends, at)
                    if left <= sum(x[0] == tag for x in foreign):
                        continue
                foreign.append((tag, here))
        elif tag == "a":
            if foreign:
                continue
            links = max(0, links + (-1 if closing else 1))
        elif tag in ("br", "hr"):
            parts.append(" ")
        elif tag in BLOCK:
            if not closing:
                while foreign and foreign[-1][0] in ("svg", "math"):
                    here = foreign.pop()[1]
            if closing:
                e = here
                while e is not root and e.tag != tag:
                    e = e.parent
                if e is root:
                    if not foreign:
                        flush()
                        links = 0
                    continue
                # What stands in the ended element or below it ends too.
                while foreign and _within(foreign[-1][1], e):
                    here = foreign.pop()[1]
                if not foreign:
                    flush()
                    links = 0
                here = e.parent
            elif foreign:
                here = _open(tag, m[3], here if here is not root else None)
                here.parent, here.hard = here.parent or root, True
            else:
                flush()
                links = 0
                e, wanted = here, CLOSES.get(tag, ("p",) if tag not in ("html", "body") else ())
                while e is not root and e.tag not in wanted and e.tag not in KEEPS:
                    e = e.parent
                if e is not root and e.tag in wanted:
                    here = e.parent
                here = _open(tag, m[3], here if here is not root else None)
                if here.parent is None:
                    here.parent = root
    text(page[at:])
    flush()
    _settle(out)
    _weigh(out)
    return out


def _settle(found: list[tuple[Element, str, int]]) -> None:
    """Decide which elements are boilerplate, from the shares of the text that they hold."""
    total = 0
    for e, text, linked in found:
        if e.hard:
            continue
        worth = max(0, len(text) - 2 * linked)
        total += worth
        while e is not None:
            e.unlinked += worth
            e = e.parent
    seen: set[int] = set()
    for e, _, _ in found:
        while e is not None and id(e) not in seen and not e.hard:
            seen.add(id(e))
            if e.tag in ("article", "main"):
                up: Element | None = e
                while up is not None and up.article < e.unlinked:
                    up.article = e.unlinked
                    up = up.parent
            e = e.parent
    for e, _, _ in found:
        line = []
        while e is not None and e.boilerplate is None:
            line.append(e)
            e = e.parent
        for e in reversed(line):
            above = e.parent is not None and e.parent.boilerplate
            e.boilerplate = bool(above or e.hard or e.hint and not _whole(e, total))


def _whole(e: Element, total: int) -> bool:
    """Whether an element with a hint holds so much of the page that it is no part beside the
    article."""
    if e.hint == WHOLE or e.readers:
        article = 0 if e.readers else e.article
        return e.unlinked >= WHOLE * total > 0 or article > PART * total
    return e.unlinked > PART * total


def _weigh(found: list[tuple[Element, str, int]]) -> None:
    """Counts per element, boilerplate left out: all blocks in it, those mostly outside
    links, and how many of the latter stand in its divs with a class."""
    for e, text, linked in found:
        if e.boilerplate:
            continue
        plain, below = int(len(text) > 2 * linked), None
        while e is not None:
            e.held += 1
            e.plain += plain
            if below is not None and below.named:
                e.apart += plain
            below, e = e, e.parent


def _climb(e: Element) -> Element:
    """The smallest ancestor of ``e``, or itself, that no further one adds main text to.

    In an article or main every block counts, elsewhere those mostly outside links, and
    of a layout element (body) those outside its divs with a class.
    """
    top, at, below, author = e, e.parent, e, 0
    up = at
    while up is not None:
        author += up.tag in ("article", "main")
        up = up.parent
    while at is not None:
        if author:
            more = at.held > top.held
        elif at.tag in LAYOUT:
            more = at.plain - at.apart > (0 if below.named else below.plain)
        else:
            more = at.plain > top.plain
        if more:
            top = at
        author -= at.tag in ("article", "main")
        at, below = at.parent, at
    return top


def _container(e: Element) -> Element:
    while e.tag in LEAF and e.parent is not None:
        e = e.parent
    return e


def best_path(found: list[tuple[Element, str, int]]) -> tuple[str, float]:
    """Path that the container with the most text of its own climbs to, and that one's score.

    A container gets its blocks' characters outside links, its parent a third of them. The
    path is '' if there is none.
    """
    seen: list[Element] = []
    for e, text, linked in found:
        if e.boilerplate:
            continue
        worth = max(0, len(text) - 2 * linked)
        c = _container(e)
        for share in (1.0, 1 / 3):
            if c.boilerplate or not c.path:
                break
            if not c.score:
                seen.append(c)
            c.score += worth * share
            c = c.parent
    if not seen:
        return "", 0.0
    top = max(seen, key=lambda c: c.score)
    return _climb(top).path, top.score


def main_text(page: str, path: str | None) -> str:
    """The text in what the containers at ``path``, or the page's own best one, climb to."""
    found = blocks(page)

    def within(wanted: str) -> list[str]:
        lines = []
        for e, text, _ in found:
            if not e.boilerplate:
                line = [e]
                while line[-1].parent is not None:
                    line.append(line[-1].parent)
                lines.append((line, text))
        tops = {_climb(e) for e in {e for line, _ in lines for e in line if e.path == wanted}}
        return [text for line, text in lines if not tops.isdisjoint(line)]

    kept = within(path) if path else []
    if not kept:
        own = best_path(found)[0]
        kept = within(own) if own else [t for e, t, _ in found if not e.boilerplate]
    return " ".join(kept)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, winner): the path that most pages of a host vote for.

    Ties go to the higher score, then to the later path in order of characters.
    """
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = [best_path(blocks(p or "")) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([b[0] for b in best], pa.string()),
                 pa.array([round(b[1]) for b in best], pa.int64())],
                names=["host", "path", "score"])

    host, _ = host_and_path(F.col("url"))
    votes = (pages.select(host.alias("host"), "html")
             .mapInArrow(vote, "host string, path string, score long").where("path <> ''")
             .groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("score").alias("score")))
    return (votes.groupBy("host").agg(F.max(F.struct("n", "score", "path")).alias("top"))
            .select("host", F.col("top.path").alias("winner")))


def extract(pages: DataFrame) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, url, text, n_chars.

    A null or empty page has the text ''. A null url counts as host ''. The winners are
    written first. If they measure at most BROADCAST_BYTES they are broadcast and no page
    is shuffled; else pages meet them by host and salt.
    """
    winners = written(host_paths(pages), "winners")
    size = winners.agg(F.sum(F.octet_length("host") + F.octet_length("winner") + 64)).first()[0]
    host, _ = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", "html").withColumn("host", host)
    if (size or 0) <= BROADCAST_BYTES:
        rows = rows.join(F.broadcast(winners), "host", "left")
    else:
        each = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
        rows = rows.join(winners.withColumn("salt", each), ["host", "salt"], "left")
    rows = rows.select("page_id", "url", "html", "winner")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "", w) for p, w in
                     zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(read, T.StructType(
        [rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType()),
         T.StructField("n_chars", T.LongType())]))
