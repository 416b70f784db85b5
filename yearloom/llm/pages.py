"""Main text of web pages: site templates are found by counting element subtrees per host.

Each page is read once.  Elements are hashed from the leaves up (name and text, not
attributes), and Spark counts on how many different pages of its host each subtree stands.
Subtrees that recur there are deleted.  Recurrence alone cannot decide: articles are copied
and quoted within a site, and rare menus occur once.  So an article's own subtrees are never
deleted for recurring, and elements that say what they are (nav, footer, class "ad", ..) go
wherever they are.

Texts do not travel: they lie in one table as pieces between element borders, with the
subtrees each piece is in.  What is deleted comes back as a file for each part of that table.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yearloom.llm import shared
from yearloom.llm.text import blocks

#: A subtree is a template if it stands on so many different pages of its host, and on this share of them.
LEAST_PAGES, LEAST_SHARE = 10, 0.01

#: Pages put together at once.
TOGETHER = 500

# --- fixed values: names of the HTML standard -------------------------------------
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes".split())
IN_HEAD = set("title meta link style script base template noscript".split())
INLINE = set("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby
s samp small span strike strong sub sup time tt u var wbr""".split())
#: These break no line either, but may hold blocks.
UNBROKEN = INLINE | set("script style template noscript svg math iframe video audio canvas object button select input".split())
#: An open element of the value's names ends where one of the key's names begins.
ENDED_BY = {**dict.fromkeys(["li"], {"li"}), **dict.fromkeys(["dt", "dd"], {"dt", "dd"}), "tr": {"tr", "td", "th"},
            **dict.fromkeys(["td", "th"], {"td", "th"}), **dict.fromkeys(["option", "optgroup"], {"option"}),
            **dict.fromkeys(["thead", "tbody", "tfoot"], {"thead", "tbody", "tfoot", "tr", "td", "th"})}
#: End tags do not reach through these (those of list items, not through lists either).
SCOPES = set("table td th caption object".split())
TABLE_PARTS = SCOPES | {"tbody", "thead", "tfoot", "tr"}
LISTS = {"ul", "ol", "dl"}
NOT_TEXT = set("""script style template noscript iframe noembed noframes textarea select option button input form nav
footer aside svg math canvas video audio object map dialog menu head title datalist""".split())
ROLES = set("""navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar
form status tooltip""".split())
#: Words of class and id that name what is no part of an article.
WORDS = set("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie
cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar breadcrumb
breadcrumbs menu nav navbar navigation footer masthead comment comments disqus respond replies related recommended
share sharing social widget pagination pager toolbar skip""".split())
#: Those that hold for an article element itself, whose class often names its parts.
ARTICLE_WORDS = set("ad ads advert advertisement comment comments promo sponsored related recommended teaser".split())
# ----------------------------------------------------------------------------------

_TAG = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^\"'>=]++|=\s*+(?:\"[^\"]*\"|'[^']*')?+|[\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_HOST = re.compile(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)")

_NONE, _MAIN, _ARTICLE = range(3)
_RAW_ENDS = {name: re.compile(rf"</{name}(?=[\s/>])", re.I) for name in RAW}


def host_of(url: str | None) -> str | None:
    found = _HOST.match(url or "")
    return found[1].lower() if found else None


def _says(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element's attributes say that it is no article text, and whether that it is the main part."""
    main = other = False
    if attributes and not attributes.isspace():
        for key, *values in _ATTRIBUTE.findall(attributes):
            key, value = key.lower(), "".join(values)
            if key in ("class", "id"):
                words = set(_WORD.findall(_CAMEL.sub(" ", value).lower()))
                other |= bool(words & (ARTICLE_WORDS if name == "article" else WORDS)) or {"side", "bar"} <= words
            elif key == "role":
                roles = set(value.lower().split())
                other |= bool(roles & ROLES)
                main |= "main" in roles
            elif key == "itemprop":
                main |= "articlebody" in value.lower().split()
            elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
                other = True
            elif key == "style":
                other |= "display:none" in re.sub(r"\s+", "", value.lower())
    return other, main or name == "main"


class _Open:
    """An open element: its number among the counted ones, its part of the page, whether it is or may be
    no article text, and the running hash of its subtree."""

    __slots__ = ("doubt", "name", "number", "other", "part", "running")

    def __init__(self, name: str, number: int, part: int, other: bool, doubt: bool, running):
        self.name, self.number, self.part, self.other, self.doubt, self.running = name, number, part, other, doubt, running


class Page:
    """One page's elements outside articles, and its text in pieces.

    Tags close as the HTML standard has it, as far as it matters for what text is in what
    element.  An element whose class or role names another purpose is in doubt while articles
    may be inside it: many a frame is called after its side bar.
    """

    def __init__(self, text: str):
        #: Per counted element: hash of its subtree, the element around it (-1: none), whether an article is inside.
        self.subtrees: list[int] = []
        self.around: list[int] = []
        self.holds_article: list[bool] = []
        #: Per piece: texts, whether a block border lies before it, innermost counted element, part, other, doubt.
        self.pieces: list[tuple[list[str], bool, int, int, bool, bool]] = []
        self.stack: list[_Open] = []
        self.open: dict[str, int] = {}
        self.border = True
        self._read(text)

    def _read(self, text: str) -> None:
        at, end = 0, len(text)
        while at < end:
            mark = text.find("<", at)
            if mark < 0:
                mark = end
            if mark > at:
                self._text(text[at:mark])
            tag = _TAG.match(text, mark) if mark < end else None
            if tag is None:
                if mark < end:
                    self._text("<")
                at = mark + 1
                continue
            at = tag.end()
            if tag[2] is None:
                continue
            name = tag[2].lower()
            if tag[1]:
                self._end(name)
            else:
                self._start(name, tag[3])
                if name in _RAW_ENDS:
                    close = _RAW_ENDS[name].search(text, at)
                    at = close.start() if close else end
        while self.stack:
            self._pop()

    def _start(self, name: str, attributes: str) -> None:
        if self.open.get("head") and name not in IN_HEAD:
            self._pop_to("head")
        if name in ("html", "body"):
            return
        if name not in UNBROKEN:
            self.border = True
            self._end_implied(ENDED_BY.get(name, ()))
        if name in VOID:
            return
        around = self.stack[-1] if self.stack else _Open("", -1, _NONE, False, False, None)
        says_other, says_main = _says(name, attributes)
        part, number, running = around.part, around.number, None
        other, doubt = around.other or name in NOT_TEXT or (name == "header" and around.part == _NONE), around.doubt
        if says_other and (part == _ARTICLE or name == "article"):
            other = True
        elif says_other:
            doubt = True
        if not other and name == "article":
            part = _ARTICLE
            if around.part != _ARTICLE and not doubt:
                self._article_in(number)
        elif not other and says_main:
            part = max(part, _MAIN)
        if part != _ARTICLE:
            self.subtrees.append(0)
            self.around.append(number)
            self.holds_article.append(False)
            number, running = len(self.subtrees) - 1, xxhash.xxh3_64(name.encode())
        self.stack.append(_Open(name, number, part, other, doubt, running))
        self.open[name] = self.open.get(name, 0) + 1

    def _end_implied(self, ended) -> None:
        """Closes an open paragraph, and elements of the names ``ended``, that a block's start ends."""
        while True:
            block = next((e.name for e in reversed(self.stack) if e.name not in INLINE), None)
            if block is None or (block != "p" and block not in ended):
                return
            self._pop_to(block)

    def _article_in(self, number: int) -> None:
        while number >= 0 and not self.holds_article[number]:
            self.holds_article[number] = True
            number = self.around[number]

    def _end(self, name: str) -> None:
        self.border |= name in ("p", "br")
        if not self.open.get(name):
            return
        self.border |= name not in UNBROKEN
        for entry in reversed(self.stack):
            if entry.name == name:
                self._pop_to(name)
                return
            if (entry.name in SCOPES and name not in TABLE_PARTS or name == "li" and entry.name in LISTS
                    or name in INLINE and entry.name not in INLINE):
                return

    def _pop_to(self, name: str) -> None:
        while self.stack and self._pop() != name:
            pass

    def _pop(self) -> str:
        entry = self.stack.pop()
        self.open[entry.name] -= 1
        if entry.running is not None:
            value = entry.running.intdigest()
            self.subtrees[entry.number] = value & (2**63 - 1)
            if self.stack and self.stack[-1].running is not None:
                self.stack[-1].running.update(value.to_bytes(8, "little"))
        return entry.name

    def _text(self, raw: str) -> None:
        top = self.stack[-1] if self.stack else _Open("", -1, _NONE, False, False, None)
        text = html.unescape(raw) if "&" in raw else raw
        spaced = " ".join(text.split())
        if not spaced:
            if self.border or not self.pieces:
                return
            spaced = " "
        else:
            if top.running is not None:
                top.running.update(spaced.encode("utf-8", "surrogatepass") + b"\0")
            spaced = " " * text[0].isspace() + spaced + " " * text[-1].isspace()
        place = (-1 if top.part == _ARTICLE else top.number, top.part, top.other, top.doubt)
        if self.pieces and self.pieces[-1][2:] == place:
            self.pieces[-1][0].append(" " * self.border + spaced)
        else:
            self.pieces.append(([spaced], self.border, *place))
        self.border = False

    def parts(self) -> tuple[list[int], list[int], list[tuple[str, bool, int, bool, int]]]:
        """Hashes of the subtrees with text and without an article, the place of the one around each, and
        the pieces: text, border, part, other and the place of the innermost subtree; -1 stands for none."""
        sure = any(part >= _MAIN and not other and not doubt for _, _, _, part, other, doubt in self.pieces)
        used = set()
        for _, _, number, *_ in self.pieces:
            while number >= 0 and number not in used and not self.holds_article[number]:
                used.add(number)
                number = self.around[number]
        order = sorted(used)
        place = {number: i for i, number in enumerate(order)}
        found = [("".join(texts), border, part, other or (doubt and (sure or part < _MAIN)), place.get(number, -1))
                 for texts, border, number, part, other, doubt in self.pieces]
        return [self.subtrees[n] for n in order], [place.get(self.around[n], -1) for n in order], found


_PIECE = pa.struct([("text", pa.string()), ("border", pa.bool_()), ("part", pa.int8()), ("other", pa.bool_()),
                    ("inside", pa.int32())])
_PARSED = ("page_id {page_id}, url {url}, host long, digest long, subtrees array<long>, around array<int>, "
           "pieces array<struct<text: string, border: boolean, part: tinyint, other: boolean, inside: int>>")


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in blocks(batches, "html"):
        hosts, digests, subtrees, around, pieces = [], [], [], [], []
        for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            own, above, found = Page(source or "").parts()
            host = host_of(url)
            hosts.append(None if host is None else xxhash.xxh3_64_intdigest(host.encode("utf-8", "surrogatepass")) & (2**63 - 1))
            seen = xxhash.xxh3_64()
            for text, *_ in found:
                seen.update(text.encode("utf-8", "surrogatepass") + b"\0")
            digests.append(seen.intdigest() & (2**63 - 1))
            subtrees.append(own)
            around.append(above)
            pieces.append(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(hosts, pa.int64()), pa.array(digests, pa.int64()),
             pa.array(subtrees, pa.list_(pa.int64())), pa.array(around, pa.list_(pa.int32())), pa.array(pieces, pa.list_(_PIECE))],
            names=["page_id", "url", "host", "digest", "subtrees", "around", "pieces"])


def parsed(pages: DataFrame) -> DataFrame:
    """The pages in pieces, stored, with a number that is fixed by its place in the table."""
    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    read = pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(_parsed, _PARSED.format(**types))
    return shared.stored(read.withColumn("row", F.monotonically_increasing_id()), "pages", compression="zstd")


def templates(stored: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, subtree) hashes of the subtrees that recur; pages without a host have none.

    Pages with the same text count once, so that a copied text is not taken for a template.
    """
    known = stored.where("host is not null")
    total = known.groupBy("host").agg(F.count_distinct("digest").alias("of"))
    seen = known.select("host", "digest", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(
        F.count_distinct("digest").alias("on"))
    often = seen.where(F.col("on") >= least_pages).join(total, "host")
    return often.where(F.col("on") >= F.col("of") * least_share).select("host", "subtree")


def _write_deleted(stored: DataFrame, found: DataFrame, folder: str) -> int:
    """A file for each part of the stored table: its rows' deleted subtrees; returns their number."""

    def written(group: pa.Table) -> pa.Table:
        part = group.column("part")[0].as_py()
        group = group.sort_by([("row", "ascending"), ("at", "ascending")])
        shared.write_file(f"{folder}/{part}", [group.column(c).to_numpy().astype("<i8") for c in ("row", "at")])
        return pa.table({"n": pa.array([len(group)], pa.int64())})

    inside = stored.where("host is not null").select("row", "host", F.posexplode("subtrees").alias("at", "subtree"))
    deleted = inside.join(found, ["host", "subtree"]).select(F.shiftright("row", 33).alias("part"), "row", "at")
    return deleted.groupBy("part").applyInArrow(written, "n long").agg(F.sum("n")).first()[0] or 0


def _joined(pieces: list[dict], around: list[int], recurring: set[int]) -> str:
    """The text of the pieces that stay: in no recurring subtree, of the part that is most of an article."""
    gone = []
    for place, above in enumerate(around):  # what is around comes first
        gone.append(place in recurring or (above >= 0 and gone[above]))
    kept, border = [], False
    for piece in pieces:
        border |= piece["border"]
        if not piece["other"] and not (piece["inside"] >= 0 and gone[piece["inside"]]):
            kept.append((piece["part"], " " * border + piece["text"]))
            border = False
    best = max((part for part, text in kept if not text.isspace()), default=_NONE)
    return " ".join("".join(text for part, text in kept if part == best).split())


def extract(pages: DataFrame, least_pages: int = LEAST_PAGES, least_share: float = LEAST_SHARE) -> DataFrame:
    """Main text of each page: page_id, url, text, n_chars (code points) and n_templates, one row per row.

    Deleted are subtrees outside articles that stand on at least ``least_pages`` different
    pages of their host and on ``least_share`` of them, and elements that say to be no article
    text (n_templates counts the former).  If an article is left, the text is the articles';
    else that of the main element; else all.  Character references are decoded; white space
    inside a block and between blocks is one space.  A null or empty html has an empty text, as
    have pages without any; pages without a host are not counted.  Rows may repeat; page_id and
    url may be null.  An empty table gives an empty result; other columns are not read.
    """
    stored = parsed(pages)
    folder = shared.folder(pages.sparkSession, "templates")
    _write_deleted(stored, templates(stored, least_pages, least_share), folder)

    def deleted(rows: np.ndarray) -> list[set[int]]:
        gone: list[set[int]] = [set() for _ in rows]
        for part in np.unique(rows >> 33).tolist():
            system, path = shared.located(f"{folder}/{part}")
            if system.get_file_info(path).type.name == "File":
                row, at = shared.read_array(f"{folder}/{part}", np.int64).reshape(2, -1)
                for i in np.flatnonzero(rows >> 33 == part).tolist():
                    gone[i] = set(at[slice(*np.searchsorted(row, [rows[i], rows[i] + 1]))].tolist())
        return gone

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for first in range(0, whole.num_rows, TOGETHER):
                batch = whole.slice(first, TOGETHER)
                gone = deleted(batch.column("row").to_numpy())
                texts = pa.array([
                    _joined(p.as_py(), a.as_py(), g)
                    for p, a, g in zip(batch.column("pieces"), batch.column("around"), gone, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("page_id"), batch.column("url"), texts, pc.utf8_length(texts).cast(pa.int64()),
                     pa.array([len(g) for g in gone], pa.int64())], names=["page_id", "url", "text", "n_chars", "n_templates"])

    types = {c: pages.schema[c].dataType.simpleString() for c in ("page_id", "url")}
    return stored.select("page_id", "url", "row", "around", "pieces").mapInArrow(
        put_together, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long, n_templates long")
