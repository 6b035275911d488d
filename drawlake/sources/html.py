"""HTML page sets to table rows (O6) and fetch manifests.

Pages are rows of a ``(page_id, url, html)`` table, so parsing is a Spark
job: ``mapInArrow`` hands each task Arrow batches of pages and the small
parser below (stdlib ``html.parser``) turns one page into its draw rows.
Link lists, whose markup is regular, stay JVM-side with ``regexp_extract_all``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.session import ship_package

# Fixed values of the scraped page layout: the results table sits in a
# div with class "table-responsive"; header names (trimmed, lower-cased)
# "draw date", "jackpot", "winners"; number spans carry these classes.
TABLE_CONTAINER_CLASS = "table-responsive"
REQUIRED_HEADERS = ("draw date", "jackpot", "winners")
MAIN_SPAN_CLASS = "ball-euromillions"
STAR_SPAN_CLASS = "ball-euromillions-lucky-star"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
         "source", "track", "wbr"}
# Elements whose end tag may be left out: an opening tag of the first set ends an open one
# of the second, unless an element of the third lies between.
_IMPLIED_END = {
    "p": ({"p"}, {"table", "td", "th", "div", "li"}),
    "li": ({"li", "p"}, {"ul", "ol"}),
    "tr": ({"tr", "td", "th", "p"}, {"table"}),
    "td": ({"td", "th", "p"}, {"table", "tr"}),
    "th": ({"td", "th", "p"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tr", "td", "th", "p"}, {"table"}),
    "thead": ({"thead", "tbody", "tr", "td", "th", "p"}, {"table"}),
}
# Deeper open elements are closed: no real page nests so far.
_MAX_DEPTH = 512

MAIN_NUMBERS, STAR_NUMBERS = 5, 2


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent", "depth")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent
        self.depth = parent.depth + 1 if parent else 0

    @property
    def classes(self) -> set[str]:
        return set((self.attrs.get("class") or "").split())

    def walk(self):
        """Everything below this node in page order, nodes and texts, without recursion."""
        todo = list(reversed(self.children))
        while todo:
            c = todo.pop()
            yield c
            if isinstance(c, _Node):
                todo.extend(reversed(c.children))

    def text(self) -> str:
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return self.children[0]
        return "".join(c for c in self.walk() if isinstance(c, str))

    def nodes(self):
        """The nodes of :meth:`walk` alone."""
        todo = [c for c in reversed(self.children) if isinstance(c, _Node)]
        while todo:
            n = todo.pop()
            yield n
            if n.children:
                todo += [c for c in reversed(n.children) if isinstance(c, _Node)]

    def find(self, tag: str, cls: str | None = None):
        return (n for n in self.nodes() if n.tag == tag and (cls is None or cls in n.classes))

    def find_all(self, tag: str, cls: str | None = None):
        return list(self.find(tag, cls))

    def first(self, tag: str, cls: str | None = None):
        return next(self.find(tag, cls), None)


class _TreeBuilder(HTMLParser):
    """Lenient tree builder: adds left-out end tags, closes the nearest open element of a tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        if tag in _IMPLIED_END:
            ends, within = _IMPLIED_END[tag]
            n = self.cur
            while n.parent is not None and n.tag not in within:
                if n.tag in ends:
                    self.cur = n.parent
                n = n.parent
        node = _Node(tag, {k: (v or "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in _VOID and node.depth < _MAX_DEPTH:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse_draw_table(html: str | None) -> tuple[str | None, list[dict]]:
    """One page to ``(skip_reason, rows)``.

    The first ``table`` inside the first ``div.table-responsive``; its first
    ``thead tr`` gives the column map; each ``tbody tr`` with enough cells
    gives date, jackpot, winners and the main/star span texts. Pages that
    cannot be parsed, or have no table, no header or not every required
    header, are skipped with a reason; rows without 5 main and 2 star numbers
    carry a reason of their own.
    """
    try:
        return _parse_draw_table(html)
    except Exception as e:  # a page may be anything: say why and go on with the next
        return f"unparsable page: {e}", []


#: A tag that every parser reads alike: a plain name, quoted attributes without references, no slash at the end.
_PLAIN_TAG = re.compile(r'<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\r\n]+[a-zA-Z][a-zA-Z0-9-]*="[^"<>&]*")*)[ \t\r\n]*>')
_PLAIN_ATTR = re.compile(r'([a-zA-Z][a-zA-Z0-9-]*)="([^"]*)"')
#: Elements whose content ``html.parser`` reads in a mode of its own.
_OWN_MODE = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}


def _fed_plain(b: _TreeBuilder, html: str) -> bool:
    """Feed a page of plain tags and text alone, as ``html.parser`` would; False (nothing fed) for any other page."""
    pieces = _PLAIN_TAG.split(html)
    texts, slashes, names, attrs = pieces[::4], pieces[1::4], [n.lower() for n in pieces[2::4]], pieces[3::4]
    if "<" in "".join(texts) or not _OWN_MODE.isdisjoint(names) or any(s and a for s, a in zip(slashes, attrs, strict=True)):
        return False
    if texts[0]:
        b.handle_data(unescape(texts[0]))
    for slash, name, attr, text in zip(slashes, names, attrs, texts[1:], strict=True):
        if slash:
            b.handle_endtag(name)
        else:
            b.handle_starttag(name, [(k.lower(), v) for k, v in _PLAIN_ATTR.findall(attr)] if attr else ())
        if text:
            b.handle_data(unescape(text))
    return True


def _parse_draw_table(html: str | None) -> tuple[str | None, list[dict]]:
    b = _TreeBuilder()
    if not _fed_plain(b, html or ""):
        b.feed(html or "")
        b.close()
    box = b.root.first("div", TABLE_CONTAINER_CLASS)
    table = box.first("table") if box is not None else None
    if table is None:
        return "no results table", []
    thead = table.first("thead")
    head = thead.first("tr") if thead is not None else None
    if head is None:
        return "no table header", []
    headers = [th.text().strip().lower() for th in head.find_all("th")]
    missing = [h for h in REQUIRED_HEADERS if h not in headers]
    if missing:
        return f"missing header {missing[0]!r}", []
    idx = {h: headers.index(h) for h in REQUIRED_HEADERS}
    rows = []
    body_rows = [tr for tb in table.find_all("tbody") for tr in tb.find_all("tr")]
    for i, tr in enumerate(body_rows):
        inside = list(tr.nodes())
        cells = [n for n in inside if n.tag == "td"]
        if len(cells) <= max(idx.values()):
            rows.append({"row_idx": i, "reason": "short row"})
            continue
        spans = [(n, n.classes) for n in inside if n.tag == "span"]
        balls = [n.text().strip() for n, classes in spans if MAIN_SPAN_CLASS in classes]
        stars = [n.text().strip() for n, classes in spans if STAR_SPAN_CLASS in classes]
        reason = None
        if not balls or not stars:
            reason = "no numbers"
        elif (len(balls), len(stars)) != (MAIN_NUMBERS, STAR_NUMBERS):
            reason = f"expected {MAIN_NUMBERS} + {STAR_NUMBERS} numbers, found {len(balls)} + {len(stars)}"
        rows.append({"row_idx": i, "draw_date": cells[idx["draw date"]].text().strip(),
                     "jackpot": cells[idx["jackpot"]].text().strip(),
                     "winners": cells[idx["winners"]].text().strip(), "balls": balls, "stars": stars,
                     "reason": reason})
    return None, rows


SCRAPED_ROW_SCHEMA = (
    "page_id long, row_idx int, draw_date string, "
    + ", ".join(f"ball_{i} string" for i in range(1, 6)) + ", "
    + ", ".join(f"lucky_star_{i} string" for i in range(1, 3))
    + ", jackpot string, winners string, _reason string"
)


_COLUMNS = (["page_id", "row_idx", "draw_date"] + [f"ball_{i}" for i in range(1, MAIN_NUMBERS + 1)]
            + [f"lucky_star_{i}" for i in range(1, STAR_NUMBERS + 1)] + ["jackpot", "winners", "_reason"])


def _filled(values: list | None, n: int) -> list:
    """Exactly n entries; a row with more numbers than columns has a reason, and its surplus is counted there."""
    return [*(values or ())[:n], *[None] * (n - len(values or ()))]


def _pages_to_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int32(), *[pa.string()] * (len(_COLUMNS) - 2)]
    for batch in batches:
        out = []
        for pid, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            reason, rows = ("no results table", []) if html is None else parse_draw_table(html)
            if reason is not None:
                out.append((pid, *[None] * (len(_COLUMNS) - 2), reason))
            out += [(pid, r["row_idx"], r.get("draw_date"), *_filled(r.get("balls"), MAIN_NUMBERS),
                     *_filled(r.get("stars"), STAR_NUMBERS), r.get("jackpot"), r.get("winners"), r["reason"]) for r in rows]
        columns = list(zip(*out, strict=True)) if out else [()] * len(_COLUMNS)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_COLUMNS)


def html_table_rows(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Scraped draw rows (all text) from every page, with ``_reason`` for skips.

    Good rows have a null ``_reason``; skipped pages yield one row with a
    reason and no data, so nothing disappears silently. Pages whose text
    does not even contain the container class name are answered without
    parsing, and their text is not sent to the Python workers (``no results
    table``); the rest go through the parser in Arrow batches. The pages are
    read, and built if they are derived, once.
    """
    ship_package(pages.sparkSession)
    html = F.col(html_col)
    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.when(F.instr(html, TABLE_CONTAINER_CLASS) > 0, html).alias("html"))
            .mapInArrow(_pages_to_rows, SCRAPED_ROW_SCHEMA))


def scraped_rows_to_draws(rows: DataFrame) -> DataFrame:
    """Good scraped rows to the draw shape: date parsed from ``d MMM yyyy``."""
    from drawlake.functions.dates import D_MON_Y, parse_date
    return (rows.where(F.col("_reason").isNull())
                .select(parse_date("draw_date", D_MON_Y).alias("draw_date"),
                        *[F.col(f"ball_{i}") for i in range(1, 6)],
                        F.col("lucky_star_1"), F.col("lucky_star_2"), "jackpot", "winners"))


LINK_PATTERN = r'<li><a href="([^"]*)">'


def nav_links(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``page_id, link_idx, href`` for every list-item anchor, in page order (JVM-side regex)."""
    links = F.regexp_extract_all(F.col(html_col), F.lit(LINK_PATTERN), 1)
    return pages.select(id_col, F.posexplode(links).alias("link_idx", "href"))


def page_manifest(pages: DataFrame, years: Sequence[int], path_template: str = "%s://%s/draw-history/year/%d/",
                  url_col: str = "url") -> DataFrame:
    """Per-year archive URLs for every site already in ``pages`` that are not yet held.

    Sites come from the page URLs; each site x year URL is formatted with
    ``format_string`` and anti-joined with the URLs already fetched.
    """
    sites = (pages.select(F.regexp_extract(url_col, r"^(\w+)://([^/?#]+)", 1).alias("scheme"),
                          F.regexp_extract(url_col, r"^(\w+)://([^/?#]+)", 2).alias("host"))
                  .where(F.col("host") != "").distinct())
    wanted = (sites.select("scheme", "host", F.explode(F.sequence(F.lit(min(years)), F.lit(max(years)))).alias("year"))
                   .where(F.col("year").isin(list(years)))
                   .withColumn("url", F.format_string(path_template, "scheme", "host", "year")))
    held = pages.select(F.col(url_col).alias("url"))
    return wanted.join(held, "url", "left_anti").select("host", "year", "url")
