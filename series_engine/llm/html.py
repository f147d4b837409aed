"""Main text of web pages by nearest-URL page differencing.

A page is read into lines (its blocks of text).  Elements that HTML itself or
their names mark as something other than the article (navigation, headers,
footers, asides, forms, notices, adverts, comments, hidden parts) give no
lines; where a page has an ``article`` or ``main`` element, only lines inside
it count.  Pages of one host are then ordered by URL path and every page is
paired with its neighbours: the lines of the pair are aligned by longest
common subsequence, and lines that both pages have are template text and go.
Paragraphs and headings inside an article element are never taken for
template text, and a pair whose pages are copies of each other says nothing
about templates.  Pages of a host with equal lines are one page, at the first of
their paths, and lose the same lines.

The neighbours come from one global order cut into ranges, so a host with a
third of all pages is spread; only hashes of lines travel, the html is read a
second time to write the text.

Defined results: NULL html or html without an article gives ''; NULL or odd
URLs are one host with an empty name; rows with equal URL and html are one
page to their neighbours and give equal texts; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from series_engine.llm.common import cut, only, parallelism, small

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NAME_PART = re.compile(r"[a-z0-9]+")

_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noframes"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_OTHER = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "template", "svg", "canvas",
          "object", "head", "datalist", "math", "audio", "video"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt",
          "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "legend",
          "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "tfoot", "thead", "tr", "ul"}
_PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "dt", "dd", "tr", "figcaption"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
#: Words in class, id or role that mark an element as not the article.
_MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies",
          "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "nav", "navbar", "navigation", "menu",
          "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "rail", "widget", "related", "recommended",
          "share", "sharing", "social", "comment", "comments", "commentlist", "disqus", "reply", "replies", "discussion", "responses",
          "newsletter", "subscribe", "subscription", "signup", "login", "search", "pagination", "pager", "copyright", "disclaimer",
          "toolbar", "complementary", "contentinfo", "banners", "teaser", "teasers"}
#: Words that outweigh a mark which only says what stands beside the text.
_BODY_MARKS = {"content", "main", "article", "entry", "story", "post"}
_BESIDE = {"sidebar", "header", "footer", "nav", "menu", "share", "social", "widget"}


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(text)}


def _not_article(tag: str, attrs: str) -> bool:
    if tag in _OTHER:
        return True
    if tag in ("html", "body", "main") or not attrs.strip():
        return False
    a = _attributes(attrs)
    if "hidden" in a or a.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", a.get("style", "")):
        return True
    names = set(_NAME_PART.findall(" ".join(a.get(k, "") for k in ("class", "id", "role")).lower()))
    marks = names & _MARKS
    return bool(marks) and not (names & _BODY_MARKS and marks <= _BESIDE)


def lines_of(page: str | None) -> list[tuple[str, bool]]:
    """The page's lines outside other elements, in order, each with whether it
    is article prose; lines inside ``article``/``main`` alone if there are any."""
    page = page or ""
    open_tags: list[tuple[str, bool, bool]] = []  # tag, dropped, inside article
    found: list[tuple[str, bool, bool]] = []  # line, inside article, prose
    part: list[str] = []

    def state() -> tuple[bool, bool]:
        return open_tags[-1][1:] if open_tags else (False, False)

    def flush() -> None:
        line = " ".join(html.unescape("".join(part)).split())
        part.clear()
        if line:
            inside = state()[1]
            found.append((line, inside, inside and any(t[0] in _PROSE for t in open_tags)))

    at = 0
    while m := _TOKEN.match(page, at):
        at, kind = m.end(), m.groupdict()
        tag = (kind["tag"] or "").lower()
        dropped, inside = state()
        if not tag:
            if kind["text"] and not dropped:
                part.append(kind["text"])
        elif kind["end"]:
            if tag in _BLOCK:
                flush()
            for i in range(len(open_tags) - 1, -1, -1):
                if open_tags[i][0] == tag:
                    del open_tags[i:]
                    break
        elif tag in _RAW:
            close = re.compile(f"</{tag}", re.I).search(page, at)
            at = close.start() if close else len(page)
            open_tags.append((tag, True, inside))
        elif tag in _VOID:
            if tag == "hr":
                flush()
            elif tag == "br":
                part.append(" ")
        else:
            if tag in _BLOCK:
                flush()
                if tag == "p" and any(t[0] == "p" for t in open_tags):  # a paragraph ends the one before
                    i = max(i for i, t in enumerate(open_tags) if t[0] == "p")
                    if not any(t[0] in _BLOCK for t in open_tags[i + 1:]):
                        del open_tags[i:]
                dropped, inside = state()
            elif tag in ("td", "th"):
                part.append(" ")
            container = tag in ("article", "main")
            heading = tag in _HEADINGS and inside and bool(open_tags) and open_tags[-1][0] == "header"
            drop = not heading and (dropped or _not_article(tag, kind["attrs"]))
            if not kind["attrs"].endswith("/"):
                open_tags.append((tag, drop, (inside or container) and not drop))
    flush()
    if any(inside for _, inside, _ in found):
        return [(line, prose) for line, inside, prose in found if inside]
    return [(line, False) for line, _, _ in found]


def shared(a: list[int], b: list[int]) -> list[int]:
    """Indexes of ``a`` in a longest common subsequence with ``b``.

    Equal ends are paired first; the rest is the bit-vector recurrence, one
    long integer per line of ``a``, walked back from its end."""
    n = min(len(a), len(b))
    head = next((i for i in range(n) if a[i] != b[i]), n)
    tail = next((i for i in range(n - head) if a[-1 - i] != b[-1 - i]), n - head)
    out = [*range(head), *range(len(a) - tail, len(a))]
    a, b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not a or not b:
        return out
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    whole = (1 << len(b)) - 1
    row, rows = whole, []
    for x in a:
        hit = row & places.get(x, 0)
        row = ((row + hit) | (row - hit)) & whole
        rows.append(row)
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if not i or rows[i - 1] >> (j - 1) & 1:
                j -= 1
                out.append(head + i)
    return sorted(out)


def template_lines(lines: list[int], prose: list[bool], size: list[int], other: list[int], copies: float = 0.9) -> set[int]:
    """Indexes of lines that the page shares with its neighbour's template."""
    both = shared(lines, other)
    if sum(size[i] for i in both) >= copies * sum(size):
        return set()
    return {i for i in both if not prose[i]}


def _hash(line: str) -> int:
    return int.from_bytes(blake2b(line.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_URL = re.compile(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)")


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        out = {k: [] for k in ("host", "path", "lines", "prose", "size")}
        for url, page in zip(b.column("_url").to_pylist(), b.column("_html").to_pylist(), strict=True):
            m = _URL.match(url or "")
            found = lines_of(page)
            for k, v in zip(out, (m[1].lower() if m else "", m[2] if m else (url or ""), [_hash(x) for x, _ in found],
                                  [p for _, p in found], [len(x) for x, _ in found]), strict=True):
                out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [b.column("_key"), pa.array(out["host"]), pa.array(out["path"]), pa.array(out["lines"], pa.list_(pa.int64())),
             pa.array(out["prose"], pa.list_(pa.bool_())), pa.array(out["size"], pa.list_(pa.int64()))],
            names=["_key", "_host", "_path", "_lines", "_prose", "_size"])


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keys, drops = [], []
        for key, lines, prose, size, *near in zip(*(b.column(c).to_pylist() for c in ("_key", "_lines", "_prose", "_size", "_prev", "_next")), strict=True):
            gone = set().union(*(template_lines(lines, prose, size, x) for x in near if x))
            if gone:
                keys.append(key)
                drops.append(sorted(gone))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(drops, pa.list_(pa.int32()))], names=["_key", "_drop"])


def neighbours(profiles: DataFrame) -> DataFrame:
    """Each page with the lines of the pages before and after it by path on its host."""
    order = ["_host", "_path", "_key"]
    dealt = cut(profiles.repartitionByRange(parallelism(profiles), *order).withColumn("_range", F.spark_partition_id()), "html-order")
    page = F.struct("_host", "_lines")
    ends = dealt.groupBy("_range").agg(F.min_by(page, F.struct(*order)).alias("_low"), F.max_by(page, F.struct(*order)).alias("_high"))
    across = Window.orderBy("_range")  # one row per range
    ends = ends.select("_range", F.lag("_high").over(across).alias("_before"), F.lead("_low").over(across).alias("_after"))
    inside = Window.partitionBy("_range").orderBy(*order)
    near = dealt.withColumn("_p", F.lag(page).over(inside)).withColumn("_n", F.lead(page).over(inside))
    near = near.join(small(cut(ends, "html-ends")), "_range").select(
        "*", F.coalesce("_p", "_before").alias("_pp"), F.coalesce("_n", "_after").alias("_nn"))
    return near.select("_key", "_lines", "_prose", "_size",
                       F.when(F.col("_pp._host") == F.col("_host"), F.col("_pp._lines")).alias("_prev"),
                       F.when(F.col("_nn._host") == F.col("_host"), F.col("_nn._lines")).alias("_next"))


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    types = dict(pages.dtypes)
    t = only(pages, id_col, url_col, html_col).select(
        F.col(f"`{id_col}`").alias("_id"), F.col(f"`{url_col}`").alias("_url"), F.col(f"`{html_col}`").alias("_html"),
        F.xxhash64(F.col(f"`{url_col}`"), F.col(f"`{html_col}`")).alias("_key"))
    profiles = t.select("_key", "_url", "_html").mapInArrow(
        _profiles, "_key long, _host string, _path string, _lines array<long>, _prose array<boolean>, _size array<long>")
    profiles = cut(profiles.withColumn("_same", F.xxhash64("_host", "_lines", "_prose")), "html-lines")
    placed = profiles.select("_key", "_same", "_path").distinct()
    chosen = placed.groupBy("_same").agg(F.min(F.struct("_path", "_key")).alias("_f")).select("_same", F.col("_f._key").alias("_key"))
    chosen = cut(chosen, "html-chosen")
    near = neighbours(profiles.join(chosen.select("_key"), "_key", "left_semi").dropDuplicates(["_key"]))
    drops = cut(near.mapInArrow(_differences, "_key long, _drop array<int>"), "html-drops").join(chosen, "_key").select("_same", "_drop")
    drops = small(cut(placed.join(small(drops), "_same").select("_key", "_drop"), "html-drops"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for page, drop in zip(b.column("_html").to_pylist(), b.column("_drop").to_pylist(), strict=True):
                gone = set(drop or ())
                texts.append("\n".join(x for i, (x, _) in enumerate(lines_of(page)) if i not in gone))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_url"), pa.array(texts, pa.string()),
                                              pa.array([len(x) for x in texts], pa.int64())], names=["_id", "_url", "text", "n_chars"])

    out = t.join(drops, "_key", "left").select("_id", "_url", "_html", "_drop").mapInArrow(
        write, f"_id {types[id_col]}, _url {types[url_col]}, text string, n_chars long")
    return out.withColumnsRenamed({"_id": id_col, "_url": url_col})
