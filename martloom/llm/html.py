"""Main text of web pages by differencing with the pages nearest in address.

Pages of a host are put in the order of their path; each is aligned with the one before and
the one after by the longest common subsequence of their text lines, and shared lines are
deleted: what a site repeats from page to page is not the article.  Neighbours with equal
lines are copies of one page: they count as one and are aligned with the nearest addresses of
other content.  A page of which nothing would be left keeps its lines.  Only hashes of lines
are compared, in runs of bounded length over the whole order, so a host with a third of all
pages is many runs.

Differencing alone would also delete article lines that neighbours quote, and would keep
menus and adverts that differ on every page.  So elements that are never article text (menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles, comments) are left out by
their markup before pages are aligned, and inside ``article`` or ``main`` shared lines are
evidence against their block, which is all lines under the same path of containers and classes:
a line goes if it is shared with every neighbour and most lines of its block are; in a block of
which they are the minority they are quotes, and stay.  A neighbour that shares most of the lines
inside the main element is a near copy of the article and no evidence.

Null and empty pages give an empty text.  A page without an id has no partner; rows that
repeat an id share the deleted lines.  A null address counts as an empty host and path.
"""

from __future__ import annotations

import re
from collections import Counter
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.texts import in_slices
from martloom.llm.urls import host_of, path_of
from martloom.operators.ordering import global_row_number, running_totals
from martloom.session import cut_lineage
from martloom.sizing import broadcast_if_bounded, spread_if_small

RUN = 64
_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section
summary table tbody td tfoot th thead title tr ul""".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# elements that never hold article text, and those whose content is no text at all
_CHROME = frozenset("aside button dialog footer form menu nav search select".split())
_NO_TEXT = frozenset("head iframe noscript object script style svg template textarea title".split())
# words of a class, id or role that mark such parts
_MARKED = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent contentinfo cookie
cookies disqus footer form gdpr menu modal nav navbar navigation newsletter notice notices popup promo promotion related
replies share sharing sidebar social sponsor sponsored subscribe toolbar widget""".split())
_CLOSED_BY = {"p": _BLOCK - {"li", "option"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"},
              "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
# elements that make no block of their own inside the main element: their lines belong to the container around them
_LEAF = frozenset("""address caption center dd dt figcaption h1 h2 h3 h4 h5 h6 header hgroup hr legend li p pre summary
tbody td tfoot th thead tr""".split())
_NAME_PART = re.compile(r"[a-z0-9]+")


class _Page(HTMLParser):
    """Lines of a page: ``(text, whether in the main element, whether in a part left out, block)``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, bool, bool, int]] = []
        self.open: list[tuple[str, bool, bool, bool, int]] = [("", False, False, False, 0)]  # tag, main, left out, no text, block
        self.blocks: dict[tuple[int, str, str], int] = {}  # block by the block around it, tag and class
        self.pieces: list[str] = []

    def _end_line(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        _, main, out, silent, block = self.open[-1]
        if text and not silent:
            self.lines.append((text, main, out, block))

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCK:
            self._end_line()
            last = self.open[-1][0]
            if tag in _CLOSED_BY.get(last, ()):
                self.open.pop()
            elif len(self.open) > 2 and tag == "p" and self.open[-2][0] == "p" and last not in _BLOCK:
                del self.open[-2:]  # a paragraph ends with the inline elements left open in it
        if tag in _VOID:
            if tag == "br":
                self.pieces.append(" ")
            return
        _, main, out, silent, block = self.open[-1]
        named = set(_NAME_PART.findall(" ".join(v.lower() for k, v in attrs if v and k in ("class", "id", "role"))))
        # the class of a whole page or article says what it has, not what it is; an article within one can be a comment
        whole = tag in ("html", "body", "main") or (tag == "article" and not main)
        left_out = tag in _CHROME or (tag == "header" and not main) or (not whole and bool(named & _MARKED))
        changes = tag not in _BLOCK and (tag in _NO_TEXT or left_out)
        if changes:
            self._end_line()
        if tag in _BLOCK and tag not in _LEAF:
            block = self.blocks.setdefault((block, tag, next((v for k, v in attrs if k == "class" and v), "")), len(self.blocks) + 1)
        self.open.append((tag, (main or tag in ("article", "main") or "main" in named and tag not in ("html", "body")) and not left_out,
                          out or left_out, silent or tag in _NO_TEXT, block))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i][0] == tag), 0)
        if tag in _BLOCK or (at and self.open[at][2:4] != self.open[at - 1][2:4]):
            self._end_line()
        if at:
            del self.open[at:]

    def handle_data(self, data):
        self.pieces.append(data)

    def close(self):
        super().close()
        self._end_line()


def page_lines(html: str | None) -> list[tuple[str, bool, bool, int]]:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page.lines


def _hash(line: str, main: bool = False) -> int:
    """63 bits of a line; the last tells lines inside the main element from others, so they meet only each other."""
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "replace")) >> 2 << 1 | main


def main_text(html: str | None, shared: frozenset[int] = frozenset()) -> str:
    """The text of a page, given the hashes of lines it shares with its neighbours."""
    lines = [(text, main, block) for text, main, out, block in page_lines(html) if not out]
    if any(main for _, main, _ in lines):
        inside = [(text, block, _hash(text, True) in shared) for text, main, block in lines if main]
        # different lines only, as for near copies: an article that is all one block loses none
        of_block, repeated = (Counter(block for _, block, again in set(inside) if again or every) for every in (True, False))
        found = [text for text, _, _ in inside]
        left = [text for text, block, again in inside if not again or 2 * repeated[block] <= of_block[block]]
    else:
        found = [text for text, _, _ in lines]
        left = [text for text in found if _hash(text) not in shared]
    return "\n\n".join(left or found)


def common_subsequence(a: list[int], b: list[int]) -> list[int]:
    """The longest common subsequence of two lists of line hashes."""
    both = set(a) & set(b)
    a, b = [x for x in a if x in both], [x for x in b if x in both]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i] == b[j] else max(best[i + 1][j], best[i][j + 1])
    i = j = 0
    out = []
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append(a[i])
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def shared_lines(pages: DataFrame, run: int = RUN) -> DataFrame:
    """``page_id, shared``: hashes of the lines that a page shares with a neighbour; inside the main element, with each neighbour.

    Lines left out by their markup take no part: adverts that differ make no other page of a copy.
    """
    @F.arrow_udf("array<bigint>")
    def hashes(pages_html: pa.Array) -> pa.Array:
        return pa.array([[_hash(text, main) for text, main, out, _ in page_lines(h) if not out] for h in in_slices(pages_html)], pa.list_(pa.int64()))

    lines = cut_lineage(pages.filter("page_id IS NOT NULL").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), hashes("html").alias("lines")))
    lines = lines.withColumn("digest", F.md5(F.array_join(F.col("lines").cast("array<string>"), ",")))
    ordered = cut_lineage(global_row_number(lines, [F.col("host"), F.col("path"), F.col("page_id")], "row"))
    # copies in a row have one place: the number of pages up to them that differ from the page before
    content = ordered.select("row", "page_id", F.struct("host", "digest").alias("content"))
    before = content.select((F.col("row") + 1).alias("row"), F.col("content").alias("last"))
    first = (~F.col("content").eqNullSafe(F.col("last"))).cast("bigint")
    members = cut_lineage(running_totals(content.join(before, "row", "left").select("row", "page_id", first.alias("first")),
                                         [F.col("row")], {"place": F.col("first")}).select("row", "page_id", "first", "place"))
    placed = ordered.select("row", "host", "lines").join(members.filter("first = 1").select("row", "place"), "row")
    # the pages next to a run stand in it as well, so a page has both neighbours in its own run
    number = F.floor(F.col("place") / run)
    runs = F.array_distinct(F.array(number, F.floor((F.col("place") + 1) / run), F.floor((F.col("place") - 1) / run)))

    def align(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["place"])
        shared: list[set[int]] = [set() for _ in rows]
        evidence: list[list[set[int]]] = [[] for _ in rows]  # lines inside the main element, by neighbour
        for at, (a, b) in enumerate(zip(rows, rows[1:])):
            if a["host"] == b["host"]:
                common = set(common_subsequence(a["lines"], b["lines"]))
                inside = {line for line in common if line & 1}
                near_copy = 2 * len(inside) > min(len({line for line in r["lines"] if line & 1}) for r in (a, b))
                for place in (at, at + 1):
                    shared[place].update(common - inside)
                    evidence[place] += [] if near_copy else [inside]
        found = [(r["place"], sorted(s.union(set.intersection(*e) if e else ()))) for r, s, e in zip(rows, shared, evidence)
                 if r["place"] // run == r["run"]]
        return pa.table({"place": pa.array([p for p, _ in found], pa.int64()), "shared": pa.array([s for _, s in found], pa.list_(pa.int64()))})

    found = (placed.withColumn("run", F.explode(runs)).groupBy("run").applyInArrow(align, "place bigint, shared array<bigint>")
             .filter(F.size("shared") > 0))
    return members.select("place", "page_id").join(found, "place").groupBy("page_id").agg(F.array_distinct(F.flatten(F.collect_list("shared"))).alias("shared"))


def extract_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""
    @F.arrow_udf("string")
    def text(pages_html: pa.Array, shared: pa.Array) -> pa.Array:
        return pa.array([main_text(h, frozenset(s or ())) for h, s in zip(in_slices(pages_html), in_slices(shared))], pa.string())
    shared = broadcast_if_bounded(cut_lineage(shared_lines(pages)))  # within its bounds the pages stay where they are
    rows = spread_if_small(pages.select("page_id", "url", "html")).join(shared, "page_id", "left")
    return (rows.select("page_id", "url", text("html", "shared").alias("text"))
            .withColumn("n_chars", F.length("text").cast("bigint")))
