"""Operators on pages: archives, main text, addresses."""

import base64
import gzip
import hashlib
import html as markup
import io
import itertools
import os
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from martloom.llm import html, urls, warc
from martloom.llm.queries import QUERIES
from martloom.llm.texts import table
from martloom.session import scratch_path

BASE = "/root/testdata/sf0.001"
PAGES = "page_id bigint, url string, html string"
ODD = [(1, "http://a.com/x", "ü<p>a"), (2, "http://a.com/y", "ü<p>a"), (3, None, None), (4, "u\n%0A%25\r", ""), (None, "http://b.com", "zz"),
       (5, "http://a.com/z", "<p>" + "long text " * 60_000), (6, "", "<<<>&&amp;<p"), (6, "", "<<<>&&amp;<p")]


@pytest.fixture(scope="module")
def odd(spark):
    pages = spark.createDataFrame(ODD, PAGES)
    for name in ("sha", "payload", "refers_to", "host", "path", "fit", "suffix", "lines", "shared", "place", "run", "text", "features", "label"):
        pages = pages.withColumn(name, F.lit(name))
    return pages


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], PAGES)


# --- archives

def test_archive_round_trip(spark, odd, none):
    folder = scratch_path(spark, "warc")
    warc.write_archives(odd, folder)
    found = warc.read_archives(spark, folder).collect()
    assert len(found) == len(ODD)
    assert sorted((str(r.page_id), str(r.target_uri)) for r in found) == sorted((str(i), str(u)) for i, u, _ in ODD)
    largest = {}
    for i, _, text in ODD:
        if i is not None:
            largest[text or ""] = max(i, largest.get(text or "", 0))
    texts = {i: (text or "").encode() for i, _, text in ODD}
    for r in found:
        payload = texts[r.page_id]
        first = largest.get(payload.decode(), r.page_id)
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        revisit = r.page_id is not None and first != r.page_id
        assert (r.record_type, r.refers_to) == (("revisit", first) if revisit else ("response", None))
        assert bytes(r.payload) == (b"" if revisit else payload)
    assert all(r.payload is None for r in warc.read_archives(spark, folder, payload=False).collect())
    empty = scratch_path(spark, "warc")
    warc.write_archives(none, empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_small_payloads_are_no_revisits(spark):
    pages = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"), (4, "d", "yyyy")], PAGES)
    rows = {r.page_id: r.refers_to for r in warc.archive_rows(pages, least_bytes=3).collect()}
    assert rows == {1: None, 2: None, 3: 4, 4: None}


def test_filters_are_decided_on_the_headers(spark, odd):
    reader = warc.WarcReader({"path": "/nowhere"})
    rest = list(reader.pushFilters([EqualTo(("record_type",), "response"), In(("page_id",), (2, 4)), GreaterThan(("page_id",), 1), EqualTo(("payload",), b"x")]))
    assert [type(f) for f in rest] == [GreaterThan, EqualTo] and reader.accepted == {"record_type": [{"response"}], "page_id": [{2, 4}]}
    folder = scratch_path(spark, "warc")
    warc.write_archives(odd, folder)
    chosen = warc.read_archives(spark, folder).filter("record_type = 'response' AND page_id IN (2, 3, 5)")
    assert "Filter isnotnull" in chosen._jdf.queryExecution().executedPlan().toString()  # nothing else is left to Spark
    assert sorted(r.page_id for r in chosen.collect()) == [2, 5]


def test_rejected_records_are_skipped_by_their_length():
    records = [warc.record_bytes(i, f"http://x/{i}", "response", None, os.urandom(50_000)) for i in range(5)]
    damaged = bytearray(records[2])
    damaged[20_000:40_000] = bytes(20_000)  # unreadable, if it were inflated
    stream = io.BytesIO(b"".join([*records[:2], bytes(damaged), *records[3:]]))
    assert [r["page_id"] for r in warc.read_records(stream, lambda f: f["page_id"] != 2)] == [0, 1, 3, 4]
    stream.seek(0)
    assert [r["payload"] for r in warc.read_records(stream, payload=False)] == [None] * 5
    stream.seek(0)
    with pytest.raises(Exception, match="decompress"):
        list(warc.read_records(stream))


def test_archives_of_other_writers():
    """Members without a stored length, and any gzip reader on ours."""
    plain = [gzip.decompress(warc.record_bytes(i, None, "response", None, b"p" * n)) for i, n in enumerate((0, 10, 300_000))]
    stream = io.BytesIO(b"".join(gzip.compress(p) for p in plain))
    assert [(r["page_id"], len(r["payload"])) for r in warc.read_records(stream)] == [(0, 0), (1, 10), (2, 300_000)]
    stream.seek(0)
    assert [r["page_id"] for r in warc.read_records(stream, lambda f: f["page_id"] == 2)] == [2]
    with pytest.raises(ValueError, match="ends within"):
        list(warc.read_records(io.BytesIO(gzip.compress(plain[2])[:-50])))


def test_unfinished_files_are_not_read(spark, none):
    folder = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame(ODD[:2], PAGES), folder)
    with open(os.path.join(folder.removeprefix("file://"), "lost.warc.gz.part"), "wb") as lost:
        lost.write(b"left by a failed attempt")
    assert warc.read_archives(spark, folder).count() == 2


# --- main text

PAGE = """<!DOCTYPE html><html class="has-sidebar"><head><title>T</title><style>p{}</style></head><body class="menu-open">
<header><p>Site name</p></header><nav><ul><li>Menu<li>Item</ul></nav><div class="cookie-notice">We use cookies</div>
<article><header><h1>Head &amp; line</h1></header><script>var t="</p>";</script><p>First&nbsp;<b>para</b>
  graph<br>goes on<p>Second<ul><li>one<li>two</ul><aside>See also</aside><div class="ad">Buy</div><form><input><p>Mail?</p></form>
<article class="comment"><p>First!</p></article></article><section id="comments"><p>Nice</p></section><footer>&copy; x</footer>"""


def test_structure_of_a_page():
    assert html.main_text(PAGE) == "Head & line\n\nFirst para graph goes on\n\nSecond\n\none\n\ntwo"
    assert html.main_text(None) == html.main_text("") == html.main_text("<p> \n </p><script>x") == ""
    assert html.main_text("a < b &lt;&#x41;&eacute;<p>c") == "a < b <Aé\n\nc"
    assert html.main_text("<div><p>one<div>two</div>three</div>") == "one\n\ntwo\n\nthree"
    assert html.main_text("x<!-- <p>no</p> -->y<br/>z") == "xy z"
    assert html.main_text("<p><b>open<br><p>next</p>") == "open\n\nnext"


def test_text_of_the_sample_is_the_article(spark):
    pages = {r.page_id: r for r in table(spark, BASE, "pages").collect()}
    found = QUERIES["op5_html_text"](spark, BASE).collect()
    assert len(found) == len(pages)
    for r in found:
        body = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S).group(1)
        blocks = [" ".join(markup.unescape(re.sub("<br>", " ", re.sub("</?b>", "", b))).split()) for b in re.split("</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_lines_shared_with_the_nearest_addresses_go(spark):
    """No main element: what neighbours of a host share, in order, is deleted; run borders make no difference."""
    def page(i, own):
        return f"<div>Welcome to the site</div><p>{own}</p><div>All rights reserved</div>"
    rows = [(i, f"http://h.com/a/{i:03d}", page(i, f"own text {i}")) for i in range(20)]
    rows += [(100, "http://alone.com/", page(100, "alone")), (101, "http://h2.com/1", "<p>same</p><p>b</p>"), (102, "http://h2.com/2", "<p>same</p><p>c</p>"),
             (103, "http://h2.com/3", "<article><p>same</p></article>"), (104, "http://h3.com/same", "<p>q</p>"), (105, "http://h3.com/same", "<p>r</p>")]
    pages = spark.createDataFrame(rows, PAGES)
    for run in (3, 64):
        shared = {r.page_id for r in html.shared_lines(pages, run).collect()}
        assert shared == {*range(20), 101, 102}
    found = {r.page_id: r.text for r in html.extract_text(pages).collect()}
    assert all(found[i] == f"own text {i}" for i in range(20))
    assert found[100] == "Welcome to the site\n\nalone\n\nAll rights reserved"
    assert (found[101], found[102], found[103], found[104], found[105]) == ("b", "c", "same", "q", "r")


def test_blocks_repeated_inside_the_main_element_go(spark):
    """A block of the article that each neighbour has goes; quoted lines, a shared headline, and near copies of articles keep theirs."""
    def page(i, quote=""):
        return (f"<nav>Menu {i}</nav><article><header><h1>Daily report</h1></header><div class='x1'><p>own {i}</p><p>more {i}</p><p>last {i}</p>{quote}</div>"
                f"<div class='x2'><p>Sign up</p><p>Never miss a story</p><p>Box {i}</p></div><p>Written by {i}</p><p>Printed {i}</p></article>")
    rows = [(i, f"http://h.com/a/{i:03d}", page(i, "<p>quoted</p>" if 3 <= i <= 6 else "")) for i in range(10)]
    near = "".join(f"<p>line {n}</p>" for n in range(9))
    rows += [(40 + i, f"http://again.com/{i}", f"<article><p>and so on</p>{'<p>and so on</p>' * 3 * i}<p>a {i}</p><p>b {i}</p></article>") for i in range(3)]
    rows += [(20 + i, f"http://near.com/{i}", f"<article><div>{near}</div><p>change {i}</p></article>") for i in range(4)]
    pages = spark.createDataFrame(rows, PAGES)
    for run in (3, 64):
        assert {r.page_id for r in html.shared_lines(pages, run).collect()} == {*range(10), 40, 41, 42}
    found = {r.page_id: r.text.split("\n\n") for r in html.extract_text(pages).collect()}
    for i in range(10):
        quote = ["quoted"] if 3 <= i <= 6 else []
        assert found[i] == ["Daily report", f"own {i}", f"more {i}", f"last {i}", *quote, f"Box {i}", f"Written by {i}", f"Printed {i}"]
    for i in range(3):
        assert found[40 + i] == [*["and so on"] * (1 + 3 * i), f"a {i}", f"b {i}"]
    for i in range(4):
        assert found[20 + i] == [*[f"line {n}" for n in range(9)], f"change {i}"]


def test_copies_at_neighbouring_addresses_keep_their_text(spark):
    """No main element: copies count as one page, and are aligned with the pages of other content around them."""
    def page(own):
        return f"<div>Welcome to the site</div><p>{own}</p><div>All rights reserved</div>"
    rows = [(1, "http://h.com/a", page("one")), (2, "http://h.com/b", page("two")), (3, "http://h.com/b?ref=x", page("two")),
            (4, "http://h.com/b?page=2", page("two")), (5, "http://h.com/c", page("two")), (6, "http://h.com/d", page("three"))]
    rows += [(20 + i, f"http://copies.com/?page={i}", page("only")) for i in range(9)]
    rows += [(40, "http://part.com/1", "<p>x</p><p>y</p>"), (41, "http://part.com/2", "<p>x</p>")]
    pages = spark.createDataFrame(rows, PAGES)
    for run in (3, 64):
        assert {r.page_id for r in html.shared_lines(pages, run).collect()} == {1, 2, 3, 4, 5, 6, 40, 41}
    found = {r.page_id: r.text for r in html.extract_text(pages).collect()}
    assert [found[i] for i in range(1, 7)] == ["one", "two", "two", "two", "two", "three"]
    assert {found[20 + i] for i in range(9)} == {"Welcome to the site\n\nonly\n\nAll rights reserved"}
    assert (found[40], found[41]) == ("y", "x")


def test_common_subsequence_brute_force():
    made = random.Random(6)
    for _ in range(200):
        a, b = ([made.randint(1, 5) for _ in range(made.randint(0, 7))] for _ in range(2))
        parts = {c for n in range(len(a) + 1) for c in itertools.combinations(a, n)}
        longest = max(len(c) for n in range(len(b) + 1) for c in itertools.combinations(b, n) if c in parts)
        found = html.common_subsequence(a, b)
        assert len(found) == longest and tuple(found) in parts and tuple(found) in set(itertools.combinations(b, longest))


def test_text_of_odd_pages(odd, none):
    found = html.extract_text(odd).collect()
    assert len(found) == len(ODD) and all(r.text is not None and r.n_chars == len(r.text) for r in found)
    assert {r.text for r in found if r.page_id in (3, 4)} == {""}
    assert html.extract_text(none).count() == 0


# --- addresses

def brute_rule(url):
    at = (url or "").find("://")
    if at < 0:
        return "", "", None, None
    rest = url[at + 3:]
    host = re.split("[/?#]", rest)[0]
    path = re.split("[?#]", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in urls.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.text), default=None)
    return host, path, best and best.text, best and best.verdict


ADDRESSES = [None, "", "no scheme", "http://", "http://com/", "http://COM/x", "http://com", "http://a.example.com/en/1", "http://WWW.example.com/en/?q#f", "https://example.com/en",
             "http://b.net/es/x", "http://b.net/?/es/", "http://net/fr/", "http://xnet/fr/", "ftp://a://b/c", "http://h#x://y/z", "http://ünï.com/é\n/x", "http://c.org/" + "a/" * 50_000]


def test_hosts_paths_and_rules(spark, odd, none):
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(ADDRESSES)], PAGES)
    found = {r.page_id: r for r in urls.judge_urls(pages).collect()}
    for i, url in enumerate(ADDRESSES):
        host, path, rule, verdict = brute_rule(url)
        assert (found[i].host, found[i].path, found[i].rule) == (host, path, rule)
        assert found[i].verdict in (verdict or "allow block".split())
    assert urls.judge_urls(odd).count() == len(ODD) and urls.judge_urls(none).count() == 0
    one_kind = spark.createDataFrame([(1, "http://net/es/", ""), (2, "http://x.org/", "")], PAGES)
    assert {r.verdict for r in urls.judge_urls(one_kind).collect()} == {"block"}
    assert {r.verdict for r in urls.judge_urls(one_kind.filter("page_id = 2")).collect()} == {"allow"}


def test_rules_hold_on_the_sample_and_reruns_agree(spark):
    found = {r.page_id: r for r in QUERIES["op7_url_filter"](spark, BASE).collect()}
    again = {r.page_id: r for r in QUERIES["op7_url_filter"](spark, BASE).collect()}
    for page in table(spark, BASE, "pages").collect():
        host, path, rule, verdict = brute_rule(page.url)
        r = found[page.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
        assert again[page.page_id].verdict == r.verdict


def test_trees_learn_what_the_labels_show(spark):
    """Blocked addresses are long, deep and full of digits; rows without a rule are judged alike."""
    made = random.Random(8)
    rows = []
    for i in range(400):
        bad = i % 2 == 0
        path = "".join(f"/{made.randint(10**5, 10**6)}" for _ in range(5)) if bad else "/" + "".join(made.choices("abcdef", k=6))
        rows.append((i, f"http://{'bad' if bad else 'good'}.{'test' if i < 300 else 'other'}{path}", bad))
    pages = spark.createDataFrame([(i, u, "") for i, u, _ in rows], PAGES)
    rules = (urls.UrlRule("block", "bad.test"), urls.UrlRule("allow", "good.test"))
    found = {r.page_id: r.verdict for r in urls.judge_urls(pages, rules).collect()}
    assert all(found[i] == ("block" if bad else "allow") for i, _, bad in rows)


def test_few_addresses_in_very_many_rows(spark):
    """Three addresses in 300 000 rows, one of them rare: both labels are learned from."""
    pages = spark.range(300_000).select(F.col("id").alias("page_id"), F.when(F.col("id") == 5, "https://a.net/es/x").when(
        F.col("id") % 3 == 0, "https://b.com/y").otherwise("https://c.org/z").alias("url"))
    judged = urls.judge_urls(pages).groupBy("rule").agg(F.count("*").alias("n"), F.count_distinct("verdict").alias("kinds")).collect()
    assert sum(r.n for r in judged) == 300_000 and all(r.kinds == 1 for r in judged)


def test_lexical_features(spark):
    url = "https://a.b-c.org/x1/yy/?p=1&q=22#t"
    df = spark.createDataFrame([(url,), (None,)], "url string")
    host, path = urls.host_of(F.col("url")), urls.path_of(F.col("url"))
    known, empty = df.select(F.array(*urls.lexical_features(F.col("url"), host, path)).alias("f")).collect()
    share = [url.count(c) / len(url) for c in set(url)]
    import math
    assert known.f == pytest.approx([len(url), 9, 7, 2, 2, 4 / len(url), -sum(p * math.log2(p) for p in share), 2, 1,
                                     sum(not c.isalnum() for c in url) / len(url), 1, 1, 1])
    assert set(empty.f) == {0.0}
