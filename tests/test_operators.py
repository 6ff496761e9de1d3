import json
import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import inputs
from newsloom.functions import markup, urls
from newsloom.operators import articles, items, lookup, reports, terms as term_lists
from newsloom.operators.blacklist import anti_join_prefix, prefix_index, with_prefix_hits
from newsloom.operators.terms import with_term_hits
from newsloom.plans.load import append_articles, load_run, resolve_articles, resolve_outcome, write_outcome
from newsloom.schemas import STORED_SCHEMA
from newsloom.sources import pages, registries
from newsloom.sources.articles import scan_existing
from newsloom.streaming.ingest import ingest_available, load_available


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_source_scans(spark):
    schema = "id long, Name string, url string, baseUrl string, isExecute boolean, isPrimarySource boolean"
    rows = [(1, "Alpha", "http://a/n", "http://a", True, True), (2, "Beta", "http://b/n", "http://b", False, False),
            (3, "Gamma", "http://c/n", "http://c", None, True)]
    registry = spark.createDataFrame(rows, schema)
    assert values(registries.scan_sources(registry), "*") == [("Alpha", "http://a/n", "http://a", True, True)]
    assert values(registries.scan_sources(registry.drop("isPrimarySource")), "primary_source") == [(False,)]
    assert registries.scan_sources(registry).columns == ["name", "url", "base_url", "execute", "primary_source"]
    plain = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "name string, execute boolean")
    assert values(registries.enabled_sources(plain), "name") == [("a",)]
    assert registries.enabled_sources(plain.drop("execute")).count() == 3


def test_team_scan(spark):
    registry = spark.createDataFrame(
        [(10, "2023-01-01T00:00:00Z", "http://t1/news", "http://t1", "T1", True),
         (11, "2023-01-02T00:00:00Z", "http://t2/feed", "http://t2", "T2", False)],
        "id long, created_at string, url string, baseUrl string, Team string, isExecute boolean")
    assert values(registries.scan_team_sources(registry), "id", "created_at", "url", "base_url", "team", "execute") == [
        (10, "2023-01-01T00:00:00Z", "http://t1/news", "http://t1", "T1", True)]


def test_source_ids_and_lookup(spark):
    registry = spark.createDataFrame([(1, "SourceA"), (2, "SourceB"), (5, "sourceb"), (0, "Zero")], "id long, Name string")
    ids = registries.scan_source_ids(registry)
    assert values(ids, "source_key", "source_id") == [("SOURCEA", 1), ("SOURCEB", 5), ("ZERO", 0)]
    found = spark.createDataFrame([("sourceA",), ("SOURCEB",), (" SourceA",), ("zero",), ("none",), (None,)], "source string")
    assert values(lookup.lookup_source_id(found, ids), "source", "source_id", "reason") == sorted([
        ("sourceA", 1, None), ("SOURCEB", 5, None), (" SourceA", None, "no_source_id"), ("zero", 0, "no_source_id"),
        ("none", None, "no_source_id"), (None, None, "no_source_id")], key=repr)


def test_unnamed_sites(spark):
    raw = spark.createDataFrame([("Unknown Source", 1)], "source_name string, x int")
    sites = spark.createDataFrame([("http://u",)], "base_url string")
    assert values(lookup.attach_source(raw, sites), "source_name", "base_url", "source_failure") == [("Unknown Source", "http://u", None)]


def test_blacklist_file(spark, tmp_path):
    def scan(text):
        path = tmp_path / f"list{len(list(tmp_path.iterdir()))}.json"
        path.write_text(text)
        return values(registries.scan_blacklist(spark, str(path)), "url")

    assert scan('[\n  {"url": "http://bad.com/"},\n  {"url": ""}, {"other": 1}, {"url": null}, {"url": "http://worse"}\n]\n') == [
        ("http://bad.com/",), ("http://worse",)]
    assert scan('[{"url": "http://bad.com/"}, {"ur') == []
    assert scan("not json") == []
    assert scan('{"url": "http://single"}') == []
    assert scan(' \n\n [{"url": "http://late"}]') == [("http://late",)]
    assert len(scan("[" + ",".join('{"url": "http://h%d.com/"}' % i for i in range(30_000)) + "]")) == 30_000
    assert scan("[]") == []
    assert values(registries.scan_blacklist(spark, str(tmp_path / "missing.json")), "url") == []
    folder = str(tmp_path / "lines")
    spark.range(5).selectExpr("concat('http://h', id) AS url").write.json(folder)
    assert registries.scan_blacklist(spark, folder, lines=True).count() == 5


def test_prefix_tests_with_equal_column_names(spark):
    urls = ["http://badsite.com/anypage", "http://anotherbad.com/path/subpath", "http://anotherbad.com/pathway",
            "http://goodsite.com/", "http://badsite.co", "HTTP://badsite.com/x", "", None, "ftp:x", "ftp"]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id long, url string")
    prefixes = spark.createDataFrame([("http://badsite.com/",), ("http://anotherbad.com/path",), ("",), (None,), ("http://badsite.com/",),
                                      ("http://badsite.com/any",), ("ftp:",)], "url string")
    hits = with_prefix_hits(df, prefixes, {"hit": "url"})
    assert [r.hit for r in hits.orderBy("id").collect()] == [True, True, True, False, False, False, False, False, True, False]
    assert values(anti_join_prefix(df, "url", prefixes), "id") == [(3,), (4,), (5,), (6,), (7,), (9,)]
    assert anti_join_prefix(df, "url", prefixes.limit(0)).count() == 10
    assert prefix_index(prefixes).top == ["ftp:", "http://anotherbad.com/path", "http://badsite.com/"]


@pytest.mark.parametrize("sizes", [{}, {"listed": 40, "node_bits": 3, "per_task": 50}, {"listed": 2, "node_bits": 2, "per_task": 1000}])
def test_prefix_index(spark, sizes):
    """Most entries on one host, chains of entries that start with others, texts before, between and after all entries."""
    numbers = [i * 7919 % 1000 for i in range(300)]
    listed = [f"http://one.host/{n:03d}" for n in numbers] + [f"http://one.host/{n:03d}/{'x' * (n % 5)}" for n in numbers[:150]]
    listed += ["http://b", "http://b/" + "y" * 60, "http://ü.de/", "http://ü", "ü\U0001F600", "~", "http://one.host/5", *(f"chain/{'/' * i}" for i in range(30))]
    urls = [f"http://one.host/{n:04d}" for n in range(0, 9999, 13)] + listed + ["", None, "a", "\x7f", "http://b.com", "http://", "http://ü.fr", "\U0001F601", "chain", "chain/z"]
    prefixes = spark.createDataFrame([(p,) for p in [*listed, *listed[:50], "", None]], "url string")
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id long, url string")
    index = prefix_index(prefixes, **sizes)
    assert bool(index.levels) == bool(sizes) and (len(index.levels) > 3) == (sizes.get("listed") == 2)
    have = [r.hit for r in with_prefix_hits(df, index, {"hit": "url", "again": "url"}).filter("hit = again").orderBy("id").collect()]
    assert have == [u is not None and any(u.startswith(p) for p in listed) for u in urls]
    hits = with_prefix_hits(df, index, {"hit": "url"}).filter("id % 2 = 0 AND hit")
    assert hits.columns == ["id", "url", "hit"]


def test_articles(spark):
    found = spark.createDataFrame([("a-1", "SourceA", "H", "/h", "http://a/h", "2023-01-01")],
                                  "id string, source string, headline string, href string, url string, published_at string")
    formatted = articles.format_article(found)
    assert formatted.first().asDict() == {
        "uniqueName": "a-1", "source": "SourceA", "headline": "H", "href": "/h", "url": "http://a/h",
        "publishedAt": "2023-01-01", "isProcessed": False}
    assert articles.format_article(found.drop("published_at", "id")).first()[:6] == ("", "SourceA", "H", "/h", "http://a/h", "")
    for df in (found, formatted):
        row = articles.prepare_insert(df.withColumn("source_id", F.lit(10)))
        assert tuple(row.first()) == ("a-1", 10, "H", "/h", "http://a/h", "2023-01-01", False)
        assert [f.dataType for f in row.schema] == [f.dataType for f in STORED_SCHEMA]
    both = formatted.withColumns({"id": F.lit("other"), "published_at": F.lit("other"), "source_id": F.lit(1)})
    assert articles.prepare_insert(both).first()[0] == "a-1"
    empty = found.select("headline").withColumn("source_id", F.lit(1))
    assert tuple(articles.prepare_insert(empty).first()) == ("", 1, "H", None, None, None, False)
    assert articles.finalize_item(found.drop("source", "published_at")).first().asDict() == {
        "id": "a-1", "source": "", "headline": "H", "href": "/h", "url": "http://a/h", "published_at": "", "isProcessed": False}


def test_loading_and_reports(spark, tmp_path):
    found = spark.createDataFrame(
        [(f"a{i}", s, "H", "/h", f"http://a/{i}", "d") for i, s in enumerate(["TestSource", "UnknownSource", "testsource"])],
        "id string, source string, headline string, href string, url string, published_at string")
    ids = spark.createDataFrame([("TESTSOURCE", 10)], "source_key string, source_id long")
    resolved = resolve_articles(found, ids)
    stored, rejects = str(tmp_path / "stored"), str(tmp_path / "rejects")
    assert append_articles(resolved, stored, write=False).count() == 2
    assert not (tmp_path / "stored").exists()
    for n in (1, 2):  # repeated runs add again
        append_articles(resolved, stored, rejects)
        assert spark.read.parquet(stored).count() == 2 * n
    assert values(spark.read.parquet(rejects), "uniqueName", "reason") == [("a1", "no_source_id")] * 2
    assert append_articles(resolved, stored, skip_known_urls=spark.read.parquet(stored).limit(0), write=False).count() == 2
    assert append_articles(resolved, stored, skip_known_urls=spark.read.parquet(stored), write=False).count() == 0
    known = str(tmp_path / "known")
    assert append_articles(resolved, stored, known, skip_known_urls=spark.read.parquet(stored)).count() == 0
    assert values(spark.read.parquet(known), "uniqueName", "reason") == [("a0", "known_url"), ("a1", "no_source_id"), ("a2", "known_url")]
    assert [r.uniqueName for r in scan_existing(spark.read.parquet(stored), 3).collect()] == ["a0", "a0", "a2"]

    sites = spark.createDataFrame([("TestSource",), ("Quiet",)], "name string")
    assert values(reports.items_per_source(sites, found), "name", "n_items") == [("Quiet", 0), ("TestSource", 1)]
    assert reports.stored_count(resolved).first().n_stored == 2
    assert tuple(reports.run_summary(sites, resolved).first()) == (3, 2, "ok")
    assert tuple(reports.run_summary(sites, resolved.filter("source_id is null")).first()) == (1, 0, "ok")
    assert tuple(reports.run_summary(sites, resolved.limit(0)).first()) == (0, 0, "no_items")
    assert tuple(reports.run_summary(sites.limit(0), resolved.limit(0)).first()) == (0, 0, "no_sources")


def test_item_filters(spark):
    dated = spark.createDataFrame([("2024-01-10",), ("2024-01-09T10:00:00Z",), ("2024-01-08",), ("2024-01-11",), ("soon",), ("",), (None,)], "d string")
    assert values(items.within_period(dated, "d", "2024-01-10"), "d") == [("2024-01-09T10:00:00Z",), ("2024-01-10",)]
    heads = spark.createDataFrame([("One", "/a"), ("Two words", "/a"), ("Two Teams", "/video/1"), (" x ", "/a"), ("Videos are fine", "/videoclips")], "h string, u string")
    assert values(items.topic_and_junk(heads, "h", "u"), "h") == [("Two words",), ("Videos are fine",)]
    assert values(items.topic_and_junk(heads, "h", terms=["TEAM"]), "h") == [("Two Teams",)]
    many = spark.range(100).selectExpr("id", "if(id < 90, 'a', 'b') s")
    assert values(items.limit_per_source(many, "s", "id", 3), "id") == [(0,), (1,), (2,), (90,), (91,), (92,)]
    fields = spark.createDataFrame([("h", "x"), ("", ""), (None, "x"), ("h", "")], "headline string, href string")
    assert [r.reason for r in items.require_fields(fields).collect()] == [None, "missing_headline", "missing_headline", "missing_href"]


def test_stable_order(spark):
    registry = spark.createDataFrame([(2, "A"), (1, "B")], "id long, Name string")
    rows = [("A", 1, 1), ("A", 1, 0), ("B", 9, 0), ("A", 0, 5)]
    found = spark.createDataFrame(rows, "source string, response_id long, pos int")
    assert [tuple(r) for r in items.stable_order(found, registry).collect()] == [("B", 9, 0), ("A", 0, 5), ("A", 1, 0), ("A", 1, 1)]


def test_items_are_computed_once_to_be_ordered(spark):
    rows = spark.createDataFrame([(1, 0, "a"), (2, 0, "b")], "response_id long, pos int, source string")
    ordered = items.stable_order(rows, spark.createDataFrame([(2, "a"), (1, "b")], "id long, Name string"))
    plan = ordered._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Join" not in plan
    assert [r["response_id"] for r in ordered.collect()] == [2, 1]


def test_a_long_list_is_computed_twice_at_most(spark):
    """To see that it is long, and for its copy; each time for its entries and for those that are empty."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def noted(n):
        seen.add(1)
        return f"http://h/{n:09d}"

    listed = spark.range(0, 5000, 1, 2).select(noted("id").alias("url")).distinct()
    prefix_index(listed, listed=1000, per_task=500)
    assert seen.value <= 20_000


def test_columns_stay_prunable_and_filters_stay_above(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    plan = urls.with_clean_url(df, "url", "clean").filter("clean like '%x%' and page_id > 3").select("page_id", "clean")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "html" not in text.split("ReadSchema:")[1] and "GreaterThan(page_id,3)" in text
    assert text.index("Contains(clean") < text.index("Generate")


HTML = """<html><head><style>a{}</style><script>var a = '<a href="/no">no no</a>';</script></head><body>
<nav><a href="/home">Home page</a></nav><!-- <a href="/hidden">hidden link</a> -->
<h1 class="x">Big &amp; <b>bold</b>
 news</h1><a class='c' href='/story/1'>First <i>story</i> today</a> <a href="http://o.com/2">Other story</a><a href="/one">Single</a><a name="n">no href</a></body></html>"""


def test_pages(spark):
    df = spark.createDataFrame([(1, "https://www.site.com/section/page?x=1", HTML), (2, "http://empty.com/", "<p>none</p>")], "page_id long, url string, html string")
    assert values(pages.page_anchors(df, "2024-01-01"), "pos", "id", "source", "headline", "href", "url", "published_at") == [
        (0, "first-story-today", "site.com", "First story today", "/story/1", "https://www.site.com/story/1", "2024-01-01"),
        (1, "other-story", "site.com", "Other story", "http://o.com/2", "http://o.com/2", "2024-01-01")]
    assert values(pages.page_anchors(df, keep_nav=True, min_words=1), "headline") == [
        ("First story today",), ("Home page",), ("Other story",), ("Single",)]
    assert values(pages.page_items(df), "page_id", "id", "headline", "url") == [
        (1, "big-bold-news", "Big & bold news", "https://www.site.com/section/page?x=1")]


def test_stream_takes_only_what_is_new(spark, tmp_path):
    landing, out, state = (str(tmp_path / n) for n in ("landing", "out", "state"))
    sites = spark.createDataFrame([("S", "http://s.com")], "name string, base_url string")
    prefixes = spark.createDataFrame([("http://s.com/bad",)] + [(f"http://h{i}.com/",) for i in range(1_500)], "url string")

    def land(response_id, hrefs):
        content = json.dumps([{"headline": "Same Headline", "href": h} for h in hrefs]).encode()
        spark.createDataFrame([(response_id, "S", content)], "response_id long, source_name string, content binary") \
            .selectExpr("*", "timestamp '2024-01-01' fetched_at").write.mode("append").parquet(landing)
        ingest_available(spark, landing, out, state, sites, prefixes).awaitTermination()
        return values(spark.read.parquet(out), "response_id", "id", "url", "status")

    first = land(1, ["/a", "/bad", "/c"])
    assert first == [(1, "same-headline", "http://s.com/a", "accepted"), (1, "same-headline-1", "http://s.com/bad", "rejected"),
                     (1, "same-headline-2", "http://s.com/c", "accepted")]
    assert land(2, ["/a"]) == first + [(2, "same-headline", "http://s.com/a", "accepted")]


def test_outcome_is_written_once(spark, tmp_path):
    path = str(tmp_path / "outcome")
    df = spark.createDataFrame([(1, None), (2, "url_error")], "response_id long, reason string")
    write_outcome(df, path)
    assert values(spark.read.parquet(path), "response_id", "status") == [(1, "accepted"), (2, "rejected")]


def found(html, selectors):
    return [(names, e.tag, e.in_nav, e.heading and " ".join(e.heading.split()), e.heading_href, e.anchor and " ".join(e.anchor.split()), e.anchor_href)
            for parsed in [markup.selectors(selectors)] for e in markup.elements(html, parsed) for names in [parsed[e.selector].text]]


def test_markup_is_read_with_a_stack():
    nested = "<nav><nav><a href='/1'>one</a></nav><a href='/2'>still in</a></nav><a href=/3>out</a></nav><a href='/4'>too</a>"
    assert [(x[2], x[5], x[6]) for x in found(nested, "a")] == [(True, "one", "/1"), (True, "still in", "/2"), (False, "out", "/3"), (False, "too", "/4")]
    script = "<script>var s = '<!-- <h1>no</h1> -->';</script><STYLE>h1{}</style ><h1>yes<!-- <h1>no</h1> --> it is</H1>"
    assert [x[3] for x in found(script, "h1")] == ["yes it is"]
    open_ = "<article><h2>First <b>title</article><article><p>a<p>b<a href='/x' title='>'>Link text<article><a href='/y'>Next"
    assert [(x[1], x[3], x[5], x[6]) for x in found(open_, "article")] == [
        ("article", "First title", None, None), ("article", None, "Link text", "/x"), ("article", None, "Next", "/y")]
    headings = "<a href='/around'><h2>Inside</h2></a><h1>Has <a href='/in'>a link</a> <a href='/no'>more</a></h1>"
    assert [(x[3], x[4]) for x in found(headings, "h1, h2")] == [("Inside", "/around"), ("Has a link more", "/in")]
    assert found("a < b <1> <>", "a") == [] and found("", "a") == [] and found("<h1", "h1")[0][3] is None
    assert [x[3] for x in found("<h1>never <i>closed", "h1")] == ["never closed"]


def test_selectors():
    html = """<a href="/news/1" class="x big">t</a><A HREF='/NEWS'>t</A><p data-qa=my-headline-2>t</p><div class='big y'>t</div><a>t</a><br class=big>"""
    names = lambda s: [x[1] for x in found(html, s)]
    assert names("a[href*='/news']") == ["a"] and names("a[href]") == ["a", "a"] and names("a") == ["a"] * 3
    assert names(".big") == ["a", "div", "br"] and names("a.big") == ["a"] and names(".big.y") == ["div"]
    assert names('[data-qa*="headline"]') == names("[data-qa^=my]") == names("[data-qa$='2']") == ["p"] and names("[data-qa='my']") == []
    assert names("[class~=big]") == ["a", "div", "br"] and names("[href*='a,b'], p") == ["p"] and names("*") == ["a", "a", "p", "div", "a", "br"]
    assert [x[0] for x in found(html, "p, [data-qa], a[href], a")] == ["a[href]", "a[href]", "p", "a"]
    for bad in ("a b", "a > b", "", "a[", "a:hover"):
        with pytest.raises(ValueError):
            markup.selectors(bad)


@pytest.mark.parametrize("page", [
    "<article><div>" * 200_000 + "<a href='/news/x'>a b</a>" * 50_000, "<p><div>" + "<b>" * 200_000 + "<p></p>" * 200_000, "<div><h1>x y" * 300_000,
    "<" * 5_000_000, "<a href=\"/news'" * 300_000, "<!-- " * 1_000_000, "<nav><a href='/1'>" * 200_000])
def test_time_grows_with_the_page(page):
    start = time.process_time()
    markup.elements(page, markup.selectors(pages.CANDIDATES))
    assert time.process_time() - start < 40


def test_candidates(spark):
    rows = [(1, "http://a.com/x/y", "<h1>Main title here</h1><article><h2><a href='/s/1'>Story &amp; one</a></h2></article><div class='article'>no words</div>"),
            (2, "http://b.com/", "<p>nothing</p>"), (3, "http://c.com/", None), (4, "http://d.com/", "<h1>One</h1><nav><h2>Menu of things</h2></nav>"),
            (1, "http://a.com/x/y", "<h2>Fetched again</h2>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    assert values(pages.page_candidates(df), "page_id", "pos", "headline", "url", "selector", "reason") == sorted([
        (1, 0, "Main title here", "http://a.com/x/y", "h1", None), (1, 1, "Story & one", "http://a.com/s/1", "article", None),
        (1, 2, "", "http://a.com/x/y", ".article", "missing_headline"), (1, 0, "Fetched again", "http://a.com/x/y", "h2", None),
        (2, None, None, "http://b.com/", None, "no_candidate"), (3, None, None, "http://c.com/", None, "no_candidate"),
        (4, 0, "One", "http://d.com/", "h1", "short_headline")], key=repr)
    assert pages.page_candidates(df.limit(0)).count() == 0


def test_load_run_counts_what_it_writes(spark, tmp_path):
    stored, rejects = (str(tmp_path / n) for n in ("stored", "rejects"))
    ids = spark.createDataFrame([("S", 5)], "source_key string, source_id long")
    rows = [(1, 0, "a", "s", "H", "/h", "http://s/h", "2024", False, None), (1, 1, "b", "t", "H", "/h", "http://t/h", "", False, None),
            (1, 2, "c", "S", "H", "/k", "http://s/k", "", False, None), (2, None, None, "S", None, None, None, None, False, "parse_error")]
    outcome = spark.createDataFrame(rows, "response_id long, pos int, id string, source string, headline string, href string, url string, published_at string, isProcessed boolean, reason string")
    known = spark.createDataFrame([("http://s/k",), ("http://s/k",)], "url string")
    for run in (None, None, 3, 3):
        counts = load_run(resolve_outcome(outcome, ids, known), stored, rejects, run)
        assert {k: n for k, n in counts.items() if n} == {"fetched": 3, "stored": 1, "parse_error": 1, "no_source_id": 1, "known_url": 1}
    assert spark.read.schema(STORED_SCHEMA).parquet(f"{stored}/*.parquet").count() == 2
    assert values(spark.read.parquet(f"{stored}/run=3"), "uniqueName", "source", "publishedAt") == [("a", 5, "2024")]
    assert values(spark.read.parquet(f"{rejects}/run=3"), "uniqueName", "pos", "reason") == sorted([
        ("b", 1, "no_source_id"), ("c", 2, "known_url"), (None, None, "parse_error")], key=repr)
    assert not list((tmp_path / "stored").glob("*/_temporary"))


def test_a_broken_run_is_repeated_once(spark, tmp_path, monkeypatch):
    """A stream that stops between both sides of a micro-run leaves the tables of one that did not."""
    landing, state = str(tmp_path / "landing"), str(tmp_path / "state")
    sites = spark.createDataFrame([("S", "http://s.com")], "name string, base_url string")
    ids = spark.createDataFrame([("S", 1)], "source_key string, source_id long")
    for i in range(4):
        content = json.dumps([{"headline": f"Headline {i}", "href": "/a"}, {"headline": "", "href": "/b"}]).encode()
        spark.createDataFrame([(i, "S", content)], "response_id long, source_name string, content binary") \
            .selectExpr("*", "timestamp '2024-01-01' fetched_at").coalesce(1).write.mode("append").parquet(landing)

    def run(folder, checkpoint, **options):
        seen = []
        load_available(spark, landing, str(tmp_path / folder / "stored"), str(tmp_path / folder / "rejects"), checkpoint, sites, ids,
                       files_per_run=2, report=lambda n, counts: seen.append((n, counts["stored"], counts["missing_headline"])), **options).awaitTermination()
        return seen

    from newsloom.plans import load
    real, calls = load.prepare_insert, []

    def breaks(rows):
        calls.append(1)
        if len(calls) == 2:
            rows.write.parquet(str(tmp_path / "broken" / "stored" / "run=1"))  # one side is there, the other is not
            raise RuntimeError("lost")
        return real(rows)

    monkeypatch.setattr(load, "prepare_insert", breaks)
    with pytest.raises(Exception, match="lost"):
        run("broken", state)
    monkeypatch.setattr(load, "prepare_insert", real)
    assert run("broken", state) == [(1, 2, 2)] and run("whole", str(tmp_path / "other")) == [(0, 2, 2), (1, 2, 2)]
    for side in ("stored", "rejects"):
        tables = [values(spark.read.parquet(str(tmp_path / folder / side)), "uniqueName", "url", "run") for folder in ("broken", "whole")]
        assert len(tables[0]) == 4 and sorted(x[0] or "" for x in tables[0]) == sorted(x[0] or "" for x in tables[1])
    assert run("broken", state) == []


@pytest.mark.parametrize("sizes", [{}, {"most_terms": 10}, {"most_chars": 50}])
def test_term_lists(spark, sizes):
    texts = ["the NFL draft", "nothing", "", None, "İstanbul ünd mehr", "draft", "DRAF", "a  b", "x" * 500 + " end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    terms = ["nfl", "Draft", "dra", "ÜND", " b", "x end", None] + [f"word{i} of many" for i in range(30)]
    listed = spark.createDataFrame([(t,) for t in terms], "term string")
    have = [r.hit for r in with_term_hits(df, "t", listed, "hit", **sizes).orderBy("id").collect()]
    assert have == [t is not None and any(x.lower() in t.lower() for x in terms if x) for t in texts]
    every = with_term_hits(df, "t", listed.unionAll(spark.createDataFrame([("",)], "term string")), "hit", **sizes)
    assert [r.hit for r in every.orderBy("id").collect()] == [t is not None for t in texts]
    assert with_term_hits(df, "t", listed.limit(0), "hit", **sizes).filter("hit").count() == 0


def test_very_many_terms(spark):
    """100,000 terms take a search per text, not one per term."""
    terms = spark.range(100_000).selectExpr("concat('term ', sha1(cast(id AS string))) AS term")
    df = spark.range(50_000).selectExpr("id", "concat('Some TERM ', if(id % 2 = 0, sha1(cast(id AS string)), 'x'), ' here') AS t")
    start = time.perf_counter()
    assert items.topic_and_junk(df, "t", terms=terms).count() == 25_000
    assert time.perf_counter() - start < 120


def test_term_parts_and_long_text(spark):
    """Lists beyond the limit are made once, and looked up in time that grows with the text, not with its square."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def term(n):
        made.add(1)
        return f"Term {n} of many"

    terms = spark.range(1000).select(term("id").alias("term"))
    texts = ["word " * 200_000 + end for end in ("TERM 999 of many!", "term 1000 of many", "term 7 of man")] + [None, "", "a term 0 of many"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    found = with_term_hits(df, "t", terms, "hit", most_terms=300)
    assert [r.hit for r in found.orderBy("id").collect()] == [True, False, False, False, False, True]
    assert found.columns == ["id", "t", "hit"] and made.value == 1000


@pytest.mark.parametrize("kept_bits", [64, 2])
def test_term_search(monkeypatch, kept_bits):
    """The same as a plain search, in texts cut anywhere, for terms of all lengths and also where hashes are the same."""
    hashed, mask = term_lists._hashed, np.uint64((1 << kept_bits) - 1 << 64 - kept_bits)
    monkeypatch.setattr(term_lists, "_hashed", lambda *a: hashed(*a) & mask)
    for seed in range(60):
        choice = random.Random(seed)
        monkeypatch.setattr(term_lists, "BLOCK", choice.choice([7, 64, 1 << 18]))
        letters = choice.choice(["ab", "abc d", "a\u00e9 \u00fc\u6f22\U0001f600"])
        word = lambda n: "".join(choice.choice(letters) for _ in range(n))
        terms = sorted({word(choice.choice([1, 3, 7, 8, 9, 15, 16, 17, 31, 33, 70])) for _ in range(choice.choice([1, 2, 8]))})
        texts = [None, ""] + [word(choice.randrange(30)) + choice.choice(terms)[:choice.choice([None, -1])] + word(choice.randrange(9)) for _ in range(12)]
        have = term_lists.TermList(pa.chunked_array([terms[:1], terms[1:]], pa.string())).in_each(pa.array(texts, pa.string()).slice(1))
        assert have.tolist() == [any(term in text for term in terms) for text in texts[1:]], seed


def test_words_of_headlines(spark):
    heads = ["a b", " a b ", "a", "", None, "a\u00a0b\u2003c", "a\tb\x1cc\x85d", "\n", "a\n\nb", "a\u200bb c", "\u6f22 \U0001f600 \u00e9", "w " * 5000]
    df = spark.createDataFrame([(h,) for h in heads], "h string")
    white = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85"
    words = lambda h: len("".join(" " if c in white else c for c in h).split())
    for n in (0, 1, 2, 3, 4, 7):
        want = sorted((h,) for h in heads if h is not None and words(h) >= n)
        assert sorted(values(items.topic_and_junk(df, "h", min_words=n), "h")) == want


def test_ending_terms(spark, tmp_path):
    """What the pattern of the SQL finds, also next to other marks and in texts with only one word."""
    texts = ["a b! c d!", "a b!c d! e!", "one! two three!! four", "x  y! .z w!\nv u!", "no end\n! it is!so it!", "a.b c.d e!", "!a !b! !", "w" * 50_000 + "!",
             "\u6f22 \U0001f600! t\tu v!\r\nx\u00a0y z!", "", None, "Stop now! Stop  now!"]
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(str(tmp_path / "documents.parquet"))
    plain = F.regexp_extract_all("text", F.lit("([^ \n.]+ [^ \n.]+)[!]"), F.lit(1))
    want = inputs.table(spark, tmp_path, "documents").filter("length(text) < 1000").select(F.explode(plain).alias("term")).distinct()
    have = values(inputs.ending_terms(spark, tmp_path), "term")
    assert have == values(want, "term") and ("b! c",) not in have and ("two three!",) in have
