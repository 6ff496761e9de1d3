import json
import random

import pytest
from pyspark.sql import functions as F

from newsloom.functions import responses
from newsloom.functions.responses import array_elements, decode_content, locate_json, with_parsed_items
from newsloom.plans.clean import accepted, clean_responses, rejected
from newsloom.sources.responses import scan_raw_responses

BASE = "http://example.com"


def fenced(items):
    return "Here:\n```json\n" + json.dumps(items, ensure_ascii=False) + "\n```\nSee [1]."


def item(headline="Some Headline", href="/news/1", **more):
    return {"headline": headline, "href": href, **more}


@pytest.fixture(scope="module")
def clean(spark):
    def run(contents, bases=None, blacklist=(), **options):
        bases = bases or [BASE] * len(contents)
        raw = spark.createDataFrame(
            [(i, f"Site {i}", c.encode() if isinstance(c, str) else c) for i, c in enumerate(contents)],
            "response_id long, source_name string, content binary",
        )
        sources = spark.createDataFrame([(f"Site {i}", b) for i, b in enumerate(bases)], "name string, base_url string")
        prefixes = spark.createDataFrame([(u,) for u in blacklist], "url string")
        out = clean_responses(scan_raw_responses(raw), sources, prefixes, **options)
        rows = out.collect()
        return sorted(rows, key=lambda r: (r.response_id, -1 if r.pos is None else r.pos))
    return run


def outcome(rows):
    return [(r.pos, r.id, r.reason) for r in rows]


def test_a_whole_batch(clean):
    [first, second] = clean([fenced([
        item("Test Headline 1", "/news/1", id="test-headline-1", source="model.example", published_at="2023-10-26"),
        item(" Another Story ", "http://othersite.com/news/2", url="http://othersite.com/news/2"),
    ])])
    assert (first.id, first.source, first.url, first.published_at, first.isProcessed, first.reason) == (
        "test-headline-1", "Site 0", "http://example.com/news/1", "2023-10-26", False, None)
    assert (second.id, second.headline, second.href, second.url, second.published_at) == (
        "another-story", "Another Story", "http://othersite.com/news/2", "http://othersite.com/news/2", "")


def test_failed_batches_do_not_touch_others(clean):
    rows = clean([
        None, "", "This is not JSON", "[]", "[1, \"x\", null]", "7", '{"items": 1}', '{"h": "a [b]"}',
        '[{"headline": "Good", "href": "/x"}] trailing [1]', fenced([item()]), '{"headline": "One", "href": "/one"}',
        '{"items": [{"headline": "Inner", "href": "/in"}]}', '{"headline": "One", "href": "/one"} and more',
        '[{"headline": "Cut", "href"', '[1] ] [2]', '[1]} {"x": [2]',
    ])
    assert [(r.response_id, r.id, r.reason) for r in rows] == [
        (0, None, "empty_response"), (1, None, "empty_response"), (2, None, "parse_error"), (3, None, "no_items"),
        (4, None, "no_items"), (5, None, "no_items"),
        (6, None, "missing_headline"), (7, None, "parse_error"), (8, None, "parse_error"), (9, "some-headline", None),
        (10, "one", None), (11, "inner", None), (12, None, "parse_error"), (13, None, "parse_error"),
        (14, None, "parse_error"), (15, None, "parse_error"),
    ]


def test_slugs_are_taken_before_url_checks_but_after_validation(clean):
    rows = clean([fenced([
        item("slug", ""), item("", "/x"), item("  ", "/x"), item("slug", "http://bad.com/1"), item("slug", "/2"),
        item("slug", "/3", url=" http://bad.com/x "), item("slug", "/4", url="http://BAD.com/x"), "text", None,
        item("!!!???"), item("other", id=" ??? "),
    ])], blacklist=["http://bad.com/", ""])
    assert outcome(rows) == [
        (0, None, "missing_href"), (1, None, "missing_headline"), (2, None, "missing_headline"),
        (3, "slug", "blacklisted_built"), (4, "slug-1", None), (5, "slug-2", "blacklisted_supplied"), (6, "slug-3", None),
        (7, "article-8b8a7981", None), (8, "article-d0941e68", None),
    ]


ODD_MEMBERS = [
    (item(7), True), (item(None), True), (item(href=7), True), (item(href=[1]), True),
    (item(id=7), True), (item(id=None), True), (item("", id=7), False), (item(href="", id=None), False),
    (item(url=7), True), (item(url=None), True), (item("", url=7), False),
    (item(href="//h/x", url=7), True), (item(published_at=None, source=3), False),
]


def test_members_of_the_wrong_type(clean):
    contents = [fenced([item("fine"), odd]) for odd, _ in ODD_MEMBERS]
    strict, lenient = clean(contents), clean(contents, on_bad_item="quarantine")
    for i, (odd, fails) in enumerate(ODD_MEMBERS):
        rows = [r for r in strict if r.response_id == i]
        if fails:
            assert outcome(rows) == [(None, None, "bad_batch")], odd
        else:
            assert rows[0].id == "fine" and len(rows) == 2, odd
        rows = [r for r in lenient if r.response_id == i]
        assert rows[0].id == "fine" and (rows[1].reason == "bad_item") == fails, odd


def test_an_unbuildable_url_is_skipped_before_its_supplied_url_is_looked_at(clean):
    content = fenced([item("a", "//h/x", url=7), item("a", "/y")])
    rows = clean([content], ["http://[broken/"])
    assert outcome(rows) == [(0, "a", "url_error"), (1, "a-1", None)]
    content = fenced([item("a", "http://[broken/x", url=7), item("a", "/y")])
    assert outcome(clean([content])) == [(None, None, "bad_batch")]
    assert outcome(clean([content], url_mode="ci")) == [(0, "a", "url_error"), (1, "a-1", None)]


def test_url_modes(clean):
    content = fenced([item("a", "/für//x y/?q= a = b #f"), item("b", "//cdn.com/a/"), item("c", "../up"), item("d", "http://[x/y z")])
    assert [r.url for r in clean([content])] == [
        "http://example.com/fr//x-y/?q=-a-=-b-#f", "http://cdn.com/a/", "http://example.com/../up", "http://[x/y-z"]
    assert [(r.url, r.reason) for r in clean([content], url_mode="ci")] == [
        ("http://example.com/für/x y?q=a = b#f", None), ("http://cdn.com/a", None), ("http://example.com/../up", None),
        (None, "url_error")]


def test_modes_differ_on_a_blacklisted_folder(clean):
    content = fenced([item("a", "/mailbag/")])
    assert [r.reason for r in clean([content], blacklist=[BASE + "/mailbag/"])] == ["blacklisted_built"]
    assert [r.reason for r in clean([content], blacklist=[BASE + "/mailbag/"], url_mode="ci")] == [None]


def test_blacklist_of_every_kind(clean):
    prefixes = ["http://bad.com/", "http://bad", "http://worse.com/a", "https://x", "http://example.com/n", "http://worse.com/abc", ""]
    urls = ["http://bad.com/1", "http://ba", "http://worse.com/ab", "http://worse.com/b", "/news", "/other", "https://xy", "//bad.com/q"]
    supplied = ["", "http://worse.com/abc", "http://fine"]
    content = [fenced([item(f"h{i}", u, url=v) for i, u in enumerate(urls)]) for v in supplied]
    many = [f"http://h{i}.com/" for i in range(1_500)]
    rows = clean(content, blacklist=prefixes + many)
    built = [u if "://" in u else "http:" + u if u.startswith("//") else BASE + u for u in urls]
    hit = lambda u: any(p and u.startswith(p) for p in prefixes)
    want = ["blacklisted_supplied" if hit(v) else "blacklisted_built" if hit(u) else None for v in supplied for u in built]
    assert [r.reason for r in rows] == want and set(want) == {None, "blacklisted_supplied", "blacklisted_built"}


def test_repeated_site_names_are_sites_of_their_own(spark):
    raw = spark.createDataFrame([(1, "A", fenced([item("h", "/x")]))], "response_id long, source_name string, content string")
    sites = spark.createDataFrame([("A", "http://bad.com"), ("A", "http://good.com")], "name string, base_url string")
    prefixes = spark.createDataFrame([("http://bad.com",)] + [(f"http://h{i}/",) for i in range(1_200)], "url string")
    rows = clean_responses(raw, sites, prefixes).collect()
    assert sorted((r.url, r.reason) for r in rows) == [("http://bad.com/x", "blacklisted_built"), ("http://good.com/x", None)]


@pytest.mark.parametrize("mode", ["local", "ci"])
def test_without_a_base_address(clean, mode):
    content = fenced([item("a", "/x"), item("b", "//h/y"), item("c", "http://h/z"), item("d", "../u"), item("e", "/v", url=7)])
    rows = clean([content], [None], url_mode=mode)
    assert [r.reason for r in rows] == ["url_error", "url_error", None, "url_error", "url_error"]
    assert [r.url for r in rows if r.reason is None] == ["http://h/z"]


def test_numbers_that_json_lacks(clean):
    rows = clean(['[{"headline": "A", "href": "/a", "x": NaN}, 7, {"headline": "B", "href": "/b", "y": [-Infinity]}]',
                  '{"headline": "C", "href": "/c", "x": Infinity}', '[{"headline": "D", "x": NaN}] and [1]', '[{"a": NaN}', 'NaN'])
    assert [(r.response_id, r.id, r.reason) for r in rows] == [
        (0, "a", None), (0, "b", None), (1, "c", None), (2, None, "parse_error"), (3, None, "parse_error"), (4, None, "no_items")]


def test_at_most_max_items(clean):
    content = fenced([item("a"), item("a"), item("a"), item(7)])
    assert outcome(clean([content], max_items=2)) == [(0, "a", None), (1, "a-1", None)]


def test_duplicate_members_keep_the_last(clean):
    assert clean(['[{"headline": "x", "headline": "y", "href": "/"}]'])[0].id == "y"


def test_every_response_is_accounted_for(spark):
    raw = spark.createDataFrame([(1, "A", "[]"), (2, "B", "[]"), (3, "C", "[]"), (4, None, "[]")], "response_id long, source_name string, content string")
    sources = spark.createDataFrame([("A", "http://a", True), ("C", "http://c", False)], "name string, base_url string, execute boolean")
    out = clean_responses(raw, sources)
    assert sorted((r.response_id, r.reason) for r in out.collect()) == [
        (1, "no_items"), (2, "unknown_source"), (3, "source_disabled"), (4, "unknown_source")]
    assert accepted(out).count() == 0 and rejected(out).count() == 4


def test_session_setting_is_checked(spark):
    raw = spark.createDataFrame([(1, "A", "[]")], "response_id long, source_name string, content string")
    other = spark.newSession()
    other.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    raw = other.createDataFrame(raw.collect(), raw.schema)
    with pytest.raises(ValueError, match="allowDuplicateKeys"):
        clean_responses(raw, other.createDataFrame([("A", "http://a")], "name string, base_url string"))


def test_options_are_checked(spark):
    raw = spark.createDataFrame([(1, "A", "[]")], "response_id long, source_name string, content string")
    sources = spark.createDataFrame([("A", "http://a")], "name string, base_url string")
    with pytest.raises(ValueError):
        clean_responses(raw, sources, on_bad_item="ignore")
    with pytest.raises(ValueError):
        clean_responses(raw, sources, url_mode="x")


def test_decoding(spark):
    df = spark.createDataFrame([(b"caf\xc3\xa9 \xff\xfe x\xe2\x82",)], "c binary")
    assert df.select(decode_content("c")).first()[0] == b"caf\xc3\xa9 \xff\xfe x\xe2\x82".decode("utf-8", "replace")
    assert spark.createDataFrame([("t",)], "c string").select(decode_content("c")).first()[0] == "t"
    assert spark.createDataFrame([(12,)], "c int").select(decode_content("c")).first()[0] == "12"


def test_locating_and_parsing(spark):
    cases = {
        'x ```json [1] ``` y ```json [2]``` z': '[1] ``` y ```json [2]',
        '```json{"a": [1]}```': '[1]',
        'a [1] b [2] c': '[1] b [2]',
        '] x [': '] x [',
        'no brackets': 'no brackets',
        '': '',
        '[[1], 2]]': '[[1], 2]]',
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    assert [r[1] for r in df.select("i", locate_json("t")).orderBy("i").collect()] == list(cases.values())
    texts = {'[{"a": 1}, 2, {"b": 2}]': 2, ' {"a": 1} ': 1, '"s"': 0, '[]': 0, '[1],[2]': None, 'x': None, '': None, ' ': None, 'null': 0}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = with_parsed_items(df, "t", "items").select("i", F.when(F.col("items").isNotNull(), F.size("items")).alias("n")).orderBy("i").collect()
    assert [r.n for r in rows] == list(texts.values())


def test_no_shuffle_before_the_load(spark):
    from catalog.spark_queries import QUERIES

    plan = QUERIES["clean_batch"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    rows = [line for line in plan.split("Final Plan")[0].splitlines() if "Exchange hashpartitioning" in line]
    # What is shuffled is the registry's ids alone; the blacklist is reduced before, and once.
    assert all("source_key" in line for line in rows), rows
    assert plan.split("Final Plan")[0].count("Exchange") < 8
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_numbers_that_are_none(clean):
    """NaN and Infinity are numbers like 7: as a headline they fail the batch, inside a text they are words."""
    for number in ("7", "NaN", "-Infinity", "Infinity"):
        content = '[{"headline": %s, "href": "/x"}, {"headline": "The NaN: Infinity, \\"NaN\\" \\\\", "href": "/y", "n": [NaN, -Infinity]}]' % number
        assert [(r.pos, r.reason) for r in clean([content])] == [(None, "bad_batch")]
        rows = clean([content], on_bad_item="quarantine")
        assert sorted((r.pos, r.reason, r.headline if r.reason is None else None) for r in rows) == [
            (0, "bad_item", None), (1, None, 'The NaN: Infinity, "NaN" \\')]
    assert [r.reason for r in clean(['[{"headline": "a b", "href": "/x"}, NaNy]'])] == ["parse_error"]
    assert [r.reason for r in clean(['[{"headline": "a b", "href": "/x", NaN: 1}]'])] == ["parse_error"]
    assert [r.headline for r in clean(['[{"headline": "a b", "href": "/x", "s": NaN}]'])] == ["a b"]


def test_one_bad_element_costs_itself(clean):
    """An array that is no JSON: quarantine reads its elements one by one, else the batch fails."""
    good = '{"headline": "Good, \\"one\\" [a] {b}", "href": "/x", "more": [1, {"y": [2]}]}'
    for bad in ('{"headline": "Cut" "href": "/y"}', '{"headline": "a b", "href": }', "{]", "{[x]}"):
        content = f'[{good}, {bad}, 3, "x, [y", {good}]'
        rows = clean([content], on_bad_item="quarantine")
        if bad == "{]":  # brackets that are not of a pair still part the elements
            assert [(r.id, r.reason) for r in rows if r.reason is None] == [("good-one-a-b", None), ("good-one-a-b-1", None)]
        else:
            assert [(r.pos, r.id, r.reason) for r in rows] == [(0, "good-one-a-b", None), (1, None, "bad_item"), (2, "good-one-a-b-1", None)]
        assert [r.reason for r in clean([content])] == ["parse_error"]
    assert [r.reason for r in clean(["[{bad}, 1]"], on_bad_item="quarantine")] == ["parse_error"]


def test_one_large_element_costs_itself(clean):
    large = '{"headline": "Large one", "href": "/l", "body": "%s"}' % ("x" * 3000)
    content = f'[{{"headline": "Good one", "href": "/x", "n": NaN}}, {large}, {{oops}}, {{"headline": "Next one", "href": "/z"}}]'
    rows = clean([content], on_bad_item="quarantine", max_item_bytes=2000)
    assert [(r.pos, r.id, r.reason) for r in rows] == [
        (0, "good-one", None), (1, None, "too_large"), (2, None, "bad_item"), (3, "next-one", None)]


def plain_elements(text):
    """By the depth of every character outside of strings; an unpaired quote is a character."""
    out, depth, at = [""], 0, 0
    while at < len(text):
        end = at + 1
        if text[at] == '"':
            close = at + 1
            while close < len(text) and text[close] != '"':
                close += 2 if text[close] == "\\" else 1
            end = close + 1 if close < len(text) else at + 1
        elif text[at] == "\\":
            end = at + 2
        depth += (text[at] in "[{") - (text[at] in "]}")
        if text[at] == "," and depth == 0:
            out.append("")
        else:
            out[-1] += text[at:end]
        at = end
    return out


def test_elements_of_odd_arrays(spark):
    """Paired and unpaired brackets and quotes, of any depth, and the character that stands between parts."""
    draw = random.Random(5)
    odd = ["", ",", " , ", "[" * 8 + "a,b" + "]" * 8 + ",c", "[" * 9 + "a,b" + "]" * 9 + ",c", "a\x03,b", '"a', '{"a": "x, y"}, "z', "a],b[,c", "\n,\n"]
    odd += ["".join(draw.choices(["a", ",", "[", "]", "{", "}", '"', '\\"', "\\\\", " ", "\n", "[]", '{"k": [1, 2]}', '"s, t"'], k=draw.randint(1, 14))) for _ in range(3000)]
    # A backslash outside of strings means nothing to the plain version's quotes.
    odd = [text for text in odd if text.count('"') % 2 == 0 or "\\" not in text]
    df = spark.createDataFrame([(text,) for text in odd], "body string").repartition(8)
    have = {r["body"]: r["parts"] for r in df.select("body", array_elements(F.concat(F.lit(" ["), "body", F.lit("]\n"))).alias("parts")).collect()}
    assert {text: have[text] for text in odd} == {text: plain_elements(text) for text in odd}


def test_paired_arrays_are_cut_without_tokens(spark, monkeypatch):
    """Only what patterns cannot cut is read token by token."""
    monkeypatch.setattr(responses, "prefix_sums", lambda steps: F.raise_error(F.lit("token by token")).cast("array<bigint>"))
    parts = lambda body: spark.range(1).select(array_elements(F.concat(F.lit(body), F.lit("")))).first()[0]
    assert parts('[{"a": [1, {"b": "c, d"}]}, {bad [{}]}, 5]') == ['{"a": [1, {"b": "c, d"}]}', " {bad [{}]}", " 5"]
    with pytest.raises(Exception, match="token by token"):
        parts("[a], b[]")
