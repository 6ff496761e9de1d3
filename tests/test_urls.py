import random
import re
import unicodedata
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from newsloom.functions import urls

BITS = ["http:", "https:", "HTTP:", "ftp:", "mailto:", "//", "/", "/", "example.com", "[::1]", "[", "]", "1.2.3.4", "[1.2.3.4]",
        "[v1.x]", "?", "#", ";", "&", "=", " ", "  ", "\t", "é", "中", "%20", "%", "~", "*", "+", "a", "B", "..", "@", ":", "'",
        "|", "\\", "^", "`", "{", "\x00", "\x7f", " ", "​", "℀", "!", "(", ",", "k=v", " k = v ", "x;y", "www."]


def random_urls(n=4000, seed=11):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        body = "".join(rng.choice(BITS) for _ in range(rng.randrange(0, 9)))
        out.append(rng.choice(["", "", "http://example.com", "https://h/", "//h"]) + body)
    return out


def run(spark, values, step):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, url string")
    return [r.out for r in step(df).select("i", "out").orderBy("i").collect()]


def model_part(url, build, fallback):
    try:
        return build(urlparse(url))
    except ValueError:
        return fallback


def test_parts_agree_with_the_standard_library(spark):
    values = random_urls()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, url string")
    rows = urls.with_url_parts(df, "url").withColumn("bad", urls.invalid_netloc(F.col("netloc"))).orderBy("i").collect()
    for value, row in zip(values, rows):
        want = model_part(value, tuple, None)
        if want is None:
            assert row.bad, value
        else:
            assert not row.bad, value
            assert tuple(row[n] for n in urls.PART_NAMES) == want, value


def test_local_form_of_any_url(spark):
    values = random_urls() + [None]
    got = run(spark, values, lambda df: urls.with_clean_url(df, "url", "out"))
    plain = run(spark, [v and re.sub("[^ -~]", "", v) for v in values], lambda df: urls.with_clean_url(df, "url", "out"))
    for value, have, same in zip(values, got, plain):
        assert (have is None) == (value is None) and have == same
        if have is None:
            continue
        assert re.fullmatch("[!-~]*", have), value
        shown = re.sub("[^ -~]", "", value).strip()
        bad = model_part(re.sub(" +", "-", shown), lambda p: False, True)
        if bad:
            assert have == re.sub(" +", "-", shown)
            continue
        path = model_part(have, lambda p: p.path, "")
        assert re.fullmatch("[A-Za-z0-9._~/%;-]*", path), value
        assert re.fullmatch("[A-Za-z0-9._~=&%+-]*", model_part(have, lambda p: p.query, "")), value
        assert model_part(have, lambda p: p.netloc, "") == model_part(re.sub(" +", "-", shown), lambda p: p.netloc, ""), value


def test_ci_form_of_any_url(spark):
    values = random_urls() + [None]
    clean = lambda df: urls.with_clean_url(df, "url", "out", "ci")
    got = run(spark, values, clean)
    for value, have in zip(values, got):
        if not value:
            assert have == value
            continue
        shown = "".join(c for c in value if unicodedata.category(c)[0] != "C").strip()
        bad = model_part(shown, lambda p: False, True)
        assert (have is None) == bad, value
        if bad:
            continue
        # Nothing but white space and empty parts go, and no blank parameter stays.
        bare = lambda text: re.sub(r"[\s/&;?#]+", "", text).lower()
        assert bare(have) == bare(shown), value
        query = have.partition("#")[0].partition("?")[2]
        assert all(q == q.strip() and q for q in query.split("&")) or not query, value


LITERAL = {
    "http://e.com/a b/ c ?x = 1&&y= 2 #f ": ("http://e.com/a-b/-c-?x-=-1&&y=-2-#f", "http://e.com/a b/c?x=1&y=2#f"),
    "HTTP://E.com//a//": ("http://E.com//a//", "http://E.com/a"),
    "//e.com/é;p?é=é": ("//e.com/;p?=", "//e.com/é;p?é=é"),
    "mailto:a@b c": ("mailto:a%40b-c", "mailto:/a@b c"),
    "/x/./../y?a+b~*": ("/x/./../y?a%2Bb~%2A", "/x/./../y?a+b~*"),
    "http://[x/y z": ("http://[x/y-z", None),
    "?a=%20": ("?a=%2520", "?a=%20"),
    " ": ("", ""),
}


@pytest.mark.parametrize("place,mode", [(0, "local"), (1, "ci")])
def test_literal_forms(spark, place, mode):
    got = run(spark, list(LITERAL), lambda df: urls.with_clean_url(df, "url", "out", mode))
    assert dict(zip(LITERAL, got)) == {url: forms[place] for url, forms in LITERAL.items()}


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        urls.with_clean_url(spark.range(1).selectExpr("'x' url"), "url", "out", "other")


@pytest.mark.parametrize("literal,ok", [
    ("::", True), ("::1", True), ("1::", True), ("1:2:3:4:5:6:7:8", True), ("1:2:3:4:5:6:7::", True),
    ("::2:3:4:5:6:7:8", True), ("1:2:3:4:5:6:1.2.3.4", True), ("::ffff:1.2.3.4", True), ("fe80::1%eth0", True),
    ("v1.a", True), ("1:2:3:4:5:6:7:8:9", False), ("1:2:3:4:5:6:7:8::", False), ("1::2::3", False), ("12345::", False),
    ("1.2.3.4", False), ("", False), ("v.a", False), ("g::", False), ("::1.2.3.256", False), ("1:2", False),
])
def test_bracketed_hosts(spark, literal, ok):
    row = spark.range(1).select(urls.invalid_netloc(F.lit(f"[{literal}]")).alias("bad")).first()
    assert row.bad != ok
    assert ok == model_part(f"http://[{literal}]/", lambda p: True, False)


def test_local_examples(spark):
    cases = {
        "http://example.com/path with spaces": "http://example.com/path-with-spaces",
        "http://example.com/search?q=test query&cat=news": "http://example.com/search?q=test-query&cat=news",
        "http://example.com/page#section 1": "http://example.com/page#section-1",
        "http://example.com/path%20with%25spaces": "http://example.com/path%2520with%2525spaces",
        "  https://example.com/a,b@c ": "https://example.com/a%2Cb%40c",
        "": "",
        None: None,
    }
    assert run(spark, list(cases), lambda df: urls.with_clean_url(df, "url", "out")) == list(cases.values())


def test_valid_domain_and_path(spark):
    values = random_urls() + ["http//example.com", "www.no-scheme.com", "http://www.example.com/path", "http://", "", None]
    known = [v or "" for v in values]
    got = run(spark, values, lambda df: urls.with_valid_url(df, "url", "out"))
    assert got == [model_part(v, lambda p: bool(p.scheme and p.netloc), False) for v in known]
    got = run(spark, values, lambda df: urls.with_source_domain(df, "url", "out"))
    assert got == [model_part(v, lambda p: p.netloc.replace("www.", ""), "") for v in known]
    got = run(spark, values, lambda df: urls.with_href_path(df, "url", "out"))
    assert got == [model_part(v, lambda p: p.path, "") for v in known]


def test_resolve_href(spark):
    cases = [
        ("/news/1", "http://e.com", "http://e.com/news/1"),
        ("news/1", "http://e.com//", "http://e.com/news/1"),
        ("//cdn.com/x", "HTTPS://e.com", "https://cdn.com/x"),
        ("http://o.com/x", "http://e.com", "http://o.com/x"),
        ("HTTP://o.com/x", "http://e.com", "http://e.com/HTTP://o.com/x"),
        ("../x", "http://e.com/a/", "http://e.com/a/../x"),
        ("mailto:a@b", "http://e.com", "http://e.com/mailto:a@b"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, href string, base string, want string")
    rows = urls.with_resolved_href(df, "href", "base", "got").orderBy("i").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
