import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from newsloom.functions import text

ODD = [" ", " ", "　", "\x1c", "\x85", "\t", "\n", "​", "­", "\x00", "\x7f", "́", "İ", "ß", "_", "-", "é", "中", "7", "²", "\U0001f600", "A", "b", " ", "!", "."]


def random_texts(n=3000, seed=5):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randrange(0, 14))) for _ in range(n)]


def run(spark, values, build):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v string")
    return [r.out for r in df.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_and_control_chars_agree_with_a_model(spark):
    values = random_texts()
    assert run(spark, values, text.strip_text) == [v.strip() for v in values]
    want = ["".join(c for c in v if unicodedata.category(c)[0] != "C") for v in values]
    assert run(spark, values, text.remove_control_chars) == want


def model_slug(value, headline):
    kept = "".join(c for c in value.lower() if c.isalnum() or c == "_" or c == "-" or c.isspace())
    slug = re.sub(r"[-\s]+", "-", kept).strip("-")[:100]
    return slug or "article-" + hashlib.sha1(headline.encode()).hexdigest()[:8]


def test_item_slug_agrees_with_a_model(spark):
    values = [v.strip() for v in random_texts()] + ["word " * 40, "x" * 99 + " y z", "!!!???", ""]
    got = run(spark, values, lambda c: text.item_slug(F.lit(""), c))
    assert got == [model_slug(v, v) for v in values]


@pytest.mark.parametrize("item_id,headline,want", [
    ("", "!!!???", "article-8b8a7981"),
    (None, "!!!???", "article-8b8a7981"),
    ("", "", "article-da39a3ee"),
    ("My ID", "Other", "my-id"),
    ("???", "!!!???", "article-8b8a7981"),
    ("", "  --Test -- Headline --  ", "test-headline"),
])
def test_item_slug_cases(spark, item_id, headline, want):
    df = spark.createDataFrame([(item_id, headline)], "id string, headline string")
    assert df.select(text.item_slug(F.col("id"), F.col("headline"))).first()[0] == want


def test_a_hyphen_at_the_cut_stays(spark):
    [slug] = run(spark, ["a" * 99 + " tail"], lambda c: text.item_slug(F.lit(None).cast("string"), c))
    assert slug == "a" * 99 + "-"


def test_headline_slug(spark):
    cases = {
        "Headline with !@#$%^&*()_+": "headline-with",
        "Multiple---Hyphens---Together": "multiple-hyphens-together",
        "Non-ASCII chars like éàçü": "non-ascii-chars-like",
        " leading and trailing ": "leading-and-trailing",
        "under_score": "underscore",
        "no break": "no-break",
        "": "",
        "y" * 120: "y" * 120,
    }
    assert run(spark, list(cases), text.headline_slug) == list(cases.values())


def test_numbered_slug(spark):
    digest = hashlib.sha1(("s" * 100).encode()).hexdigest()[:16]
    cases = [
        ("s", 0, "s"), ("s", 1, "s-1"), ("s", 12, "s-12"),
        ("s" * 98, 9, "s" * 98 + "-9"),
        ("s" * 99, 1, "s" * 99 + "-"),
        ("s" * 100, 1, "s" * 81 + "~" + digest + "-1"),
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, s string, k int, want string")
    rows = df.withColumn("got", text.numbered_slug(F.col("s"), F.col("k"))).orderBy("i").collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    long = spark.range(0, 3000).select(text.numbered_slug(F.lit("t" * 98), F.col("id")).alias("n"))
    assert long.distinct().count() == 3000 and long.filter(F.length("n") > 100).count() == 0
