"""Licence scans, against plain search."""

import re

import pytest

from newsloom.llm import licenses
from newsloom.llm.license_texts import PHRASES, TEMPLATES
from tests.llm.tables import DOCS, clashing, edge, none, prose


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def common(a, b):
    """Longest common subsequence."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain(text, window=4, least=0.9, drift=8):
    """(n_words, n_base, first, last, base labels, labels of templates, greatest share)"""
    have = words(text)
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(have)) if have[i:i + len(phrase.split())] == phrase.split()]
    shares = {}
    for label, texts in TEMPLATES.items():
        for template in map(words, texts):
            seeds = {tuple(template[j:j + window]): [] for j in range(len(template) - window + 1)}
            for j in range(len(template) - window + 1):
                seeds[tuple(template[j:j + window])].append(j)
            for d in {i - j for i in range(len(have)) for j in seeds.get(tuple(have[i:i + window]), ())}:
                share = common(have[max(0, d - drift):max(0, d + len(template) + drift)], template) / len(template)
                shares[label] = max(share, shares.get(label, 0))
    found = {label: s for label, s in shares.items() if s >= least}
    base = sorted({label for _, label in places})
    return (len(have), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(base),
            ",".join(sorted({*base, *found})), max(found.values(), default=0.5 if places else 0.0))


def notices():
    """Whole templates, and ones with words changed, added and left out, in prose."""
    rows = []
    for n, text in enumerate(t for texts in TEMPLATES.values() for t in texts):
        part = text.split()
        few = [w for i, w in enumerate(part) if i % 25 != 13]
        more = [x for i, w in enumerate(part) for x in ([w, "really"] if i % 20 == 10 else [w])]
        other = ["other" if i % 15 == 7 else w for i, w in enumerate(part)]
        half = part[:len(part) // 2] if len(part) > 12 else part[:2]
        for k, form in enumerate((part, few, more, other, half)):
            rows.append((10 * n + k, prose(n, 40) + "\n * " + " ".join(form).upper() + ".\n" + prose(n + 1, 30), "en", "s", 1))
    rows.append((9000, ("Released under the MIT License. " * 500), "en", "s", 1))
    rows.append((9001, "The MIT\nLicense-Mit license, Apache (License) general public licenses général public license général", "en", "s", 1))
    return rows


def result(df):
    found = licenses.license_scan(df).collect()
    return sorted(repr(tuple(r)[:8]) for r in found)


@pytest.mark.parametrize("table", [
    edge, clashing, none, lambda s: s.read.parquet("/root/testdata/sf0.001/documents.parquet"), lambda s: s.createDataFrame(notices(), DOCS).repartition(3)])
def test_license_scan(spark, table):
    docs = table(spark)
    assert result(docs) == sorted(repr((r["doc_id"], *plain(r["text"]))) for r in docs.collect())


def test_changed_notices_are_found(spark):
    docs = spark.createDataFrame(notices()[:-2], DOCS)
    found = {r["doc_id"]: r for r in licenses.license_scan(docs).collect()}
    names = [label for label, texts in TEMPLATES.items() for _ in texts]
    for n, label in enumerate(names):
        assert label in found[10 * n]["labels"].split(",") and found[10 * n]["score"] == 1.0
        assert any(s["label"] == label and s["low"] <= 40 <= s["high"] + 8 for s in found[10 * n]["spans"])
        if not label.endswith("notice") and label != "unlicense-text":
            assert all(label in found[10 * n + k]["labels"].split(",") for k in (1, 2, 3))


def test_copies_far_apart_are_spans_of_their_own(spark):
    text = TEMPLATES["mit-text"][0]
    docs = spark.createDataFrame([(1, f"{text} {prose(1, 400)} {text} {prose(2, 100)}", "en", "s", 1)], DOCS)
    spans = [s for s in licenses.license_scan(docs).first()["spans"] if s["label"] == "mit-text"]
    size = len(words(text))
    assert [(s["low"], s["high"], s["share"]) for s in spans if s["share"] == 1.0] == [(0, 0, 1.0), (size + 400, size + 400, 1.0)]


def test_very_long_text(spark):
    """A million words with a licence at the end."""
    docs = spark.createDataFrame([(1, "plain words stand here " * 250_000 + TEMPLATES["bsd-text"][0], "en", "s", 1)], DOCS)
    found = licenses.license_scan(docs).first()
    assert found["labels"] == "bsd-text" and found["score"] == 1.0


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError):
        licenses.license_scan(none(spark), templates={"x": ["too short here"]})
