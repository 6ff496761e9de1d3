"""Phrase counts and collocations, against plain counting."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from newsloom.llm import phrases
from tests.llm.tables import DOCS, clashing, edge, none, prose


def plain_counts(rows, depth=3):
    """{(lang, phrase): (n, preceded, followed)}"""
    out = defaultdict(lambda: [0, 0, 0])
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            out[lang, ""][0] += len(words)
            for i in range(len(words)):
                for k in range(1, min(depth, len(words) - i) + 1):
                    found = out[lang, " ".join(words[i:i + k])]
                    found[0] += 1
                    found[1] += i > 0
                    found[2] += i + k < len(words)
    return {key: tuple(v) for key, v in out.items()}


def plain_collocations(rows, least=10, best=2000):
    counts = {key: v[0] for key, v in plain_counts(rows).items()}
    found = defaultdict(list)
    many = {key: a for key, a in counts.items() if " " in key[1] and a >= least}
    for (lang, phrase), a in many.items():
        words = phrase.split(" ")
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, " ".join(words[:k])], counts[lang, " ".join(words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        longer = [b for (other, text), b in many.items() if other == lang and len(text.split(" ")) > len(words) and f" {phrase} " in f" {text} "]
        if not any(100 * b >= 50 * a for b in longer):
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, phrase.encode(), left, right))
    return sorted(
        (lang, i + 1, p.decode(), -a, left, right, counts[lang, ""], -s)
        for lang, rows_ in found.items() for i, (s, a, p, left, right) in enumerate(sorted(rows_)[:best]))


def rows_of(docs):
    return [(r["lang"] if "lang" in docs.columns else None, r["text"]) for r in docs.collect()]


@pytest.mark.parametrize("depth", [1, 2, 3, 5])
def test_index_counts_all(depth):
    ids = np.random.default_rng(depth).integers(0, 9, 3000)
    want = Counter(tuple(map(int, ids[i:i + k])) for k in range(1, depth + 1) for i in range(len(ids) - k + 1) if 0 not in ids[i:i + k])
    have = {}
    for rows, size, before, after in phrases.PhraseIndex(ids, depth).phrases():
        for row, n, b, a in zip(rows.tolist(), size.tolist(), before.tolist(), after.tolist(), strict=True):
            have[tuple(row)] = n
            assert 0 <= b <= n and 0 <= a <= n
    assert have == dict(want)


def test_keys_wider_than_a_number():
    """More different words than three of them fit into 63 bits."""
    ids = np.concatenate([np.arange(1, 1 << 22), [5, 6, 7, 0, 5, 6, 7]])
    found = {tuple(r): c for rows, size, _, _ in phrases.PhraseIndex(ids, 3).phrases() for r, c in zip(rows[size > 2].tolist(), size[size > 2].tolist(), strict=True)}
    assert found == {(5,): 3, (6,): 3, (7,): 3, (5, 6): 3, (6, 7): 3, (5, 6, 7): 3}


@pytest.mark.parametrize("most", [1, 2, 3, 7, 30])
def test_cut_texts_count_alike(most):
    text = b"a b  c. d E f\tg h i j,k l m  n o p  \t q r.s t   " * 3
    have = Counter()
    for part, sign in phrases._parts(text, most, 3):
        for (_, phrase), (n, _, _) in plain_counts([("x", part.decode())]).items():
            have[phrase] += sign * n
    assert {p: n for p, n in have.items() if n} == {p: n for (_, p), (n, _, _) in plain_counts([("x", text.decode())]).items()}


@pytest.mark.parametrize("table", [edge, none, lambda s: s.read.parquet("/root/testdata/sf0.001/documents.parquet")])
@pytest.mark.parametrize("shard_words", [64, 1 << 19])
def test_phrase_counts(spark, table, shard_words):
    docs = table(spark)
    have = {(r["lang"], r["phrase"]): r["n"] for r in phrases.phrase_counts(docs, shard_words=shard_words).collect() if r["n"]}
    assert have == {key: v[0] for key, v in plain_counts(rows_of(docs)).items() if v[0]}


@pytest.mark.parametrize("bits", [26, 15])
def test_rounds_find_what_is_frequent(spark, bits):
    """The same phrases, whether the bits tell them apart or nearly all are set."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    have = {(r["lang"], r["phrase"]): (r["n"], r["preceded"], r["followed"]) for r in phrases.phrase_counts(docs, depth=4, at_least=5, filter_bits=bits).collect() if r["phrase"]}
    assert have == {key: v for key, v in plain_counts(rows_of(docs), 4).items() if v[0] >= 5 and key[1]} and any(len(p.split()) == 4 for _, p in have)


def test_neighbours_in_whole_texts(spark):
    docs = spark.createDataFrame([(1, "a b c. a b\nb c d e", "en", "s", 1), (2, "b c", "en", "s", 1), (3, "b c", None, "s", 1)], DOCS)
    have = {(r["lang"], r["phrase"]): (r["n"], r["preceded"], r["followed"]) for r in phrases.phrase_counts(docs).collect() if r["phrase"]}
    assert have == {key: v for key, v in plain_counts(rows_of(docs)).items() if key[1]}


@pytest.mark.parametrize("shard_words", [500, 1 << 19])
def test_collocations(spark, shard_words):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(i, "Odd Pair here. odd pair there, odd pair of " + prose(i % 4, 30), [None, "en", "fr"][i % 3]) for i in range(60)], "doc_id bigint, text string, lang string")
    docs = docs.unionByName(odd)
    have = phrases.collocations(docs, shard_words=shard_words).collect()
    assert sorted(map(tuple, have)) == plain_collocations(rows_of(docs))
    few = phrases.collocations(docs, best=3).collect()
    assert sorted(map(tuple, few)) == plain_collocations(rows_of(docs), best=3)


def test_collocations_of_odd_tables(spark):
    named = "doc_id bigint, text string, lang string, phrase string, n int, words int, k int, score int, a int"
    docs = spark.createDataFrame([(1, "so so so so so so so so so so so", None, "x", 1, 2, 3, 4, 5)], named)
    assert sorted(map(tuple, phrases.collocations(docs).collect())) == plain_collocations(rows_of(docs))
    assert phrases.collocations(none(spark)).count() == 0
    assert phrases.collocations(clashing(spark), lang_col="source").count() == 0


def test_scores_pass_64_bits(spark):
    a, left, right = 999_999_999_999, 10**14 + 7, 10**12 + 1
    df = spark.createDataFrame([(a, left, right)], "a bigint, l bigint, r bigint")
    assert df.select(phrases._score(df.a, df.l, df.r)).first()[0] == 1_000_000 * a * a // (left * right)
