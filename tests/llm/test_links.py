"""Operators on pairs, against all pairs."""

import pickle
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from newsloom.llm import components, embedding_links, simhash
from tests.llm.tables import clashing, edge, none, prose, texts_of


def reach(nodes, links):
    """Smallest node that each reaches."""
    low, near = {}, defaultdict(list)
    for a, b in links:
        near[a].append(b)
        near[b].append(a)
    for n in sorted(nodes):
        todo = [] if n in low else [n]
        while todo:
            x = todo.pop()
            if x not in low:
                low[x] = n
                todo += near[x]
    return low


def test_connected(spark):
    rng = np.random.default_rng(1)
    links = [tuple(map(int, x)) for x in rng.integers(0, 400, (260, 2))] + [(1000 + i, 1001 + i) for i in range(40)] + [(5, 5), (-7, 3), (-7, 3)]
    links += [(2000, 2001 + i) for i in range(300)]
    want = {k: v for k, v in reach({x for ab in links for x in ab}, links).items() if k != v}
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert dict(map(tuple, components.connected(df).collect())) == want
    assert components.connected(df.limit(0)).collect() == []


def plain_print(text):
    words = text.encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashed = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashed) > len(hashed))


@pytest.mark.parametrize("table", [edge, clashing, none, lambda s: s.read.parquet("/root/testdata/sf0.001/documents.parquet")])
def test_simhash_components(spark, table):
    docs = table(spark)
    prints = [(d, plain_print(t)) for d, t in texts_of(docs)]
    distinct = sorted({p for _, p in prints})
    links = [(i, j) for i, a in enumerate(distinct) for j, b in enumerate(distinct[:i]) if (a ^ b).bit_count() <= 2]
    group = reach(range(len(distinct)), links)
    least = {}
    for d, p in prints:
        if d is not None:
            g = group[distinct.index(p)]
            least[g] = min(d, least.get(g, d))
    want = [(d, f"{p:016x}", least.get(group[distinct.index(p)])) for d, p in prints]
    have = simhash.simhash_components(docs).collect()
    assert sorted(map(repr, map(tuple, have))) == sorted(map(repr, want))


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_balls_find_all(spark, radius):
    rng = np.random.default_rng(radius)
    base = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 12)]
    prints = list(base)
    for b in base:
        for flips in range(7):
            x = b
            for bit in rng.choice(64, flips, replace=False):
                x ^= 1 << int(bit)
            prints.append((x + (1 << 63)) % (1 << 64) - (1 << 63))
    prints = sorted(set(prints))
    near = [(a, b) for a in prints for b in prints if a > b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    have = [tuple(r) for r in simhash.fingerprint_links(df, radius).collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= radius for a, b in have)
    assert reach(prints, have) == reach(prints, near)


def test_odd_radius(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp bigint"), 3)


def plain_one_of_each(rows):
    """Ids left of (id, text) rows."""
    prints = [(d, plain_print(t)) for d, t in rows]
    distinct = sorted({p for _, p in prints})
    group = reach(range(len(distinct)), [(i, j) for i, a in enumerate(distinct) for j, b in enumerate(distinct[:i]) if (a ^ b).bit_count() <= 2])
    least = {}
    for d, p in prints:
        g = group[distinct.index(p)]
        least[g] = min((d is None, d or 0), least.get(g, (True, 0)))
    return sorted(((None if none else d) for none, d in least.values()), key=repr)


@pytest.mark.parametrize("table", [edge, clashing, none, lambda s: s.read.parquet("/root/testdata/sf0.001/documents.parquet")])
def test_one_of_each(spark, table):
    docs = table(spark)
    kept = simhash.one_of_each(docs)
    assert kept.schema.names == docs.schema.names
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == plain_one_of_each(texts_of(docs))
    rows = [tuple(r) for r in docs.collect()]
    assert all(tuple(r) in rows for r in kept.collect())


def test_one_of_equal_rows(spark):
    """Equal ids with other texts, equal rows, copies under many ids, rows without an id."""
    rows = [(i % 40, prose(i % 60, 80), i % 3) for i in range(240)] + [(None, prose(3, 80), 1), (None, "lonely words", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, `mark1` int").repartition(5)
    kept = simhash.one_of_each(docs).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == plain_one_of_each([(d, t) for d, t, _ in rows])
    prints = [plain_print(r["text"]) for r in kept]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])


# Vectors.

def plain_links(rows, cosine=0.98):
    ok = lambda v: bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [i for i, (_, v, label) in enumerate(rows) if label is not None and ok(v)]
    links = []
    for x, i in enumerate(good):
        for j in good[:x]:
            (_, v, a), (_, w, b) = rows[i], rows[j]
            if a == b and len(v) == len(w):
                v, w = np.array(v, float), np.array(w, float)
                if v @ w / np.sqrt(v @ v * (w @ w)) >= cosine:
                    links.append((i, j))
    group = reach(range(len(rows)), links)
    least, counts = {}, np.bincount([x for ab in links for x in ab], minlength=len(rows)) if links else np.zeros(len(rows), int)
    for i, (d, _, _) in enumerate(rows):
        if d is not None:
            least[group[i]] = min(d, least.get(group[i], d))
    return [(d, int(counts[i]), c := least.get(group[i]), d is not None and d == c) for i, (d, _, _) in enumerate(rows)]


def test_vectors(spark):
    rng = np.random.default_rng(2)
    rows = []
    for label in (0, 1, None):
        for _ in range(40):
            centre = rng.normal(size=16)
            for _ in range(5):
                v = centre + rng.normal(size=16) * 0.08
                rows.append((len(rows), v.astype(np.float32).astype(float).tolist(), label))
    centre = rng.normal(size=16)
    rows += [(5000 + i, (centre + rng.normal(size=16) * 0.02).astype(np.float32).astype(float).tolist(), 1) for i in range(150)]
    rows += [(6000 + i, rows[0][1], 0) for i in range(50)] + [(6100, rows[0][1], 1), (6101, [2 * x for x in rows[0][1]], 0)]
    rows += [(7000, None, 0), (7001, [], 0), (7002, [0.0] * 16, 0), (7003, [float("nan")] * 16, 0), (7004, [None, 1.0], 0),
             (7005, [float("inf")] * 16, 0), (7006, [1.0, 2.0], 0), (7007, [2.0, 4.0], 0), (7008, [1.0], 0), (None, rows[3][1], 0), (7009, rows[0][1], 0), (7009, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<double>, label int, row string")
    have = embedding_links.linked_vectors(df, bucket=8, chunk=16).collect()
    want = plain_links(rows)
    found, there = sum(r["n_links"] for r in have), sum(w[1] for w in want)
    assert 0.99 * there <= found <= there
    exact = embedding_links.linked_vectors(df, miss=1e-9).collect()
    assert sorted(map(repr, map(tuple, exact))) == sorted(map(repr, want))
    assert embedding_links.linked_vectors(df.limit(0)).collect() == []


def test_very_large_and_very_small_components(spark):
    """Squares of these components are no finite numbers, or zero."""
    rng = np.random.default_rng(4)
    base = [rng.normal(size=8) for _ in range(6)]
    rows = [(100 * i + k, ((b + rng.normal(size=8) * 0.01) * scale).tolist(), 1) for i, b in enumerate(base) for k, scale in enumerate((1e200, 1e-200, 1.0, 1e300))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    want = plain_links([(i, (np.array(v) / np.abs(v).max()).tolist(), label) for i, v, label in rows])
    assert sorted(map(repr, map(tuple, embedding_links.linked_vectors(df, miss=1e-9).collect()))) == sorted(map(repr, want))


def test_a_family_of_near_copies(spark):
    """2,000 unequal near copies alone, and as a third of all: their pairs meet, and buckets of more than a chunk are cut."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=16)
    family = [(i, (centre + rng.normal(size=16) * 0.002).tolist(), 1) for i in range(2000)]
    others = [(10_000 + i, rng.normal(size=16).tolist(), 1) for i in range(4000)]
    for rows, chunk in ((family, 600), (family + others, 16_384)):
        have = embedding_links.linked_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), chunk=chunk, bucket=64).collect()
        have = [r for r in have if r["vec_id"] < 2000]
        assert sum(r["n_links"] for r in have) >= 0.99 * 2000 * 1999 and {r["component_id"] for r in have} == {0}


def test_codes_are_balanced():
    sample = embedding_links.unit(np.random.default_rng(3).normal(size=(2000, 12)))
    codes = embedding_links.Codes(sample, 30)
    assert codes.of(sample).shape == (2000, 30) and np.allclose(codes.of(sample).mean(axis=0), 0.5, atol=0.01)
    assert pickle.loads(pickle.dumps(codes)).of(sample[:1]).shape == (1, 30)
