"""The Merkle manifest, against a plain tree."""

from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import merkle
from newsloom.llm.queries import QUERIES
from tests.llm.tables import DOCS, clashing, edge, none, prose


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf(values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    """The levels of a tree, from the leaves to the root."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 16]) for i in range(0, len(levels[-1]), 16)])
    return levels


def way(levels, i):
    """(left, right) siblings of a leaf, level by level."""
    out = []
    for nodes in levels[:-1]:
        start = i - i % 16
        out.append((nodes[start:i], nodes[i + 1:start + 16]))
        i //= 16
    return out


def plain(rows, changed):
    """rows: (id, tree, leaf values, changed leaf values)"""
    trees = defaultdict(list)
    for id_, key, values, other in rows:
        trees[(key is not None, (key or "").encode())].append(((id_ is not None, id_ or 0), leaf(values), id_, leaf(other if changed else values)))
    keys = sorted(trees)
    grown = {k: tree([x[1] for x in sorted(trees[k])]) for k in keys}
    top = tree([grown[k][-1][0] for k in keys]) if keys else None
    out = []
    for n, k in enumerate(keys):
        for i, (_, own, id_, claim) in enumerate(sorted(trees[k])):
            path = way(grown[k], i) + way(top, n)
            root = claim
            for left, right in path:
                root = h(*left, root, *right)
            out.append((id_, own, grown[k][-1][0], top[-1][0], h(*(x for pair in path for side in pair for x in side)), root, root == top[-1][0]))
    return sorted(map(repr, out))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


@pytest.mark.parametrize("n, levels", [(1, 1), (1, 3), (16, 2), (17, 3), (255, 3), (4096, 4), (2750, 4), (40, 5), (60000, 5)])
def test_layout(n, levels):
    places = np.concatenate(merkle.places(n, levels))
    assert sorted(places) == list(range(len(places))) and merkle.places(n, levels)[-1][0] == 0
    digests = np.random.default_rng(n).integers(0, 256, (n, 32), np.uint8).tobytes()
    layout = merkle.grown(digests, levels)
    every = list(merkle.all_siblings(layout, n, levels))
    for i in (0, n // 2, n - 1):
        assert every[i] == merkle.siblings(layout, n, levels, i)
        assert merkle.folded(digests[32 * i:32 * i + 32].hex(), every[i]) == layout[:32].hex()


def test_halves_lie_together():
    """Of a full tree of four levels, the two upper ones come first, then the lower subtrees in turn."""
    levels = merkle.places(4096, 4)
    assert levels[3].tolist() == [0] and levels[2].tolist() == list(range(1, 17))
    assert levels[1].tolist() == list(range(17, 17 + 256 * 17, 17)) and levels[0][:17].tolist() == [*range(18, 34), 35]


@pytest.mark.parametrize("table", [edge, clashing, none, lambda s: s.read.parquet("/root/testdata/sf0.001/documents.parquet")])
def test_proofs(spark, table):
    docs = table(spark)
    cols = tuple(c for c in ("doc_id", "source", "lang", "n_chars", "text") if c in docs.columns)
    rows = [(r["doc_id"], r["source"], [r[c] for c in cols], [lowered(r[c]) if c == "text" else r[c] for c in cols]) for r in docs.collect()]
    for changed in ({}, {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}):
        have = merkle.merkle_proofs(docs, leaf_cols=cols, changed=changed).collect()
        assert sorted(map(repr, map(tuple, have))) == plain(rows, bool(changed))


@pytest.mark.parametrize("levels", [2, 3])
def test_subtrees_over_subtrees(spark, levels):
    """One tree of most rows, many small ones, ids not in the order of the rows, repeated rows."""
    rows = [(i * 7919 % 5000, f"text {i}", "en", "hot", i) for i in range(900)]
    rows += [(i, prose(i, 5), None, f"s{i % 300}é", None) for i in range(400)] + [(3, "same", "en", "hot", 1)] * 40 + [(None, None, None, None, None)] * 2
    docs = spark.createDataFrame(rows, DOCS).repartition(7)
    want = plain([(r[0], r[3], [r[0], r[3], r[2], r[4], r[1]], None) for r in rows], False)
    have = merkle.merkle_proofs(docs, levels=levels).collect()
    assert sorted(map(repr, map(tuple, have))) == want and all(r["verified"] for r in have)


def test_one_level_is_no_subtree(spark):
    with pytest.raises(ValueError):
        merkle.merkle_proofs(none(spark), levels=1)


def test_query_tampers_with_a_fifth(spark):
    found = {r["doc_id"]: r["verified"] for r in QUERIES["op11_manifest_layout"](spark, "/root/testdata/sf0.001").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert found == {d: crc32(str(d).encode()) % 5 != 0 or lowered(t) == t for d, t in texts.items()}
