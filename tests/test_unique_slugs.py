import hashlib
import random
import time

import pytest
from pyspark.sql import functions as F

from newsloom.functions.batch_slugs import with_batch_slugs
from newsloom.operators import running
from newsloom.operators.slugs import with_unique_slugs


def names(slug):
    """All names of a slug, in order."""
    yield slug
    if len(slug) == 99:
        yield slug + "-"
    n = 0
    while True:
        n += 1
        if len(f"{slug}-{n}") <= 100:
            yield f"{slug}-{n}"
        else:
            tail = f"~{hashlib.sha1(slug.encode()).hexdigest()[:16]}-{n}"
            yield slug[: 100 - len(tail)] + tail


def model(slugs):
    taken, out = set(), []
    for slug in slugs:
        name = next(n for n in names(slug) if n not in taken)
        taken.add(name)
        out.append(name)
    return out


# The first batch has no number when it is a table's.
EDGE = [
    ["a", "a-1", "a", "a", "a-1", "b", "a-2"],
    ["slug", "slug", "diff-slug"],
    ["slug", "slug-1", "slug"],
    ["slug", "slug-1", "slug", "slug"],
    ["slug", "slug", "slug-1", "slug-1", "slug-1-1"],
    ["slug-1", "slug-1", "slug", "slug", "slug-1-1", "slug-1"],
    ["s" * 100] * 3,
    ["s" * 99] * 4 + ["s" * 99 + "-"] * 2,
    ["s" * 99 + "-"] + ["s" * 99] * 3,
    ["s" * 98] * 12 + ["s" * 98 + "-3"] * 2,
    ["s" * 97] * 102,
    ["a-1", "a-2", "a-3", "a", "a", "a", "a-01", "a-0"],
    ["a", "a", "a", "a", "a-1", "a-2", "a-3", "a-1-1", "a-1", "a-2"],
    [],
    ["only"],
]


def random_batches(n, size, seed):
    rng = random.Random(seed)
    long = ["s" * 97, "s" * 98, "s" * 99, "s" * 99 + "-", "s" * 100, "s" * 98 + "-1", "s" * 98 + "-4"]
    pool = ["a", "a", "a", "a-1", "a-2", "a-3", "a-1-1", "a-1-2", "a-2-1", "a-10", "a-01", "b", "b-1", "a-1-1-1"] + long
    return [[rng.choice(pool) for _ in range(rng.randrange(0, size))] for _ in range(n)]


def test_rows_hold_the_batches(spark):
    batches = EDGE + random_batches(600, 30, 3)
    df = spark.createDataFrame([(i, b) for i, b in enumerate(batches)], "i long, slugs array<string>")
    rows = with_batch_slugs(df, "slugs", "unique").orderBy("i").collect()
    for row, batch in zip(rows, batches):
        assert row.unique == model(batch), batch


def as_table(spark, batches, stride=1):
    data = [(i or None, pos * stride, slug) for i, batch in enumerate(batches) for pos, slug in enumerate(batch)]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "batch long, pos long, slug string")


def check_table(spark, batches, stride=1):
    out = with_unique_slugs(as_table(spark, batches, stride), ["batch"], "pos", "slug", "unique").collect()
    got = {(r.batch or 0, r.pos): r.unique for r in out}
    assert len(out) == len(got) == sum(map(len, batches))
    for i, batch in enumerate(batches):
        assert [got[i, pos * stride] for pos in range(len(batch))] == model(batch), batch


def test_tables_hold_the_batches(spark):
    check_table(spark, EDGE + random_batches(150, 30, 7))


def test_tables_without_clashes(spark):
    check_table(spark, [["a"] * 7 + ["b"] + ["s" * 99] * 4, ["a", "c", "a"]])


def test_big_groups_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(running, "BLOCK_BITS", 2)
    check_table(spark, [["a"] * 90 + ["a-5"] * 3 + ["a"] * 40, ["b", "c"] * 30] + random_batches(20, 60, 9))


def test_many_own_slugs_among_the_names(spark):
    rng = random.Random(2)
    batch = ["v"] * 150 + [f"v-{i}" for i in range(1, 140)] * 2
    rng.shuffle(batch)
    check_table(spark, [batch])


def test_running_total_has_no_single_task_groups(spark, monkeypatch):
    monkeypatch.setattr(running, "BLOCK_BITS", 3)
    df = spark.range(500).selectExpr("1 as g", "id * 3 as o", "id as v")
    out = running.with_running_total(df, ["g"], "o", "t", F.col("v")).orderBy("o").collect()
    assert [r.t for r in out] == [i * (i + 1) // 2 for i in range(500)]


def test_blocks_follow_the_rows(spark, monkeypatch):
    """Order values far apart, and crowded, in one large group and many small ones: few blocks, no block a row."""
    monkeypatch.setattr(running, "BLOCK_BITS", 6)
    monkeypatch.setattr(running, "MOST_BLOCKS", 16)
    rows = [(None if i % 2 else 7, (i * i * i * 7919) - 10**9, i % 5) for i in range(3000)] + [(100 + i % 200, i * 10**12, 1) for i in range(1000)]
    df = spark.createDataFrame(rows, "g int, o bigint, v int")
    have = sorted((repr(r.g), r.o, r.t) for r in running.with_running_total(df, ["g"], "o", "t", F.col("v")).collect())
    want, totals = [], {}
    for g, o, v in sorted(rows, key=lambda r: r[1]):
        totals[g] = totals.get(g, 0) + v
        want.append((repr(g), o, totals[g]))
    assert have == sorted(want)
    bounds = running._bounds(df.withColumn("__keys", F.struct("g")), "o")
    assert sorted(len(r["__bounds"]) for r in bounds.collect()) == [15, 15]


def test_long_row_with_clashes(spark):
    """10,000 items of one row, half of them named like the numbers of the others."""
    batch = ["v"] * 5_000 + [f"v-{i}" for i in range(1, 5_001)]
    random.Random(4).shuffle(batch)
    df = spark.createDataFrame([(batch,)], "slugs array<string>")
    start = time.perf_counter()
    row = with_batch_slugs(df, "slugs", "unique").first()
    assert time.perf_counter() - start < 30
    taken, last = set(), 0
    for slug, name in zip(batch, row.unique, strict=True):
        if slug == "v" and slug in taken:
            last = next(n for n in range(last + 1, 20_000) if f"v-{n}" not in taken)
            slug = f"v-{last}"
        elif slug in taken:
            slug = next(x for x in names(slug) if x not in taken)
        taken.add(slug)
        assert name == slug
