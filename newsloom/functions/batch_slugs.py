"""Slugs that are unique within one batch, when the batch is one row."""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.steps import computed_once
from newsloom.functions.text import MAX_SLUG, numbered_slug

# How a slug ends that may be another slug's numbered name.
NUMBER = "-([1-9][0-9]{0,17})$"


def with_batch_slugs(df: DataFrame, slugs: str, to: str) -> DataFrame:
    """Add an array of unique slugs for the array `slugs`, in the same order.

    In array order, each slug takes the first of its names (see
    `numbered_slug`) that is still free. Three steps, each only for the rows
    that need it:

    1. no repeats: the slugs themselves;
    2. the r-th copy of a slug takes its r-th name, found by sorting. This is
       the answer unless a numbered name is also some item's own slug;
    3. only then, `_settled`.
    """
    distinct, order, ranked, named = "__distinct", "__order", "__ranked", "__named"
    size = F.size(slugs)
    df = df.withColumn(distinct, F.array_distinct(slugs))
    repeats = F.size(distinct) < size
    df = df.withColumn(
        order,
        F.when(repeats, F.sort_array(F.transform(slugs, lambda s, i: F.struct(s.alias("slug"), i.alias("pos"))))),
    )
    at = lambda i: F.get(order, i)
    df = df.withColumn("__starts", F.when(repeats, _run_starts(order, "slug")))
    copies = lambda start, j: F.transform(
        F.sequence(start, F.coalesce(F.get("__starts", j + 1), size) - 1),
        lambda i: F.struct(at(i)["pos"].alias("pos"), at(i)["slug"].alias("slug"), (i - start).alias("k")),
    )
    df = df.withColumn(ranked, F.sort_array(F.flatten(F.transform("__starts", copies))))
    df = df.withColumn(named, F.transform(ranked, lambda r: numbered_slug(r["slug"], r["k"])))
    clash = F.size(F.array_distinct(named)) < size
    df = df.withColumn("__clash", F.when(repeats, clash).otherwise(F.lit(False)))
    df = _with_settled(df, order, "__starts", "__clash", "__settled")
    df = df.withColumn(
        to,
        F.when(~repeats, F.col(slugs)).when(~F.col("__clash"), F.col(named)).otherwise(F.col("__settled")),
    )
    return computed_once(df.drop(distinct, order, "__starts", ranked, named, "__clash", "__settled"), to)


def _run_starts(array: str, field: str) -> Column:
    """Where a sorted array of structs begins a new value of a field; empty for an empty array."""
    new = lambda i: (i == 0) | (F.get(array, i)[field] != F.get(array, i - 1)[field])
    return F.when(F.size(array) > 0, F.filter(F.sequence(F.lit(0), F.size(array) - 1), new)).otherwise(F.array().cast("array<int>"))


def _with_settled(df: DataFrame, order: str, starts: str, clash: str, to: str) -> DataFrame:
    """Names for rows in which slugs read like numbered names of other slugs.

    Such a slug (a child) goes to whoever comes first: its own first item, or
    the copy of the other slug (its parent) that gets as far as its number. A
    parent is shorter than its children, so slugs are taken by length. Number k
    is reached by the copy that follows k - b numbered ones, b being the lower
    numbers that children hold. So each child is decided by one comparison, and
    the copies take the numbers that are left. A child that came too late
    numbers its first item as well.
    """
    groups, pairs, runs, parents, by_length = "__groups", "__pairs", "__runs", "__parents", "__by_length"
    count = F.size(order)
    group = lambda start, j: F.struct(
        F.get(order, start)["slug"].alias("slug"), F.get(order, start)["pos"].alias("first"), start.alias("start"),
        (F.coalesce(F.get(starts, j + 1), count) - start).alias("copies"))
    df = computed_once(df.withColumn(groups, F.when(F.col(clash), F.transform(starts, group))), order, starts, groups)
    df = computed_once(df.withColumn("__names", F.transform(groups, lambda g: g["slug"])), "__names")

    def pair(g, i):
        slug, number = g["slug"], F.regexp_extract(g["slug"], NUMBER, 1)
        bare = (F.length(slug) == MAX_SLUG) & F.endswith(slug, F.lit("-"))
        parent = F.when(bare, F.left(slug, F.lit(MAX_SLUG - 1))).otherwise(F.left(slug, F.length(slug) - F.length(number) - 1))
        k = F.when(bare, F.lit("1")).otherwise(number).try_cast("bigint")
        return F.struct(parent.alias("parent"), k.alias("k"), g["first"].alias("first"), i.alias("child"))

    found = F.filter(F.transform(groups, pair), lambda p: p["k"].isNotNull() & F.array_contains("__names", p["parent"]))
    df = computed_once(df.withColumn(pairs, F.sort_array(found)), pairs)
    df = computed_once(df.withColumn(runs, F.when(F.col(clash), _run_starts(pairs, "parent"))), runs)
    df = df.withColumns({
        parents: F.transform(runs, lambda i: F.get(pairs, i)["parent"]),
        by_length: F.sort_array(F.transform(groups, lambda g, i: F.struct(F.length(g["slug"]).alias("n"), i.alias("i")))),
    })
    df = computed_once(df, parents, by_length)
    no_numbers, no_children = F.array().cast("array<bigint>"), F.array().cast("array<int>")

    def take(state, at):
        g = F.get(groups, at["i"])
        own = (~F.array_contains(state["late"], at["i"])).cast("int")
        begin, copies = g["start"] + own, g["copies"] - own
        run = F.array_position(parents, g["slug"]).cast("int")
        from_ = F.get(runs, run - 1)
        children = F.when(run > 0, F.slice(pairs, from_ + 1, F.coalesce(F.get(runs, run), F.size(pairs)) - from_)).otherwise(
            F.slice(pairs, 1, 0))

        def decide(so_far, child):
            turn = child["k"] - F.size(so_far["held"])
            arrival = F.when(turn <= copies, F.get(order, (begin + turn - 1).try_cast("int"))["pos"])
            return F.when(F.coalesce(arrival < child["first"], F.lit(False)), F.struct(
                so_far["held"].alias("held"), F.array_append(so_far["late"], child["child"]).alias("late"),
            )).otherwise(F.struct(F.array_append(so_far["held"], child["k"]).alias("held"), so_far["late"].alias("late")))

        decided = F.aggregate(children, F.struct(no_numbers.alias("held"), no_children.alias("late")), decide)

        def named(d):
            numbers = F.array_except(F.sequence(F.lit(1).cast("bigint"), F.greatest(copies + F.size(d["held"]), F.lit(1)).cast("bigint")), d["held"])
            numbered = F.transform(F.slice(numbers, 1, copies), lambda n, i: F.struct(
                F.get(order, begin + i)["pos"].alias("pos"), numbered_slug(g["slug"], n).alias("name")))
            first = F.when(own == 1, F.array(F.struct(g["first"].alias("pos"), g["slug"].alias("name")))).otherwise(F.slice(numbered, 1, 0))
            return F.struct(F.concat(state["late"], d["late"]).alias("late"), F.concat(state["out"], first, numbered).alias("out"))

        # A lambda over an array of one, so that the decisions are made only once.
        return F.get(F.transform(F.array(decided), named), F.lit(0))

    none = F.struct(no_children.alias("late"), F.array().cast("array<struct<pos:int,name:string>>").alias("out"))
    settled = F.transform(F.sort_array(F.aggregate(by_length, none, take)["out"]), lambda r: r["name"])
    df = df.withColumn(to, F.when(F.col(clash), settled))
    return computed_once(df.drop(groups, pairs, runs, parents, by_length, "__names"), to)
