"""Dropping or marking URLs that start with a black-listed prefix."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.search import greatest_up_to, listed_array
from newsloom.functions.steps import computed_once
from newsloom.operators.checkpoints import checkpointed

#: Most entries that become part of the plan as one array, and beyond that most nodes that do.
LISTED = 1 << 12
#: Entries in a node, as a power of two, and in a task that sorts them.
NODE_BITS, SORTED = 8, 1 << 16


def _core(prefixes: list[str]) -> list[str]:
    """The prefixes that start with no other one, sorted."""
    out = []
    for prefix in sorted(set(prefixes), key=str.encode):
        if not out or not prefix.startswith(out[-1]):
            out.append(prefix)
    return out


@dataclass(frozen=True)
class PrefixIndex:
    """A list of prefixes of which none starts with another, in byte order.

    Any text that starts with one of them starts with the greatest that does not come after it: all
    texts in between start with it too, and no other entry does. So one search in order decides,
    however many entries a host has.

    `top` is the whole list, or the first entries of the nodes named in
    `numbers`. `levels` are tables of nodes (__node, __keys, __below), each of
    at most `most` keys: first entries of nodes of the next level, or, on the last, the list.
    """

    top: list[str]
    numbers: list[int] | None = None
    levels: tuple[DataFrame, ...] = ()
    most: int = 1 << NODE_BITS


def _nodes(sorted_rows: DataFrame, key: str, below: Column, number: Column) -> DataFrame:
    pairs = F.sort_array(F.collect_list(F.struct(F.col(key).alias("key"), below.alias("below"))))
    return sorted_rows.groupBy(number.alias("__node")).agg(pairs.alias("pairs")).select(
        "__node", F.col("pairs.key").alias("__keys"), F.col("pairs.below").alias("__below"))


def _leaves(prefixes: DataFrame, node_bits: int, per_task: int) -> DataFrame:
    """The lowest nodes: the list sorted over all tasks, without entries that start with another.

    If an entry before a node's first one is the beginning of an entry in the
    node, it is also that of the node's first entry. So only the beginnings of
    these are looked up in the list; the rest is settled inside the nodes.
    """
    distinct = checkpointed(prefixes.distinct())  # read to be counted, to place the cuts between tasks, and to be sorted
    tasks = max(1, distinct.count() // per_task)
    placed = checkpointed(distinct.repartitionByRange(tasks, "prefix").sortWithinPartitions("prefix").withColumn("at", F.monotonically_increasing_id()))
    leaves = checkpointed(_nodes(placed, "prefix", F.lit(None).cast("bigint"), F.shiftright("at", node_bits)))
    first = leaves.select("__node", F.element_at("__keys", 1).alias("first")).filter(F.length("first") > 1)
    cuts = first.select("__node", F.explode(F.transform(F.sequence(F.lit(1), F.length("first") - 1), lambda n: F.left("first", n))).alias("prefix"))
    covers = cuts.join(placed.select("prefix"), "prefix").groupBy("__node").agg(F.min_by("prefix", F.length("prefix")).alias("cover"))
    starts = lambda e, other: F.coalesce(F.startswith(e, other), F.lit(False))
    own = F.filter("__keys", lambda e: ~starts(e, F.col("cover")))
    core = F.aggregate(own, F.array().cast("array<string>"), lambda kept, e: F.when(
        starts(e, F.get(kept, F.size(kept) - 1)), kept).otherwise(F.concat(kept, F.array(e))))
    reduced = leaves.join(covers, "__node", "left").select("__node", core.alias("__keys"), "__below")
    return checkpointed(reduced.filter(F.size("__keys") > 0))


def prefix_index(prefixes: DataFrame, listed: int = LISTED, node_bits: int = NODE_BITS, per_task: int = SORTED) -> PrefixIndex:
    """The prefixes (column `url`), reduced and sorted once, for any number of `with_prefix_hits`.

    Null and empty prefixes are left out. Lists of up to `listed` entries are reduced on the driver. Longer ones are
    sorted by range and written as a tree of nodes of 2^`node_bits` entries; only the first
    entries of its top nodes, again at most `listed`, come to the driver.
    """
    prefixes = prefixes.select(F.col("url").alias("prefix")).filter("prefix <> ''")
    few = [row.prefix for row in prefixes.limit(listed + 1).collect()]
    if len(few) <= listed:
        return PrefixIndex(_core(few))
    levels = [_leaves(prefixes, node_bits, per_task)]
    while levels[0].count() > listed:
        bounds = levels[0].select(F.element_at("__keys", 1).alias("bound"), "__node")
        levels.insert(0, checkpointed(_nodes(bounds, "bound", F.col("__node"), F.shiftright("__node", node_bits))))
    top = [(row[0], row[1]) for row in levels[0].select(F.element_at("__keys", 1), "__node").collect()]
    top.sort(key=lambda pair: pair[0].encode())
    return PrefixIndex([bound for bound, _ in top], [number for _, number in top], tuple(levels), 1 << node_bits)


def _hit(url: Column, entries: Column, most: int) -> Column:
    return F.coalesce(F.startswith(url, greatest_up_to(entries, url, most)), F.lit(False))


def with_prefix_hits(df: DataFrame, prefixes: DataFrame | PrefixIndex, checks: dict[str, str]) -> DataFrame:
    """Add, for each `checks` entry {new column: url column}, whether the URL
    starts with a black-listed prefix. The test is case-sensitive and knows no
    word or path boundaries; a null URL starts with none.

    `prefixes` (column `url`, or a `prefix_index` made before) has any length.
    A URL takes a binary search in a short list; in a long one also a left join
    that matches a row at most once and a search in a node, level by level. So
    rows need no key, streams need no state, and the planner broadcasts nodes or
    shuffles them by their size.
    """
    index = prefixes if isinstance(prefixes, PrefixIndex) else prefix_index(prefixes)
    top = listed_array(index.top)
    if not index.levels:
        return df.withColumns({to: _hit(F.col(url), top, len(index.top)) for to, url in checks.items()})
    numbers = listed_array(index.numbers).cast("array<bigint>")
    for to, url in checks.items():
        at = greatest_up_to(top, F.col(url), len(index.top), numbers)
        for nodes in index.levels:
            df = computed_once(df.withColumn("__at", at).drop("__next"), "__at").join(nodes, F.col("__at") == F.col("__node"), "left")
            at = greatest_up_to(F.col("__keys"), F.col(url), index.most, F.col("__below"))
            if nodes is index.levels[-1]:
                df, at = df.withColumn(to, _hit(F.col(url), F.col("__keys"), index.most)), F.lit(None)
            df = df.withColumn("__next", at).drop("__at", "__node", "__keys", "__below")
            at = F.col("__next")
        df = df.drop("__next")
    return df


def anti_join_prefix(df: DataFrame, url: str, prefixes: DataFrame | PrefixIndex) -> DataFrame:
    """Keep the rows whose URL starts with none of the prefixes."""
    hit = "__hit"
    return with_prefix_hits(df, prefixes, {hit: url}).filter(~F.col(hit)).drop(hit)
