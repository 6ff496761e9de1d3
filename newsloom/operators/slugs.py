"""Slugs that are unique within a batch, when the batch is many rows.

Same result as `functions.batch_slugs`, for batches of any size: in order, each
item takes the first name in its slug's list of names that is still free.

The r-th copy of a slug (from 0) takes its r-th name unless one of the names
0..r is lost to an item whose own slug reads the same ("a-1" is a slug of its
own and also the first numbered name of "a"). Such pairs are found on the
distinct slugs. Only slugs that share a root with such a pair get the longer
treatment in `_settle`.
"""

from pyspark.sql import DataFrame, functions as F

from newsloom.functions.text import MAX_SLUG, numbered_slug
from newsloom.operators.checkpoints import checkpointed, released
from newsloom.operators.running import with_running_total

NUMBER = "-([1-9][0-9]{0,17})$"


def _root(slug: str):
    """Common to a slug, its numbered names, their numbered names, ..."""
    return F.regexp_replace(slug, "(?:-[0-9]*)+$", "")


def _pairs(groups: DataFrame, batch: list[str]) -> DataFrame:
    """Slugs that are also a numbered name of another slug of the batch:
    `slug`, its first place `first`, the other slug `parent` and the number of
    the name `k`. `groups` has a row per slug: batch, slug, copies, first."""
    number = F.regexp_extract("slug", NUMBER, 1)
    bare = (F.length("slug") == MAX_SLUG) & F.endswith(F.col("slug"), F.lit("-"))
    children = groups.select(
        *batch, "slug", "first",
        F.when(bare, F.left("slug", F.lit(MAX_SLUG - 1)))
        .otherwise(F.left("slug", F.length("slug") - F.length(number) - 1)).alias("parent"),
        F.when(bare, F.lit("1")).otherwise(number).try_cast("bigint").alias("k"),
    ).filter("k is not null")
    parents = groups.select(*batch, F.col("slug").alias("parent"), F.col("copies").alias("parent_copies"))
    return children.join(parents, [*batch, "parent"])


def _settle(ranked: DataFrame, pairs: DataFrame, batch: list[str]) -> DataFrame:
    """Decide every pair and number the items of the slugs involved.

    A pair is decided by who comes first: the first item with that slug, or the
    parent's copy that gets as far as this name. Which copy that is depends on
    how many earlier names were lost, and on whether the parent's own first
    item lost its name. Those are decisions about smaller numbers and about
    shorter slugs, so deciding all pairs again from the last decisions settles
    after a few rounds, and to the only consistent answer.
    """
    ranked, copy = checkpointed(ranked), checkpointed(pairs.withColumn("own", F.lit(True)))
    pairs = copy

    def decided(pairs: DataFrame) -> DataFrame:
        pairs = with_running_total(pairs, [*batch, "parent"], "k", "lost", F.col("own").cast("int"))
        ousted = pairs.filter(~F.col("own")).select(*batch, F.col("slug").alias("parent"), F.lit(1).alias("ousted"))
        return (
            pairs.join(ousted, [*batch, "parent"], "left")
            .withColumn("turn", F.col("k") - (F.col("lost") - F.col("own").cast("int")))
            .withColumn("copy", F.col("turn") - F.coalesce("ousted", F.lit(0)))
        )

    arrivals = ranked.select(*batch, F.col("slug").alias("parent"), "copy", F.col("place").alias("arrival"))
    while True:
        after = decided(pairs).join(arrivals, [*batch, "parent", "copy"], "left").select(
            *batch, "slug", "first", "parent", "k",
            F.coalesce(F.col("first") < F.col("arrival"), F.lit(True)).alias("own"), F.col("own").alias("was"),
        )
        after = checkpointed(after)
        released(copy)
        copy, pairs = after, after.drop("was")
        if after.filter("own <> was").isEmpty():
            break

    ousted = pairs.filter(~F.col("own")).select(*batch, "slug", F.lit(1).alias("ousted"))
    items = ranked.join(ousted, [*batch, "slug"], "left").withColumn(
        "turn", F.col("copy") + F.coalesce("ousted", F.lit(0))
    )
    # The turn-th free name comes after all lost names k whose position among
    # the lost ones, i = 1, 2, ..., satisfies k - i < turn.
    lost = with_running_total(pairs.filter("own"), [*batch, "parent"], "k", "i")
    steps = lost.groupBy(*batch, F.col("parent").alias("slug"), (F.col("k") - F.col("i")).alias("step")).agg(
        F.count("*").alias("weight")
    )
    events = items.select(
        *batch, "slug", "place", (F.col("turn") * 2).alias("at"), "turn", F.lit(0).cast("bigint").alias("weight"),
    ).unionByName(steps.select(*batch, "slug", (F.col("step") * 2 + 1).alias("at"), "weight"), allowMissingColumns=True)
    numbered = with_running_total(events, [*batch, "slug"], "at", "skipped", F.col("weight")).filter("place is not null")
    return numbered.select(
        *batch, "slug", "place",
        F.when(F.col("turn") == 0, F.lit(0)).otherwise(F.col("turn") + F.col("skipped")).alias("k"),
    )


def with_unique_slugs(df: DataFrame, batch: list[str], order: str, slug: str, to: str) -> DataFrame:
    """Add column `to`: `slug` made unique within the batch, in `order` (a
    bigint that is unique within the batch; dense values make few blocks). Null
    batch keys are a batch.

    Names are found on a written copy of batch, place and slug, and joined to
    the rows at the end.
    """
    keyed = df.withColumns({"__batch": F.struct(*batch), "__place": F.col(order).cast("bigint")})
    places = checkpointed(keyed.select("__batch", F.col("__place").alias("place"), F.col(slug).alias("slug")))
    key = ["__batch"]
    groups = places.groupBy(*key, "slug").agg(F.count("*").alias("copies"), F.min("place").alias("first"))
    pairs = checkpointed(_pairs(groups, key))
    clashes = pairs.filter("parent_copies > k").select(*key, _root("slug").alias("root")).distinct()
    ranked = with_running_total(places, [*key, "slug"], "place", "k").withColumn("k", F.col("k") - 1)
    if not clashes.isEmpty():
        rooted = lambda d: d.withColumn("root", _root("slug")).join(clashes, [*key, "root"], "left_semi").drop("root")
        settled = _settle(rooted(ranked).withColumnRenamed("k", "copy"), rooted(pairs).drop("parent_copies"), key)
        settled = settled.select(*key, "place", F.col("k").alias("settled"))
        ranked = ranked.join(settled, [*key, "place"], "left").withColumn("k", F.coalesce("settled", "k"))
    names = ranked.select(*key, F.col("place").alias("__place"), numbered_slug(F.col("slug"), F.col("k")).alias("__name"))
    named = keyed.join(names, [*key, "__place"]).drop(*key, "__place")
    return named.withColumn(to, F.col("__name")).drop("__name")
