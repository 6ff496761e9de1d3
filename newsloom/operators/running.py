"""Running totals that stay spread out when one group is huge."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsloom.functions.search import count_up_to
from newsloom.operators.checkpoints import checkpointed

#: Groups of more than 2^20 rows are cut into blocks, at quantiles of their order.
BLOCK_BITS = 20
MOST_BLOCKS = 1024


def _bounds(df: DataFrame, order: str) -> DataFrame | None:
    """(__keys, __bounds): for the groups that are to be cut, the order values at which blocks begin."""
    sizes = df.groupBy("__keys").agg(F.count("*").alias("__rows")).filter(F.col("__rows") > 1 << BLOCK_BITS)
    large = checkpointed(sizes.select("__keys"))
    if large.isEmpty():
        return None
    fractions = F.array(*(F.lit(i / MOST_BLOCKS) for i in range(1, MOST_BLOCKS)))
    cuts = F.percentile_approx(F.col(order).cast("bigint"), fractions, F.lit(10 * MOST_BLOCKS))
    return checkpointed(df.join(large, "__keys", "left_semi").groupBy("__keys").agg(F.array_distinct(cuts).alias("__bounds")))


def with_running_total(df: DataFrame, keys: list[str], order: str, to: str, amount: Column | None = None) -> DataFrame:
    """Add the sum of `amount` (1 by default) over the rows of the same keys
    up to and including this one.

    `order` is a bigint, unique within the keys; null keys are a group. A plain window would put a
    whole group into one task. Here a large group is cut into at most `MOST_BLOCKS` blocks of about equal
    numbers of rows, whatever its order values are: a window inside each
    block, plus the total of the blocks before it, which comes from
    pre-aggregated block sums. Groups of ordinary size are one block.
    """
    amount = F.lit(1) if amount is None else amount
    block, part, before = "__block", "__part", "__before"
    # Nulls among the keys are equal, for the joins as for the windows.
    df = df.withColumns({"__keys": F.struct(*keys), part: amount.cast("bigint")})
    bounds = _bounds(df, order)
    running = lambda *by: F.sum(part).over(
        Window.partitionBy("__keys", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if bounds is None:
        return df.withColumn(to, running()).drop(part, "__keys")
    df = df.join(bounds, "__keys", "left").withColumn(
        block, F.when(F.col("__bounds").isNull(), F.lit(0)).otherwise(count_up_to(F.col("__bounds"), F.col(order).cast("bigint"), MOST_BLOCKS))).drop("__bounds")
    sums = df.groupBy("__keys", block).agg(F.sum(part).alias(part))
    earlier = Window.partitionBy("__keys").orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.select("__keys", block, F.sum(part).over(earlier).alias(before)).filter(F.col(before) != 0)
    return (
        df.withColumn(to, running(block))
        .join(blocks, ["__keys", block], "left")
        .withColumn(to, F.col(to) + F.coalesce(before, F.lit(0)))
        .drop(block, part, before, "__keys")
    )
