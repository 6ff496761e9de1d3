"""Connected components of a graph given by its edges."""

from pyspark.sql import DataFrame, functions as F

from newsloom.llm.shared import released, written


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges` (columns a and b, integers) that is
    not the smallest of its component; root is the smallest.

    Alternates the large-star and small-star steps until the edges stop
    changing, with a written table after each round. A star with very many
    arms is only ever aggregated to its minimum and joined, never gathered.
    Each round's tables go when the next has been written.
    Self loops, repeated edges and nulls are ignored.
    """
    def tidy(df):
        return df.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(df):
        return df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()

    stars = written(tidy(edges))
    before = state(stars)
    while before[0]:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = tidy(both.join(lowest, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = written(large)
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lowest, "a").select("b", "m").toDF("a", "b").unionByName(lowest.toDF("a", "b"))
        released(stars)
        stars = written(tidy(small))
        released(large)
        after = state(stars)
        if after == before:
            break
        before = after
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
