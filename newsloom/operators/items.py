"""Filters over items. All are off unless called."""

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsloom.functions.text import WS
from newsloom.operators.checkpoints import checkpointed
from newsloom.operators.terms import with_term_hits


def require_fields(df: DataFrame) -> DataFrame:
    """Add `reason` for items without (stripped) headline or href."""
    empty = lambda name: F.coalesce(F.col(name), F.lit("")) == ""
    return df.withColumn(
        "reason",
        F.when(empty("headline"), F.lit("missing_headline")).when(empty("href"), F.lit("missing_href")),
    )


def within_period(df: DataFrame, date_text: str, as_of: str, days: int = 1) -> DataFrame:
    """Items dated (YYYY-MM-DD...) at most `days` before `as_of`; items without
    a readable date do not qualify."""
    day = F.try_to_date(F.left(F.col(date_text), F.lit(10)), "yyyy-MM-dd")
    start = F.date_sub(F.to_date(F.lit(as_of)), days)
    return df.filter((day >= start) & (day <= F.to_date(F.lit(as_of))))


def topic_and_junk(df: DataFrame, headline: str, url: str | None = None, terms: Iterable[str] | DataFrame = (),
                   min_words: int = 2, skip_videos: bool = True) -> DataFrame:
    """Items whose headline has `min_words` words and, if `terms` are given (a
    table with the column `term` for long lists), contains one of them; with
    `url`, no /video addresses."""
    # Read no further than the last of these words.
    words = rf"\A[{WS}]*+[^{WS}]++(?:[{WS}]++[^{WS}]++){{{min_words - 1}}}"
    keep: Column = F.rlike(headline, F.lit(words)) if min_words > 0 else F.isnotnull(headline)
    if url is not None and skip_videos:
        keep = keep & ~F.lower(url).rlike("/videos?(?:[/?#.]|$)")
    df = df.filter(keep)
    if not isinstance(terms, DataFrame):
        terms = list(terms)
        if not terms:
            return df
        terms = df.sparkSession.createDataFrame([(term,) for term in terms], "term string")
    return with_term_hits(df, headline, terms, "__hit").filter("__hit").drop("__hit")


def limit_per_source(df: DataFrame, source: str, order: str, n: int = 10) -> DataFrame:
    """The first `n` items of each source. The planner keeps n rows per source
    and task before it shuffles, so a big source is not moved as a whole."""
    rank = F.row_number().over(Window.partitionBy(source).orderBy(order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def stable_order(df: DataFrame, registry: DataFrame) -> DataFrame:
    """Items for display: sites in registry order, then responses and their
    items in order. `registry` has id and Name.

    Sorting reads its rows twice, first to place the cuts between tasks. So the
    items are computed once, into a written copy."""
    places = registry.groupBy(F.col("Name").alias("source")).agg(F.min("id").alias("__place"))
    placed = checkpointed(df.join(places, "source", "left"))
    return placed.orderBy("__place", "response_id", "pos").drop("__place")
