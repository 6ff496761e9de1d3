"""Counts over a run."""

from pyspark.sql import DataFrame, functions as F


def items_per_source(sources: DataFrame, items: DataFrame) -> DataFrame:
    """Number of items of each site, 0 included."""
    counts = items.groupBy(F.col("source").alias("name")).agg(F.count("*").alias("n_items"))
    return sources.select("name").join(counts, "name", "left").fillna(0, ["n_items"])


def rejects_by_reason(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source", "reason").agg(F.count("*").alias("n_rejected"))


def stored_count(loaded: DataFrame) -> DataFrame:
    """Number of articles without a reject reason."""
    return loaded.agg(F.count_if(F.col("reason").isNull()).alias("n_stored"))


def run_summary(sources: DataFrame, loaded: DataFrame) -> DataFrame:
    """One row: items fetched, articles stored, and how the run ended. Nothing
    stored is still "ok" as long as something was fetched."""
    counts = loaded.agg(
        F.count("*").alias("n_fetched"), F.count_if(F.col("reason").isNull()).alias("n_stored"),
    )
    any_source = sources.limit(1).agg(F.count("*").alias("n_sources")).scalar()
    return counts.withColumn("n_sources", any_source).select(
        "n_fetched", "n_stored",
        F.when(F.col("n_sources") == 0, F.lit("no_sources"))
        .when(F.col("n_fetched") == 0, F.lit("no_items"))
        .otherwise(F.lit("ok")).alias("outcome"),
    )
