"""Attaching registry data to responses and articles.

No join here carries a broadcast hint: a registry below the session's broadcast
threshold is broadcast by the planner, a bigger one is shuffled, with hot
sources split at run time.
"""

from pyspark.sql import DataFrame, functions as F


def attach_source(responses: DataFrame, sources: DataFrame) -> DataFrame:
    """All responses, with the site's base address and `source_failure`: null,
    unknown_source, or source_disabled where `sources` has an `execute` column
    that is not true. Site names are matched exactly; a site without a name is
    called "Unknown Source". Of a repeated name each row is a site of its own."""
    name = F.coalesce(F.col("name"), F.lit("Unknown Source")) if "name" in sources.columns else F.lit("Unknown Source")
    runs = F.coalesce("execute", F.lit(False)) if "execute" in sources.columns else F.lit(True)
    sites = sources.select(name.alias("source_name"), "base_url", runs.alias("__runs"))
    failure = F.when(F.col("__runs").isNull(), F.lit("unknown_source")).when(~F.col("__runs"), F.lit("source_disabled"))
    return responses.join(sites, "source_name", "left").withColumn("source_failure", failure).drop("__runs")


def lookup_source_id(articles: DataFrame, source_ids: DataFrame) -> DataFrame:
    """Articles with `source_id`, found by name regardless of case, and
    `reason` = no_source_id where there is none; an id of 0 counts as none."""
    found = articles.withColumn("source_key", F.upper(F.coalesce("source", F.lit("")))).join(source_ids, "source_key", "left")
    missing = F.coalesce(F.col("source_id"), F.lit(0)) == 0
    return found.drop("source_key").withColumn("reason", F.when(missing, F.lit("no_source_id")))
