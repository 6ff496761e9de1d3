"""Loading cleaned items into the article table."""

from pyspark.sql import DataFrame, Observation, functions as F

from newsloom.operators.articles import format_article, prepare_insert
from newsloom.operators.checkpoints import checkpointed, held
from newsloom.operators.lookup import lookup_source_id

#: Why rows are not stored. Of these the last two come from the load, the others from the cleaning.
REASONS = (
    "unknown_source", "source_disabled", "empty_response", "parse_error", "no_items", "bad_batch", "bad_item", "too_large",
    "missing_headline", "missing_href", "url_error", "blacklisted_supplied", "blacklisted_built", "no_source_id", "known_url",
)
LOAD_REASONS = REASONS[-2:]


def resolve_articles(items: DataFrame, source_ids: DataFrame) -> DataFrame:
    """Items as articles with `source_id` and, where there is none, `reason`."""
    return lookup_source_id(format_article(items), source_ids)


def resolve_outcome(outcome: DataFrame, source_ids: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """All rows of a cleaning's outcome as articles, in one pass: response_id, pos,
    the article columns, source_id and `reason`, which is null for those to
    store. Reasons from the cleaning stay; the others are looked up here."""
    articles = outcome.withColumns({"uniqueName": F.col("id"), "publishedAt": F.col("published_at"), "__cleaned": F.col("reason")})
    found = lookup_source_id(articles.drop("id", "published_at"), source_ids)
    if known is not None:
        found = mark_known(found, known)
    return found.withColumn("reason", F.coalesce("__cleaned", "reason")).drop("__cleaned")


def append_articles(resolved: DataFrame, stored: str, rejects: str | None = None, write: bool = True,
                    skip_known_urls: DataFrame | None = None) -> DataFrame:
    """Append the articles that have a source id to the parquet table at
    `stored`, the others to `rejects`, and return the appended rows.

    Stored rows are neither updated nor compared with, so a repeated run adds
    its rows again; `skip_known_urls` turns articles whose url is in that table
    into rejects with the reason known_url, if they have no other. Both sides
    are written from one copy of the articles. `write=False` writes nothing and
    returns what would be appended.
    """
    if skip_known_urls is not None:
        resolved = mark_known(resolved, skip_known_urls)
    if write:
        resolved = checkpointed(resolved)
    rows = prepare_insert(resolved.filter("reason is null"))
    if write:
        rows.write.mode("append").parquet(stored)
        if rejects is not None:
            resolved.filter("reason is not null").write.mode("append").parquet(rejects)
    return rows


def load_run(loaded: DataFrame, stored: str, rejects: str, run: int | None = None) -> dict[str, int]:
    """Store one run's rows (of `resolve_outcome`) and return its counts: `fetched`
    (items that passed the cleaning), `stored`, and one for each of `REASONS`.

    The rows are computed once, into a copy that is gone when both sides are
    written; the counts are observed while that copy is made. Without `run` both sides are appended. With it they replace the
    folders run=<run> of the two tables, so a run that was broken off and is
    repeated leaves the same rows as one that was not.
    """
    place = (lambda path: path) if run is None else (lambda path: f"{path}/run={run}")
    mode = "append" if run is None else "overwrite"
    seen = Observation()
    is_stored = F.col("reason").isNull()
    counts = {
        "fetched": F.count_if(is_stored | F.col("reason").isin(*LOAD_REASONS)), "stored": F.count_if(is_stored),
        **{reason: F.count_if(F.col("reason") == reason) for reason in REASONS},
    }
    with held(loaded.observe(seen, *(value.alias(name) for name, value in counts.items()))) as rows:
        prepare_insert(rows.filter("reason is null")).write.mode(mode).parquet(place(stored))
        rows.filter("reason is not null").write.mode(mode).parquet(place(rejects))
    return {name: seen.get[name] for name in counts}


def mark_known(resolved: DataFrame, known: DataFrame) -> DataFrame:
    """Articles with the reason known_url where `known` has their url."""
    known = known.select("url").distinct().withColumn("__known", F.lit("known_url"))
    return resolved.join(known, "url", "left").withColumn("reason", F.coalesce("reason", "__known")).drop("__known")


def with_status(outcome: DataFrame) -> DataFrame:
    """Add `status`, "accepted" or "rejected", to store the two sides apart."""
    return outcome.withColumn("status", F.when(F.col("reason").isNull(), F.lit("accepted")).otherwise(F.lit("rejected")))


def write_outcome(outcome: DataFrame, path: str) -> None:
    """Append items and rejects in one pass, in folders status=..., so that
    later steps read either side without cleaning again."""
    with_status(outcome).write.mode("append").partitionBy("status").parquet(path)
