"""Raw responses to cleaned items and rejects.

Everything up to the exploded items is done inside the row of a response: the
order of the items, their unique slugs and the failure of a whole batch need no
shuffle, and the same plan runs on a stream. A source with very many responses
is just very many rows.
"""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.batch_slugs import with_batch_slugs
from newsloom.functions.responses import item_fields, locate_json, torn_items, with_parsed_items
from newsloom.functions.steps import computed_once
from newsloom.functions.text import item_slug, remove_control_chars, strip_text
from newsloom.functions.urls import invalid_netloc, netloc_of, resolve_href, with_clean_url
from newsloom.operators.blacklist import PrefixIndex, with_prefix_hits
from newsloom.operators.lookup import attach_source

OUTCOME_COLUMNS = (
    "response_id", "pos", "id", "source", "headline", "href", "url", "published_at", "isProcessed", "reason",
)


def _complete(item: Column) -> Column:
    return (item["headline"] != "") & (item["href"] != "")


def _without_base(href: Column) -> Column:
    """Whether an href needs a base address that is missing or has a bad host."""
    absolute = F.startswith(href, F.lit("http://")) | F.startswith(href, F.lit("https://"))
    return (~absolute & F.col("base_url").isNull()) | (F.startswith(href, F.lit("//")) & F.col("base_bad"))


def _breaks_batch(item: Column, url_mode: str) -> Column:
    """Whether an item has a member of the wrong type where text is needed.

    Headline and href are always looked at, the id once both are there, the
    supplied URL only if the item's own URL could be built.
    """
    no_base = _without_base(item["href"])
    if url_mode == "ci":
        built = strip_text(remove_control_chars(resolve_href(item["href"], F.col("base_url"))))
        no_url = no_base | F.coalesce(invalid_netloc(netloc_of(built)), F.lit(True))
    else:
        no_url = no_base
    return (
        item["odd_headline"] | item["odd_href"]
        | (_complete(item) & (item["odd_id"] | (item["odd_url"] & ~no_url)))
    )


def _with_items(df: DataFrame, url_mode: str, on_bad_item: str, max_items: int | None, max_item_bytes: int) -> DataFrame:
    """Parse `content`; add `items` (all complete and usable ones, in order),
    `dropped` (the others, with a reason) and `failure` of the whole batch."""
    df = df.withColumns({
        "json_text": locate_json("content"),
        "base_bad": F.coalesce(invalid_netloc(netloc_of(F.col("base_url"))), F.lit(False)),
    })
    df = with_parsed_items(df, "json_text", "parsed")
    torn = F.lit(None).cast("array<string>")
    if on_bad_item == "quarantine":
        df = df.withColumn("torn", F.when(F.col("parsed").isNull(), torn_items(F.col("json_text"), max_item_bytes)))
        df = computed_once(df, "torn").withColumn("parsed", F.coalesce("parsed", F.transform("torn", lambda t: t["value"])))
        torn = F.transform("torn", lambda t: t["reason"])
    df = df.withColumn("torn", torn).drop("json_text")
    taken = F.col("parsed") if max_items is None else F.slice("parsed", 1, max_items)
    df = df.withColumn("drafts", F.transform(taken, lambda v, i: item_fields(v, i)))
    df = df.withColumn("drafts", F.transform("drafts", lambda d: d.withField("broken", _breaks_batch(d, url_mode))))
    failure = (
        F.when(F.col("source_failure").isNotNull(), F.col("source_failure"))
        .when(F.col("content") == "", F.lit("empty_response"))
        .when(F.col("parsed").isNull(), F.lit("parse_error"))
        .when(F.size("parsed") == 0, F.lit("no_items"))
    )
    reason = lambda d: (
        F.when(F.get("torn", d["pos"]).isNotNull(), F.get("torn", d["pos"]))
        .when(d["broken"], F.lit("bad_item"))
        .when(d["headline"] == "", F.lit("missing_headline"))
        .when(d["href"] == "", F.lit("missing_href"))
    )
    if on_bad_item == "fail_batch":
        failure = failure.when(F.exists("drafts", lambda d: d["broken"]), F.lit("bad_batch"))
    df = df.withColumns({
        "failure": failure,
        "drafts": F.transform("drafts", lambda d: d.withField("reason", reason(d))),
    })
    keep = ("pos", "headline", "href", "url", "published_at")
    slim = lambda d, slug: F.struct(
        *(d[k].alias(k) for k in keep), slug.alias("id"), d["reason"].alias("reason")
    )
    df = df.withColumns({
        "usable": F.when(F.col("failure").isNull(), F.filter("drafts", lambda d: d["reason"].isNull())),
        "dropped": F.transform(
            F.filter("drafts", lambda d: d["reason"].isNotNull()), lambda d: slim(d, F.lit(None).cast("string"))
        ),
    })
    df = df.withColumn("slugs", F.transform("usable", lambda d: item_slug(d["id"], d["headline"])))
    df = with_batch_slugs(df, "slugs", "unique")
    return df.withColumn("items", F.zip_with("usable", "unique", slim)).drop("parsed", "torn", "drafts", "usable", "slugs", "unique")


def clean_responses(
    responses: DataFrame,
    sources: DataFrame,
    blacklist: DataFrame | PrefixIndex | None = None,
    url_mode: str = "local",
    on_bad_item: str = "fail_batch",
    max_items: int | None = None,
    max_item_bytes: int = 1 << 24,
) -> DataFrame:
    """One row per item, or per failed batch, with `reason` = null for the
    accepted ones.

    responses:   response_id, source_name, content (text)
    sources:     name, base_url, and maybe execute (see `operators.lookup.attach_source`)
    blacklist:   url, or the same as a `prefix_index` that was made before
    url_mode:    see `functions.urls.with_clean_url`
    on_bad_item: "fail_batch" gives up a batch in which a text member is not
                 text; "quarantine" rejects only that item, and of an array that is
                 no JSON only the elements that are none or too large
    max_items:   at most this many items of each response (default: all)
    max_item_bytes: of an element, where the elements of an array are read one by one

    Every response has rows. Reasons: unknown_source, source_disabled,
    empty_response, parse_error, no_items, bad_batch (whole batch, `pos` is null); bad_item, too_large, missing_headline, missing_href, url_error,
    blacklisted_supplied, blacklisted_built (one item). Items take their slug
    before the last three are looked at, so those still use up a number.
    """
    if on_bad_item not in ("fail_batch", "quarantine"):
        raise ValueError(f"unknown on_bad_item: {on_bad_item!r}")
    if responses.sparkSession.conf.get("spark.sql.variant.allowDuplicateKeys") != "true":
        raise ValueError("set spark.sql.variant.allowDuplicateKeys to true, see newsloom.schemas.SESSION_CONF")
    df = attach_source(responses.select("response_id", "source_name", "content"), sources)
    df = _with_items(df, url_mode, on_bad_item, max_items, max_item_bytes).drop("content")
    df = df.withColumn("failed_batch", F.transform(
        F.array("failure"),
        lambda f: F.struct(
            F.lit(None).cast("int").alias("pos"),
            *(F.lit(None).cast("string").alias(k) for k in ("headline", "href", "url", "published_at", "id")),
            f.alias("reason"),
        ),
    ))
    outcome = F.when(F.col("failure").isNotNull(), F.col("failed_batch")).otherwise(F.concat("items", "dropped"))
    df = df.select("response_id", F.col("source_name").alias("source"), "base_url", "base_bad", F.inline(outcome))
    df = df.withColumnRenamed("url", "supplied").withColumn(
        "built", F.when(F.col("reason").isNull(), resolve_href(F.col("href"), F.col("base_url")))
    )
    df = with_clean_url(df, "built", "url", url_mode, error="url_bad")
    url_error = _without_base(F.col("href"))
    if url_mode == "ci":
        url_error = url_error | F.col("url_bad")
    df = df.withColumn("reason", F.when(F.col("reason").isNull() & url_error, F.lit("url_error")).otherwise(F.col("reason")))
    if blacklist is not None:
        open_ = F.col("reason").isNull()
        df = df.withColumns({
            "supplied": F.when(open_ & (F.col("supplied") != ""), F.col("supplied")),
            "check": F.when(open_, F.col("url")),
        })
        df = with_prefix_hits(computed_once(df, "supplied", "check"), blacklist, {"bad_supplied": "supplied", "bad_built": "check"})
        df = df.withColumn(
            "reason",
            F.when(F.col("bad_supplied"), F.lit("blacklisted_supplied"))
            .when(F.col("bad_built"), F.lit("blacklisted_built"))
            .otherwise(F.col("reason")),
        )
    return df.withColumn("isProcessed", F.lit(False)).select(*OUTCOME_COLUMNS)


def accepted(outcome: DataFrame) -> DataFrame:
    return outcome.filter("reason is null").drop("reason")


def rejected(outcome: DataFrame) -> DataFrame:
    return outcome.filter("reason is not null")
