"""The registered queries: every operator over the test tables."""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalog import inputs
from newsloom.functions import text, urls
from newsloom.functions.batch_slugs import with_batch_slugs
from newsloom.functions.responses import locate_json, torn_items, with_parsed_items
from newsloom.operators import articles, items as item_ops, lookup, reports
from newsloom.operators.blacklist import anti_join_prefix
from newsloom.operators.checkpoints import shared_folder
from newsloom.operators.slugs import with_unique_slugs
from newsloom.plans.clean import accepted, clean_responses, rejected
from newsloom.plans.load import append_articles, load_run, resolve_articles, resolve_outcome, write_outcome
from newsloom.schemas import SESSION_CONF
from newsloom.sources import articles as stored, pages as page_sources, registries
from newsloom.sources.responses import scan_raw_responses
from newsloom.streaming.ingest import ingest_available, load_available

QUERIES = {}


def query(function):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", SESSION_CONF["spark.sql.variant.allowDuplicateKeys"])
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def _sources(spark, sf_dir, disabled=False):
    return registries.scan_sources(inputs.registry(spark, sf_dir), disabled)


def _source_ids(spark, sf_dir):
    return registries.scan_source_ids(inputs.registry(spark, sf_dir))


def _outcome(spark, sf_dir, **options):
    options = {"blacklist": inputs.blacklist(spark), **options}
    raw = scan_raw_responses(inputs.raw_responses(spark, sf_dir))
    return clean_responses(raw, _sources(spark, sf_dir, disabled=True), **options)


def _scratch(spark):
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


# Flagship: which articles per site survive the blacklist.

@query
def articles_per_site(spark, sf_dir):
    found = page_sources.page_items(inputs.table(spark, sf_dir, "pages"))
    found = item_ops.require_fields(found).filter("reason is null")
    found = urls.with_clean_url(found.withColumnRenamed("url", "built"), "built", "url")
    kept = anti_join_prefix(found, "url", inputs.blacklist(spark))
    return kept.groupBy("source").agg(F.count("*").alias("n_items"), F.countDistinct("id").alias("n_slugs"))


# Sources.

@query
def sources_enabled(spark, sf_dir):
    return _sources(spark, sf_dir)


@query
def team_sources(spark, sf_dir):
    return registries.scan_team_sources(inputs.team_registry(spark, sf_dir))


@query
def source_ids(spark, sf_dir):
    return registries.scan_source_ids(inputs.nation_ids(spark, sf_dir))


@query
def blacklist_scan(spark, sf_dir):
    path = _scratch(spark)
    inputs.host_blacklist(spark, sf_dir).write.json(path)
    return registries.scan_blacklist(spark, path, lines=True)


@query
def blacklist_file(spark, sf_dir):
    """The same as JSON arrays, a file for those whose hash begins alike; entries are spread over lines."""
    path = _scratch(spark)
    entries = F.to_json(F.sort_array(F.collect_list(F.struct("url"))))
    files = inputs.host_blacklist(spark, sf_dir).groupBy(F.left(F.sha1("url"), F.lit(2)).alias("part")).agg(
        F.replace(entries, F.lit(","), F.lit(",\n  ")).alias("value"))
    files.write.partitionBy("part").text(path)
    return registries.scan_blacklist(spark, path)


@query
def raw_decoded(spark, sf_dir):
    raw = inputs.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("response_id"),
        F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF20C3"))).alias("content"),
    )
    return scan_raw_responses(raw).select("response_id", "content")


@query
def existing_topk(spark, sf_dir):
    items = accepted(_outcome(spark, sf_dir))
    return stored.scan_existing(articles.format_article(items), 50)


# Text.

@query
def control_chars(spark, sf_dir):
    return inputs.table(spark, sf_dir, "documents").select("doc_id", text.remove_control_chars(F.col("text")).alias("text"))


@query
def strip_text(spark, sf_dir):
    padded = F.concat(F.lit(" \t"), F.col("text"), F.lit("\xa0\n\x1c"))
    return inputs.table(spark, sf_dir, "documents").select("doc_id", text.strip_text(padded).alias("text"))


@query
def slug_item(spark, sf_dir):
    lines = inputs.lines(spark, sf_dir)
    item_id = F.when(F.col("source") == "src3", F.concat(F.lit("No. "), F.col("headline")))
    return lines.select("doc_id", "pos", text.item_slug(item_id, F.col("headline")).alias("slug"))


@query
def slug_headline(spark, sf_dir):
    return inputs.lines(spark, sf_dir).select("doc_id", "pos", text.headline_slug("headline").alias("slug"))


@query
def slug_hash(spark, sf_dir):
    return inputs.lines(spark, sf_dir).select("doc_id", "pos", text.hash_slug("headline").alias("slug"))


@query
def slug_unique(spark, sf_dir):
    """Batches by source and place in the text."""
    lines = inputs.lines(spark, sf_dir).withColumn("slug", text.item_slug(F.lit(""), F.col("headline")))
    return with_unique_slugs(lines.drop("headline"), ["source", "pos"], "doc_id", "slug", "unique_slug")


@query
def slug_unique_numbered(spark, sf_dir):
    """Batches by user, one of them null, with slugs that read like other slugs' numbered names."""
    k = F.get_json_object("props", "$.k")
    slug = F.when(F.col("value") < 10, F.concat("event_type", F.lit("-"), k)).otherwise(F.col("event_type"))
    events = inputs.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("user_id") % 7 != 3, F.col("user_id")).alias("user_id"), slug.alias("slug"))
    return with_unique_slugs(events, ["user_id"], "event_id", "slug", "unique_slug")


@query
def slug_unique_in_row(spark, sf_dir):
    """The same where a batch is a row: a document, with a slug per line. Lines
    of one word keep only its first letter and a number, so that slugs clash."""
    def slug(line):
        whole = F.left(text.item_slug(F.lit(""), line), F.lit(90))
        short = F.concat(F.left(F.lower(line), F.lit(1)), F.when(F.length(line) % 3 > 0, F.concat(F.lit("-"), F.length(line) % 9)).otherwise(F.lit("")))
        return F.when(F.contains(line, F.lit(" ")), whole).otherwise(short)

    documents = inputs.table(spark, sf_dir, "documents").select("doc_id", "text")
    slugs = documents.select("doc_id", F.transform(F.split("text", "\n"), slug).alias("slugs"))
    unique = with_batch_slugs(slugs, "slugs", "unique")
    return unique.select("doc_id", F.posexplode("unique").alias("pos", "unique_slug"))


# URLs.

@query
def url_parts(spark, sf_dir):
    return urls.with_url_parts(inputs.hrefs(spark, sf_dir), "href").drop("page_url")


@query
def url_valid(spark, sf_dir):
    return urls.with_valid_url(inputs.hrefs(spark, sf_dir), "href", "valid").select("page_id", "pos", "valid")


@query
def url_domain(spark, sf_dir):
    return urls.with_source_domain(inputs.hrefs(spark, sf_dir), "href", "domain").select("page_id", "pos", "domain")


@query
def url_path(spark, sf_dir):
    return urls.with_href_path(inputs.hrefs(spark, sf_dir), "href", "path").select("page_id", "pos", "path")


def _odd_hrefs(spark, sf_dir):
    odd = F.concat("href", F.lit(" ;p= 1?a = b &&c#f "))
    return inputs.hrefs(spark, sf_dir).withColumn("href", F.when(F.col("pos") > 3, odd).otherwise(F.col("href")))


@query
def url_clean_local(spark, sf_dir):
    return urls.with_clean_url(_odd_hrefs(spark, sf_dir), "href", "clean").select("page_id", "pos", "clean")


@query
def url_clean_ci(spark, sf_dir):
    return urls.with_clean_url(_odd_hrefs(spark, sf_dir), "href", "clean", "ci").select("page_id", "pos", "clean")


@query
def url_error(spark, sf_dir):
    bracketed = inputs.hrefs(spark, sf_dir).withColumn("href", F.replace("href", F.lit("//www."), F.lit("//[")))
    df = urls.with_clean_url(bracketed, "href", "clean", error="url_bad")
    return df.select("page_id", "pos", "clean", "url_bad")


@query
def href_resolve(spark, sf_dir):
    return urls.with_resolved_href(inputs.hrefs(spark, sf_dir), "href", "page_url", "url").select("page_id", "pos", "url")


# Joins.

@query
def blacklist_nlj(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", "url")
    return anti_join_prefix(pages, "url", inputs.blacklist(spark))


@query
def blacklist_prefix_hash(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").select("page_id", "url")
    return anti_join_prefix(pages, "url", inputs.host_blacklist(spark, sf_dir))


def _customers(spark, sf_dir):
    customer = inputs.table(spark, sf_dir, "customer")
    name = F.concat(F.lit("nation_"), F.col("c_nationkey") + F.when(F.col("c_acctbal") < 0, 50).otherwise(0))
    return customer.select(
        F.col("c_name").alias("id"), name.alias("source"), F.col("c_name").alias("headline"),
        F.lit("/x").alias("href"), F.lit("http://e.com/x").alias("url"), F.lit("2024-01-01").alias("published_at"),
    )


def _customer_lookup(spark, sf_dir):
    return lookup.lookup_source_id(_customers(spark, sf_dir), registries.scan_source_ids(inputs.nation_ids(spark, sf_dir)))


@query
def source_id_lookup(spark, sf_dir):
    return _customer_lookup(spark, sf_dir).filter("reason is null").select("id", "source_id")


@query
def source_id_rejects(spark, sf_dir):
    return _customer_lookup(spark, sf_dir).filter("reason is not null").select("id", "source", "reason")


@query
def source_attached(spark, sf_dir):
    raw = inputs.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("source_name"))
    return lookup.attach_source(raw, _sources(spark, sf_dir))


# Pages.

@query
def page_items(spark, sf_dir):
    return page_sources.page_items(inputs.table(spark, sf_dir, "pages")).drop("pos")


@query
def page_anchors(spark, sf_dir):
    return page_sources.page_anchors(inputs.table(spark, sf_dir, "pages"), keep_nav=True, min_words=1)


@query
def page_anchors_named(spark, sf_dir):
    """The default rules: no navigation, two words. The heading of each page
    stands in for anchors with names, which the pages do not have."""
    heading = F.regexp_replace("html", "(?is)<h1[^>]*>(.*?)</h1[^>]*>", '<a class="x" href="/story?a=1">$1</a>')
    return page_sources.page_anchors(inputs.table(spark, sf_dir, "pages").withColumn("html", heading))


def _varied(html):
    """Pages with other markup, by their length: a second heading with a link, a class in place of the
    tag, a marked link, navigation inside navigation, tags that are not closed, and no candidate at all."""
    kind = F.length(html) % 6
    heading = lambda by: F.regexp_replace(F.replace(F.replace(html, F.lit("<article>"), F.lit("<section>")), F.lit("</article>"), F.lit("</section>")), "<h1>(.*?)</h1>", by)
    return (
        F.when(kind == 0, heading('<h2><a href="/story/1?a=b">$1</a></h2>'))
        .when(kind == 1, heading('<div class="big article"><a href="/x">$1</a></div>'))
        .when(kind == 2, heading('<nav><nav><a href="/news/0">In the menu</a></nav><a href="/news/1">$1</a></nav><a data-qa="the-headline" href="/y">$1</a>'))
        .when(kind == 3, F.replace(html, F.lit("</h1>"), F.lit("<!-- <h2>no no</h2> -->")))
        .when(kind == 4, heading("<h3>$1</h3>"))
        .otherwise(html))


@query
def page_candidates(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages").withColumn("html", _varied(F.col("html")))
    return page_sources.page_candidates(pages)


@query
def union_all_sources(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    found = page_sources.page_items(pages).select("source", "headline", "url")
    cleaned = accepted(_outcome(spark, sf_dir)).select("source", "headline", "url")
    return cleaned.unionByName(found)


# Responses.

@query
def json_locate(spark, sf_dir):
    body = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    wrapped = (
        F.when(F.col("event_type") == "view", F.concat(F.lit("See [1]:\n```json\n"), body, F.lit(" \n```\n[2]")))
        .when(F.col("event_type") == "click", F.concat(F.lit("Items: "), body, F.lit(" end")))
        .otherwise(F.col("props"))
    )
    return inputs.table(spark, sf_dir, "events").select("event_id", locate_json(wrapped).alias("json_text"))


@query
def json_items(spark, sf_dir):
    wrapped = F.when(F.col("event_type") == "view", F.concat(F.lit('[1, "x", '), "props", F.lit(", null, "), "props", F.lit("]"))) \
        .when(F.col("event_type") == "click", F.concat(F.lit('[{"k": 5, "x": NaN}, '), "props", F.lit(", -Infinity]"))) \
        .when(F.col("event_type") == "error", F.concat("props", F.lit(" and more"))).otherwise(F.col("props"))
    events = inputs.table(spark, sf_dir, "events").select("event_id", wrapped.alias("json_text"))
    parsed = with_parsed_items(events, "json_text", "items")
    first = F.try_variant_get(F.get("items", F.lit(0)), "$.k", "bigint")
    return parsed.select("event_id", F.coalesce(F.size("items"), F.lit(-1)).alias("n_items"), first.alias("k"))


@query
def json_items_torn(spark, sf_dir):
    """Arrays that are no JSON as a whole, element by element: one is broken, one of some is too large."""
    large = F.when(F.col("event_type") == "click", F.concat(F.lit(', {"x": ['), F.repeat(F.concat("props", F.lit(", ")), F.lit(50)), F.lit("1]}"))).otherwise(F.lit(""))
    text = F.concat(F.lit('[1, '), "props", F.lit(', {bad [{}]}, {"k": NaN}'), large, F.lit(', {"s": "a, {b] \\" c"}, '), "props", F.lit("]"))
    events = inputs.table(spark, sf_dir, "events").select("event_id", torn_items(text, 300).alias("items"))
    reasons = lambda why: F.size(F.filter("items", lambda e: e["reason"] == why))
    last = F.get("items", F.size("items") - 1)["value"]
    return events.select("event_id", F.size(F.filter("items", lambda e: e["value"].isNotNull())).alias("n_items"), reasons("bad_item").alias("n_bad"),
                         reasons("too_large").alias("n_large"), F.try_variant_get(last, "$.k", "bigint").alias("k"))


@query
def clean_batch(spark, sf_dir):
    return accepted(_outcome(spark, sf_dir))


@query
def clean_batch_ci(spark, sf_dir):
    return accepted(_outcome(spark, sf_dir, url_mode="ci"))


@query
def clean_batch_quarantine(spark, sf_dir):
    return accepted(_outcome(spark, sf_dir, on_bad_item="quarantine"))


@query
def clean_batch_first_items(spark, sf_dir):
    return accepted(_outcome(spark, sf_dir, max_items=10))


@query
def clean_batch_long_blacklist(spark, sf_dir):
    outcome = _outcome(spark, sf_dir, blacklist=inputs.word_blacklist(spark, sf_dir))
    return outcome.groupBy("source", "reason").agg(F.count("*").alias("n_rows"), F.count("url").alias("n_urls"), F.max("url").alias("last_url"))


@query
def response_accounting(spark, sf_dir):
    """Items and rejects of every response that came in; none has neither."""
    raw = inputs.raw_responses(spark, sf_dir).select("response_id")
    outcome = _outcome(spark, sf_dir).groupBy("response_id").agg(
        F.count_if(F.col("reason").isNull()).alias("n_items"), F.count("reason").alias("n_rejects"))
    return raw.join(outcome, "response_id", "left")


@query
def batch_rejects(spark, sf_dir):
    return rejected(_outcome(spark, sf_dir)).select("response_id", "pos", "id", "source", "reason")


@query
def require_fields(spark, sf_dir):
    lines = inputs.lines(spark, sf_dir).withColumn("href", F.when(F.length("headline") > 20, F.lit("/x")))
    one_word = ~F.contains(F.col("headline"), F.lit(" "))
    lines = lines.withColumn("headline", F.when(one_word, F.lit("")).otherwise(F.col("headline")))
    return item_ops.require_fields(lines).select("doc_id", "pos", "reason")


@query
def ordered_items(spark, sf_dir):
    return item_ops.stable_order(accepted(_outcome(spark, sf_dir)), inputs.registry(spark, sf_dir))


# Loading.

@query
def finalize_items(spark, sf_dir):
    return articles.finalize_item(accepted(_outcome(spark, sf_dir)).drop("published_at"))


@query
def format_articles(spark, sf_dir):
    return articles.format_article(accepted(_outcome(spark, sf_dir)))


def _resolved(spark, sf_dir):
    return resolve_articles(accepted(_outcome(spark, sf_dir)), _source_ids(spark, sf_dir))


@query
def prepare_insert(spark, sf_dir):
    return append_articles(_resolved(spark, sf_dir), stored="", write=False)


@query
def append_read_back(spark, sf_dir):
    path = _scratch(spark)
    append_articles(_resolved(spark, sf_dir), stored=path)
    return spark.read.parquet(path)


@query
def outcome_read_back(spark, sf_dir):
    path = _scratch(spark)
    write_outcome(_outcome(spark, sf_dir), path)
    return spark.read.parquet(path).groupBy("status", "source").agg(F.count("*").alias("n_rows"))


@query
def load_read_back(spark, sf_dir):
    """Both sides of a load as they are stored; sites with two digits have no id."""
    stored, rejects = _scratch(spark), _scratch(spark)
    ids = _source_ids(spark, sf_dir).filter(F.length("source_key") < 5)
    append_articles(resolve_articles(accepted(_outcome(spark, sf_dir)), ids), stored, rejects)
    kept = spark.read.parquet(stored).select(F.col("uniqueName").alias("name"), "url", F.col("source").alias("source_id"))
    return kept.unionByName(spark.read.parquet(rejects).select(F.col("uniqueName").alias("name"), "url", "reason"), allowMissingColumns=True)


@query
def load_rejects(spark, sf_dir):
    return _resolved(spark, sf_dir).filter("reason is not null").select("uniqueName", "source", "url", "reason")


def _known(spark, sf_dir):
    return inputs.lines(spark, sf_dir).select(
        F.concat(F.lit("http://www."), "source", F.lit(".example.com/../"), F.substring_index("headline", " ", 1), F.lit("%2520x")).alias("url"))


@query
def skip_known(spark, sf_dir):
    return append_articles(_resolved(spark, sf_dir), stored="", write=False, skip_known_urls=_known(spark, sf_dir))


def _loaded(spark, sf_dir):
    """The whole outcome with load reasons; sites with two digits have no id."""
    ids = _source_ids(spark, sf_dir).filter(F.length("source_key") < 5)
    return resolve_outcome(_outcome(spark, sf_dir), ids, _known(spark, sf_dir))


# Reports.

@query
def items_per_source(spark, sf_dir):
    return reports.items_per_source(_sources(spark, sf_dir), accepted(_outcome(spark, sf_dir)))


@query
def rejects_by_reason(spark, sf_dir):
    """Rejects of the cleaning and of the load, in one report."""
    return reports.rejects_by_reason(rejected(_loaded(spark, sf_dir)))


@query
def run_report(spark, sf_dir):
    """Counts of a run as they are observed while it is written."""
    counts = load_run(_loaded(spark, sf_dir), _scratch(spark), _scratch(spark))
    return spark.createDataFrame([(k, n) for k, n in counts.items() if n or k in ("fetched", "stored")], "count_of string, n bigint")


@query
def run_summary(spark, sf_dir):
    return reports.run_summary(_sources(spark, sf_dir), _resolved(spark, sf_dir))


@query
def stored_count(spark, sf_dir):
    return reports.stored_count(_resolved(spark, sf_dir))


# Options.

@query
def recent_items(spark, sf_dir):
    orders = inputs.table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("published_at"))
    return item_ops.within_period(orders, "published_at", "1998-08-01", 30)


@query
def topic_items(spark, sf_dir):
    return item_ops.topic_and_junk(inputs.lines(spark, sf_dir), "headline", terms=["the", "le "], min_words=4)


@query
def topic_items_listed(spark, sf_dir):
    """Terms that grow with the documents: the last two words of every exclamation."""
    return item_ops.topic_and_junk(inputs.lines(spark, sf_dir), "headline", terms=inputs.ending_terms(spark, sf_dir), min_words=4)


@query
def limit_per_source(spark, sf_dir):
    lines = inputs.lines(spark, sf_dir).withColumn("place", F.struct("doc_id", "pos"))
    return item_ops.limit_per_source(lines, "source", "place", 10).drop("place")


# Streaming.

def _streamed(spark, sf_dir, blacklist):
    folder = _scratch(spark)
    inputs.raw_responses(spark, sf_dir).write.parquet(f"{folder}/landing")
    ingest_available(
        spark, f"{folder}/landing", f"{folder}/outcome", f"{folder}/state", _sources(spark, sf_dir, disabled=True), blacklist,
    ).awaitTermination()
    return spark.read.parquet(f"{folder}/outcome")


@query
def stream_ingest(spark, sf_dir):
    outcome = _streamed(spark, sf_dir, inputs.blacklist(spark))
    return accepted(outcome.filter("status = 'accepted'")).drop("status")


@query
def stream_ingest_long_blacklist(spark, sf_dir):
    outcome = _streamed(spark, sf_dir, inputs.word_blacklist(spark, sf_dir))
    return outcome.groupBy("source", "reason").agg(F.count("*").alias("n_rows"), F.count("url").alias("n_urls"), F.max("url").alias("last_url"))


@query
def stream_load(spark, sf_dir):
    """Both sides of a load in two micro-runs, of two thirds and one third of the
    files, as they are stored. Large inputs land in as many files as they are read in."""
    folder = _scratch(spark)
    raw = inputs.raw_responses(spark, sf_dir)
    files = max(3, raw.rdd.getNumPartitions())
    raw.repartition(files).write.parquet(f"{folder}/landing")
    ids = _source_ids(spark, sf_dir).filter(F.length("source_key") < 5)
    load_available(
        spark, f"{folder}/landing", f"{folder}/stored", f"{folder}/rejects", f"{folder}/state", _sources(spark, sf_dir, disabled=True),
        ids, inputs.blacklist(spark), _known(spark, sf_dir), files_per_run=-(-2 * files // 3),
    ).awaitTermination()
    both = [F.col("uniqueName").alias("name"), F.col("source").cast("string").alias("source"), "url"]
    stored = spark.read.parquet(f"{folder}/stored").select(F.lit("stored").alias("side"), *both)
    rejects = spark.read.parquet(f"{folder}/rejects").select(F.lit("rejects").alias("side"), "response_id", "pos", *both, "reason")
    return stored.unionByName(rejects, allowMissingColumns=True)
