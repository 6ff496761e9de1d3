"""Candidate articles from fetched HTML pages, by rules."""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.functions import markup
from newsloom.functions.text import WS, headline_slug, strip_text
from newsloom.functions.urls import resolve_href, with_source_domain
from newsloom.operators.items import topic_and_junk
from newsloom.operators.workers import on_workers

# What a page's candidate articles look like.
CANDIDATES = "a[href*='/news'], a[href*='/story'], article, .article, a[data-qa*='headline'], h1, h2"
# The entities that are decoded; &amp; last.
ENTITIES = {
    "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&nbsp;": "\xa0",
    "&middot;": "\xb7", "&copy;": "\xa9", "&amp;": "&",
}


def plain_text(text: Column) -> Column:
    """Text between tags as it reads: entities decoded, blanks collapsed."""
    for entity, char in ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return strip_text(F.regexp_replace(text, f"[{WS}]+", " "))


def page_elements(pages: DataFrame, selectors: str, keep_nav: bool = False, keep: str = "all") -> DataFrame:
    """(page_id, page_url, base_url, pos, selector, tag, headline, href) of the elements that match a list of selectors.

    Pages (page_id, url, html) are read tag by tag with a stack (see `functions.markup`). The headline
    of an anchor is its text; of other elements that of their first heading, or else of
    their first anchor, and the address is the one around or in it. Headlines
    and addresses that are not there are ''. pos counts a page's elements, by default without navigation; `keep`
    leaves "all" of them, those of "distinct" headline and address, or the "first" with a headline. A
    page without any has one row with null from pos on; a null page counts as empty.
    """
    if keep not in ("all", "distinct", "first"):
        raise ValueError(f"unknown keep: {keep!r}")
    wanted = markup.selectors(selectors)
    names = [selector.text for selector in wanted]
    text = T.StringType()
    schema = T.StructType([
        T.StructField("page_id", pages.schema["page_id"].dataType), T.StructField("page_url", text), T.StructField("pos", T.IntegerType()),
        *(T.StructField(name, text) for name in ("selector", "tag", "headline", "href"))])

    def read(batches):
        for batch in batches:
            rows, owners = [], []
            for n, html in enumerate(batch["html"]):
                found = {}
                for e in markup.elements(html.as_py() or "", wanted):
                    anchor = e.tag == "a" or e.heading is None
                    headline = " ".join(((e.anchor if anchor else e.heading) or "").split())
                    href = (e.anchor_href if anchor else e.heading_href) or ""
                    if keep_nav or not e.in_nav:
                        found.setdefault(len(found) if keep == "all" else (headline, href), (names[e.selector], e.tag, headline, href))
                kept = [(pos, *e) for pos, e in enumerate(found.values())]
                if keep == "first":
                    kept = [e for e in kept if e[3]][:1]
                rows += kept or [(None,) * 5]
                owners += [n] * max(1, len(kept))
            at = pa.array(owners, pa.int64())
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            types = [pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays(
                [batch["page_id"].take(at), batch["page_url"].take(at), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)

    slim = pages.select("page_id", F.col("url").alias("page_url"), "html")
    df = on_workers(slim).mapInArrow(read, schema).withColumn("headline", plain_text(F.col("headline")))
    return df.withColumn("base_url", F.regexp_extract("page_url", "^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1))


def _as_items(df: DataFrame, published_at: str | None, *more: str) -> DataFrame:
    """Complete candidates that have `headline` and `href`."""
    df = df.withColumn("url", resolve_href(F.col("href"), F.col("base_url")))
    df = with_source_domain(df, "page_url", "source")
    return df.select(
        "page_id", "pos", headline_slug("headline").alias("id"), "source", "headline", "href", "url",
        F.lit(published_at or "").alias("published_at"), *more,
    )


def page_anchors(pages: DataFrame, published_at: str | None = None, keep_nav: bool = False,
                 min_words: int = 2) -> DataFrame:
    """Anchors of each page that look like article links, in page order. By
    default without navigation and without headlines of one word."""
    df = page_elements(pages, "a[href]", keep_nav).filter("headline <> ''")
    return _as_items(topic_and_junk(df, "headline", min_words=min_words), published_at)


def page_items(pages: DataFrame, published_at: str | None = None) -> DataFrame:
    """Each page itself as a candidate, under its first heading with text."""
    df = page_elements(pages, "h1", keep_nav=True, keep="first").filter("headline <> ''")
    df = df.withColumns({"pos": F.lit(0), "base_url": F.lit(""), "href": F.col("page_url")})
    return _as_items(df, published_at)


def page_candidates(pages: DataFrame, selectors: str = CANDIDATES, published_at: str | None = None, min_words: int = 2) -> DataFrame:
    """The elements of each page that may stand for an article, with the selector that found them and `reason`.

    A heading or article without an address stands for its page. Of elements of
    a page with one headline and address the first counts. Reasons, null for
    the candidates to take: no_candidate (a row for a page that has no element), missing_headline, short_headline
    (under `min_words` words). Navigation is left out.
    """
    df = page_elements(pages, selectors, keep="distinct")
    df = df.withColumn("href", F.coalesce(F.nullif("href", F.lit("")), "page_url"))
    words = F.size(F.filter(F.split("headline", f"[{WS}]+"), lambda w: w != ""))
    df = df.withColumn("reason", F.when(F.col("pos").isNull(), "no_candidate").when(F.col("headline") == "", "missing_headline")
                       .when(words < min_words, "short_headline"))
    return _as_items(df, published_at, "selector", "reason")
