"""Schemas of the tables that the jobs read and write."""

from pyspark.sql import types as T

RAW_RESPONSE_SCHEMA = T.StructType([
    T.StructField("response_id", T.LongType(), False),
    T.StructField("source_name", T.StringType()),
    T.StructField("content", T.BinaryType()),
    T.StructField("fetched_at", T.TimestampType()),
])

ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("isProcessed", T.BooleanType()),
])

ARTICLE_SCHEMA = T.StructType([
    T.StructField("uniqueName", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("href", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("publishedAt", T.StringType()),
    T.StructField("isProcessed", T.BooleanType()),
])

# The stored table differs from ARTICLE_SCHEMA only in the type of `source`.
STORED_SCHEMA = T.StructType([
    T.StructField(f.name, T.LongType() if f.name == "source" else f.dataType)
    for f in ARTICLE_SCHEMA
])

BLACKLIST_SCHEMA = T.StructType([T.StructField("url", T.StringType())])

# Session settings the jobs rely on: duplicate keys in an item keep the last
# value, and hot join keys are split at run time.
SESSION_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}
