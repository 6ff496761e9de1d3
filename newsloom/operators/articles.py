"""From cleaned items to rows of the article tables."""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.schemas import ARTICLE_SCHEMA, STORED_SCHEMA


def _first_present(df: DataFrame, *names: str, default=None) -> Column:
    """First of the named columns that the table has; a null in it stays."""
    return next((F.col(n) for n in names if n in df.columns), F.lit(default).cast("string"))


def finalize_item(df: DataFrame) -> DataFrame:
    """The seven item columns; source and date default to '' if the table
    lacks them, and no item counts as processed."""
    return df.select(
        "id", _first_present(df, "source", default="").alias("source"), "headline", "href", "url",
        _first_present(df, "published_at", default="").alias("published_at"), F.lit(False).alias("isProcessed"),
    )


def format_article(items: DataFrame) -> DataFrame:
    """Items under the column names of the article table."""
    # Article column and item column.
    origin = {"uniqueName": "id", "publishedAt": "published_at"}
    return items.select(
        *(_first_present(items, origin.get(f.name, f.name), default="").alias(f.name) for f in ARTICLE_SCHEMA[:-1]),
        F.lit(False).alias("isProcessed"),
    )


def prepare_insert(articles: DataFrame) -> DataFrame:
    """Rows of the stored table. Takes articles with `source_id`, under either
    the item or the article column names."""
    names = {
        "uniqueName": _first_present(articles, "uniqueName", "id", default=""),
        "source": F.col("source_id"),
        "headline": _first_present(articles, "headline"),
        "href": _first_present(articles, "href"),
        "url": _first_present(articles, "url"),
        "publishedAt": _first_present(articles, "publishedAt", "published_at"),
        "isProcessed": F.lit(False),
    }
    return articles.select(*(names[f.name].cast(f.dataType).alias(f.name) for f in STORED_SCHEMA))
