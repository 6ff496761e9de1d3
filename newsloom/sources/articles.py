"""Stored articles."""

from pyspark.sql import DataFrame, functions as F


def scan_existing(stored: DataFrame, limit: int = 100) -> DataFrame:
    """Up to `limit` stored articles, in order of name and address."""
    return stored.orderBy("uniqueName", "url", *(c for c in stored.columns if c not in ("uniqueName", "url"))).limit(limit)
