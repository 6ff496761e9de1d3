"""Raw extraction responses: one row is one batch."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from newsloom.functions.responses import decode_content
from newsloom.schemas import RAW_RESPONSE_SCHEMA


def scan_raw_responses(responses: DataFrame) -> DataFrame:
    """Responses with their content as text; null content is ''."""
    return responses.withColumn("content", F.coalesce(decode_content("content"), F.lit("")))


def read_raw_responses(spark: SparkSession, path: str, streaming: bool = False, **options: str) -> DataFrame:
    reader = spark.readStream if streaming else spark.read
    return scan_raw_responses(reader.options(**options).schema(RAW_RESPONSE_SCHEMA).parquet(path))
