"""Site registries, source ids and the blacklist."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from newsloom.schemas import BLACKLIST_SCHEMA


def _renamed(registry: DataFrame, names: dict[str, str]) -> DataFrame:
    return registry.select(*(F.col(old).alias(new) for new, old in names.items()))


def scan_sources(registry: DataFrame, disabled: bool = False) -> DataFrame:
    """Enabled sites, or with `disabled` all of them. A registry without
    `isPrimarySource` has no primary ones."""
    if "isPrimarySource" not in registry.columns:
        registry = registry.withColumn("isPrimarySource", F.lit(False))
    # New and old column names.
    sources = _renamed(registry, {
        "name": "Name", "url": "url", "base_url": "baseUrl", "execute": "isExecute",
        "primary_source": "isPrimarySource",
    })
    return sources if disabled else enabled_sources(sources)


def scan_team_sources(registry: DataFrame) -> DataFrame:
    """Enabled team sites."""
    # New and old column names.
    return _renamed(registry.filter("isExecute"), {
        "id": "id", "created_at": "created_at", "url": "url", "base_url": "baseUrl", "team": "Team",
        "execute": "isExecute",
    })


def enabled_sources(sources: DataFrame) -> DataFrame:
    """Sites to run; without an `execute` column that is all of them."""
    return sources.filter("execute") if "execute" in sources.columns else sources


def scan_source_ids(registry: DataFrame) -> DataFrame:
    """Upper-case name and id; of names that differ only in case, the highest id."""
    return registry.groupBy(F.upper("Name").alias("source_key")).agg(F.max("id").alias("source_id"))


def scan_blacklist(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """URL prefixes from a JSON array of {"url": ...}; empty when the file is
    missing or is not one JSON array. With `lines`, from files with one such
    object per line, which many tasks can read.

    The array form streams through a file of any size, in one task a file.
    Entries before the place where a broken file breaks do not count either.
    """
    schema = T.StructType([*BLACKLIST_SCHEMA, T.StructField("__broken", T.StringType())])
    try:
        if lines:
            return spark.read.schema(BLACKLIST_SCHEMA).json(path).filter("url <> ''")
        read = spark.read.schema(schema).option("columnNameOfCorruptRecord", "__broken").option("multiLine", True)
        entries = read.json(path).withColumn("__file", F.col("_metadata.file_path"))
        single = spark.read.text(path).select(F.col("_metadata.file_path").alias("__file"), F.ltrim("value", F.lit(" \t\r\n\ufeff")).alias("line"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BLACKLIST_SCHEMA)
    # The reader does not let a query look at broken records alone, so URLs are counted as well.
    files = entries.groupBy("__file").agg(F.count("__broken").alias("broken"), F.count("url").alias("urls"))
    whole = files.filter("broken = 0 and urls > 0").select("__file")
    # An array is told from a single object by its first line that is not blank.
    start = single.withColumn("n", F.monotonically_increasing_id()).filter("line <> ''")
    arrays = start.groupBy("__file").agg(F.min_by(F.left("line", F.lit(1)), "n").alias("first")).filter("first = '['").select("__file")
    entries = entries.join(whole, "__file", "left_semi").join(arrays, "__file", "left_semi")
    return entries.select("url").filter("url <> ''")
