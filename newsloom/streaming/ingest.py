"""Incremental runs over newly landed responses."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators.blacklist import prefix_index
from newsloom.plans.clean import clean_responses
from newsloom.plans.load import load_run, resolve_outcome, with_status
from newsloom.sources.responses import read_raw_responses


def ingest_available(
    spark: SparkSession, landing: str, outcome: str, checkpoint: str, sources: DataFrame,
    blacklist: DataFrame | None = None, **options,
) -> StreamingQuery:
    """Clean the responses that landed since the last run, then stop.

    The plan has no state; the file sink and the checkpoint together write every
    response's outcome exactly once. The blacklist is reduced once, for all micro-runs. Items and rejects go
    to the folders status=accepted and status=rejected of `outcome`.
    """
    responses = read_raw_responses(spark, landing, streaming=True)
    cleaned = clean_responses(responses, sources, blacklist, **options)
    return (
        with_status(cleaned).writeStream.format("parquet").partitionBy("status")
        .option("path", outcome).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def load_available(
    spark: SparkSession, landing: str, stored: str, rejects: str, checkpoint: str, sources: DataFrame, source_ids: DataFrame,
    blacklist: DataFrame | None = None, known: DataFrame | None = None, files_per_run: int | None = None,
    report: Callable[[int, dict[str, int]], None] | None = None, **options,
) -> StreamingQuery:
    """Clean and load the responses that landed since the last run, then stop.

    Each micro-run (of at most `files_per_run` files) writes its articles and
    its rejects, of the cleaning and of the load, to run=<number> of the tables `stored` and `rejects`. The
    checkpoint gives a micro-run that was broken off the same number and files
    again, and its folders are replaced: every response counts exactly once on
    both sides. `report` gets the number and the counts (see `load_run`) of each micro-run.

    `known` (column url) is read anew by every micro-run; addresses in it are not stored again.
    """
    index = None if blacklist is None else prefix_index(blacklist)
    reader = {} if files_per_run is None else {"maxFilesPerTrigger": str(files_per_run)}
    responses = read_raw_responses(spark, landing, streaming=True, **reader)

    def load(batch: DataFrame, run: int) -> None:
        cleaned = clean_responses(batch, sources, index, **options)
        counts = load_run(resolve_outcome(cleaned, source_ids, known), stored, rejects, run)
        if report is not None:
            report(run, counts)

    return responses.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
