"""Jump consistent hashing: rows to shards by their key, without a ring table."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from newsloom.llm.shared import column, row_id, written


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 to shards - 1 of a key (text; null is a key of its own).

    The key jumps from shard count to shard count: from b it next moves when the
    count exceeds floor((b + 1) / r), r uniform in (0, 1] and decided by key and
    b alone. Its shard is the last b below `shards`. With one more shard a key
    stays or moves into the new one. r comes from XXH64 in place of the usual
    congruential generator, whose wrapping products SQL arithmetic rejects.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    draw = lambda b: F.shiftrightunsigned(F.xxhash64(key, b), 32)
    ahead = lambda b: F.floor(F.shiftleft(b + 1, 32) / (draw(b) + 1)).cast("bigint")
    zero = F.lit(0).cast("bigint")
    start = F.struct(zero.alias("b"), ahead(zero).alias("j"))
    last = F.aggregate(
        F.sequence(F.lit(1), F.lit(shards)), start,
        lambda at, _: F.when(at.j < shards, F.struct(at.j.alias("b"), ahead(at.j).alias("j"))).otherwise(at),
    )
    return last.b.cast("int")


def shard_rows(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, blocks: int = 256,
) -> DataFrame:
    """One row per input row: id_col, size (UTF-8 bytes + 1), text_crc32, law,
    shard, slot (gapless from 0 in its shard), grown_shard (with one more shard).

    Slots: each shard's rows are numbered within `blocks` blocks, and each block
    starts after those before it; the block counts (at most shards * blocks
    rows) are all that is added up in one place.

    Null text counts as empty; rows with a null id share one key; rows repeated
    keep a row each and share a shard; extra columns are left out.
    """
    key = column(id_col).cast("string")
    data = F.coalesce(column(text_col), F.lit("")).cast("binary")
    slim = written(df.select(
        column(id_col).alias("id"), (F.octet_length(data).cast("bigint") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"), jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"), row_id().alias("row"),
    ))
    slim = slim.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    counts = slim.groupBy("shard", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("row"))
    placed = slim.withColumn("within", within).join(starts, ["shard", "block"])
    return placed.select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("start") + F.col("within") - 1).alias("slot"), "grown_shard",
    )
