"""Near-duplicates by SimHash, found by meeting in the middle."""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F, types as T

from newsloom.llm.components import connected
from newsloom.llm.shared import column, on_workers, row_id, written

BITS = 64


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """SimHash of a text's word shingles: a bit is set if it is set in over half
    of the shingles' XXH64 values. No words: 0."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    hashed = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), dtype=">u8")
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashed)).tobytes(), "big", signed=True)


def with_fingerprint(df: DataFrame, text_col: str, to: str, width: int = 3, seed: int = 42) -> DataFrame:
    """`df` with the fingerprint of its text as a signed 64-bit number.

    A-Z count as a-z; words end at ASCII white space. Null text counts as empty.
    """
    @F.arrow_udf(T.LongType())
    def of(texts: pa.Array) -> pa.Array:
        return pa.array((fingerprint(t.as_py() or b"", width, seed) for t in texts), pa.int64())

    return on_workers(df).withColumn(to, of(column(text_col).cast("binary")))


def fingerprint_links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between the distinct values of the column `fp` that join all
    fingerprints within `radius` bits.

    Every fingerprint emits all values within half the radius; two fingerprints
    link if and only if they meet at one. Those that meet at a value lie in one
    ball around it, so there are at most 65 of them (for radius 2), and each is
    within the radius of the smallest. Linking them to the smallest leaves out
    pairs but separates nothing. Links are verified by counting bits.
    """
    if radius < 0 or radius % 2:
        raise ValueError("radius must be an even number of bits")
    masks = [sum(1 << b for b in flips) for k in range(radius // 2 + 1) for flips in combinations(range(BITS), k)]
    masks = [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]
    mask = F.explode(F.array(*[F.lit(m).cast("bigint") for m in masks]))
    variants = prints.select("fp").distinct().select("fp", mask.alias("mask"))
    variants = variants.select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
    met = variants.withColumn("first", F.min("fp").over(Window.partitionBy("variant")))
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("first"))) <= radius
    return met.filter(F.col("fp") != F.col("first")).filter(near).select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct()


def fingerprint_groups(prints: DataFrame, radius: int = 2) -> DataFrame:
    """(fp, root, component_id): for each fingerprint the smallest one it reaches
    and the smallest `id` it reaches, from a written frame with id and fp."""
    own = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected(fingerprint_links(prints, radius))
    own = own.join(roots, own.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    own = written(own)
    return own.join(own.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")


def simhash_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3, seed: int = 42,
) -> DataFrame:
    """One row per input row: id_col, fingerprint (16 hex digits), component_id.

    Null and blank texts have fingerprint 0 and link like any other. Repeated
    rows keep a row each. Null ids are passed over for component_id, which is
    null where a whole group has none. Extra columns are left out.
    """
    slim = df.select(column(id_col).alias("id"), column(text_col).alias("text"))
    prints = written(with_fingerprint(slim, "text", "fp", width, seed).select("id", "fp"))
    groups = fingerprint_groups(prints, radius)
    return prints.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
    )


def one_of_each(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3, seed: int = 42,
) -> DataFrame:
    """`df` with one row of each group of `simhash_components`: that of the
    smallest id (rows without an id come last, ties go by a hash of the row).

    Rows are told apart by two hashes of all their columns, so a row need not be
    numbered and no evaluation depends on how the input is cut. Rows that are
    equal in all columns count once and are merged before they are shuffled.
    Null and blank texts are one group. Columns, clashing names too, stay as they are.
    """
    whole = F.struct(*(F.to_json(F.struct(c)) if isinstance(f.dataType, T.MapType | T.VariantType) else c for c, f in zip(map(column, df.columns), df.schema, strict=True)))
    marks = [F.xxhash64(F.lit(k), whole, *(column(c).isNull() for c in df.columns)).alias(f"mark{k}") for k in (1, 2)]
    slim = df.select(*marks, column(id_col).alias("id"), column(text_col).alias("text"))
    prints = written(with_fingerprint(slim, "text", "fp", width, seed).drop("text"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark1", "mark2")).alias("first")
    of_print = prints.groupBy("fp").agg(first)
    kept = of_print.join(fingerprint_groups(prints, radius), "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.mark1").alias("mark1"), F.col("first.mark2").alias("mark2"))
    rows = df.select(*marks, F.struct(*map(column, df.columns)).alias("row")).dropDuplicates(["mark1", "mark2"])
    rows = rows.join(kept, ["mark1", "mark2"], "left_semi")
    return rows.select(*(F.col("row")[name].alias(name) for name in df.columns))
