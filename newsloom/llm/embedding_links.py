"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, and a rerank with the vectors themselves."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.components import connected
from newsloom.llm.shared import column, on_workers, row_id, written


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors with 1 as the size of their largest component, so that no square is too large or too small for a number."""
    return vectors / np.abs(vectors).max(axis=1, keepdims=True)


def unit(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def thresholds(values: np.ndarray) -> np.ndarray:
    """Where each column is cut in two: at its median. If values crowd there (a
    large group of near copies, which a cut would part), in the widest gap of the middle half."""
    ordered, n = np.sort(values, axis=0), len(values)
    at = lambda share: ordered[min(n - 1, int(share * n))]
    crowded = (at(0.51) - at(0.49)) * 25 < (at(0.75) - at(0.25)) / 4
    low, high = n // 4, max(n // 4 + 2, 3 * n // 4)
    gaps = np.diff(ordered[low:high], axis=0)
    if not len(gaps):
        return np.median(values, axis=0)
    widest = low + gaps.argmax(axis=0)
    columns = np.arange(values.shape[1])
    return np.where(crowded, (ordered[widest, columns] + ordered[np.minimum(widest + 1, n - 1), columns]) / 2, np.median(values, axis=0))


class Codes:
    """Binary codes of unit vectors: principal components, then a rotation that
    brings them near their signs, then `thresholds`, so that every
    bit is balanced. Longer codes take several rotations."""

    def __init__(self, sample: np.ndarray, bits: int, rounds: int = 30, seed: int = 11):
        rng = np.random.default_rng(seed)
        dims = sample.shape[1]
        self.mean = sample.mean(axis=0) if len(sample) else np.zeros(dims)
        centred = sample - self.mean
        spread, axes = np.linalg.eigh(centred.T @ centred + 1e-12 * np.eye(dims))
        turns = []
        for _ in range(-(-bits // dims)):
            turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
            for _ in range(rounds if len(sample) else 0):
                left, _, right = np.linalg.svd(np.where(centred @ axes @ turn >= 0, 1.0, -1.0).T @ (centred @ axes))
                turn = (left @ right).T
            turns.append(axes @ turn)
        self.turn = np.hstack(turns)[:, :bits]
        self.middle = thresholds(centred @ self.turn) if len(sample) else np.zeros(bits)

    def of(self, vectors: np.ndarray) -> np.ndarray:
        return (vectors - self.mean) @ self.turn >= self.middle


def tables_for(largest: int, same: float, bucket: int, miss: float, most: int = 64) -> tuple[int, int]:
    """(tables, bits of a key): keys long enough for about `bucket` vectors of
    the largest label in a bucket, and tables enough that a pair of which each bit agrees with the chance
    `same` shares no key with a chance of `miss`. Keys are shorter where that would take over `most` tables."""
    bits = max(2, min(30, math.ceil(math.log2(max(largest, 1) / bucket)))) if largest > 4 * bucket else 2
    while True:
        tables = max(2, math.ceil(math.log(miss) / math.log(1 - min(same, 1 - 1e-9) ** bits)))
        if tables <= most or bits == 2:
            return tables, bits
        bits -= 1


def agreement(units: np.ndarray, bits: np.ndarray, cosine: float, block: int = 512, pairs: int = 200_000) -> float:
    """The share of bits in which linked vectors of the sample agree, at least in 98 of 100 links; 1 without links."""
    found, n = [], 0
    for start in range(0, len(units), block):
        i, j = np.nonzero(units[start:start + block] @ units.T >= cosine)
        i += start
        i, j = i[i < j], j[i < j]
        step = max(1, len(i) * (len(units) // block + 1) // pairs)
        found.append((bits[i[::step]] == bits[j[::step]]).mean(axis=1))
    found = np.concatenate(found) if found else np.zeros(0)
    return float(np.quantile(found, 0.02)) if len(found) else 1.0


def lowest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For n nodes and links a-b the smallest node each reaches."""
    low = np.arange(n)
    while len(a):
        before = low.copy()
        least = np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        low = low[low]
        if (low == before).all():
            break
    return low


def bucket_links(ids, weights, vectors, keys, table: int, left, right, cosine: float, block: int = 512):
    """Links between the rows `left` and `right` of a bucket (all pairs if they
    are the same), in blocks; those that an earlier table holds are its own.
    Returns for each row what it links to, by weight, and its smallest partner
    through links of this bucket."""
    units, counts, found = unit(vectors), np.zeros(len(ids), dtype=np.int64), []
    same = left is right
    for x in range(0, len(left), block):
        rows = left[x:x + block]
        for y in range(x if same else 0, len(right), block):
            cols = right[y:y + block]
            i, j = np.nonzero(units[rows] @ units[cols].T >= cosine - 1e-9)
            a, b = rows[i], cols[j]
            if same:
                a, b = a[a < b], b[a < b]
            va, vb = scaled(vectors[a]), scaled(vectors[b])
            exact = (va * vb).sum(axis=1) / np.sqrt((va * va).sum(axis=1) * (vb * vb).sum(axis=1))
            new = (exact >= cosine) & ~(keys[a, :table] == keys[b, :table]).any(axis=1)
            a, b = a[new], b[new]
            np.add.at(counts, a, weights[b])
            np.add.at(counts, b, weights[a])
            found.append((a, b))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
    return counts, lowest_reachable(len(ids), a, b)


def _usable(vector: Column) -> Column:
    """No null, nothing that is not finite, not all zero, not empty."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0)


def linked_vectors(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98,
    sample: int = 8_192, bucket: int = 256, miss: float = 0.002, chunk: int = 16_384,
) -> DataFrame:
    """One row per input row: id_col, n_links, component_id, kept.

    Rows are compared only with equal, non-null labels and equally long vectors.
    Equal vectors of a label are counted first and go on as one. The codes are
    fitted on at most `sample` vectors, those of the smallest hashes, and the
    number of tables on how often linked ones of these agree; all vectors are indexed. A bucket of over `chunk` vectors is cut into chunks, and each pair
    of chunks is a task of its own, so nothing is left out. Tasks return a row
    per vector, not per link.

    Vectors that are null, empty, zero or hold a null or a value that is not
    finite, and rows without a label, link with nothing; their component is
    their own id. Each repeated row counts as another vector. Null ids are
    passed over for component_id; a row without id is not kept. Extra columns
    are left out.
    """
    rows = written(df.select(
        column(id_col).alias("id"), column(label_col).alias("label"), column(vector_col).cast("array<double>").alias("vector"),
    ).withColumn("usable", _usable(F.col("vector")) & F.col("label").isNotNull()))
    usable = rows.filter("usable").drop("usable")
    classes = usable.groupBy("label", "vector").agg(F.count("*").alias("weight"), F.min("id").alias("least"))
    classes = written(classes.select(row_id().alias("class"), F.size("vector").alias("dims"), "label", "vector", "weight", "least"))
    sizes = classes.groupBy("label", "dims").agg(F.count("*").alias("n")).groupBy("dims").agg(F.max("n").alias("n"))
    models = {}
    for dims, largest in sizes.collect():  # one row per length of vectors
        theory = 1 - math.acos(cosine) / math.pi
        tables, bits = tables_for(largest, theory, bucket, miss)
        chosen = classes.filter(F.col("dims") == dims).orderBy(F.xxhash64("vector"), "class").limit(sample).select("vector")
        units = unit(np.array([r[0] for r in chosen.collect()]))
        fitted = Codes(units, tables * bits)
        measured = agreement(units, fitted.of(units), cosine)
        if measured < theory:  # the vectors lie closer together than directions at random
            tables, bits = tables_for(largest, measured, bucket, miss)
            fitted = Codes(units, tables * bits)
        models[dims] = tables, bits, fitted
    shared = df.sparkSession.sparkContext.broadcast(models)

    @F.pandas_udf("array<int>")
    def keys_of(vectors: pd.Series) -> pd.Series:
        out = [None] * len(vectors)
        lengths = vectors.map(len).to_numpy()
        for dims in np.unique(lengths):
            tables, bits, codes = shared.value[dims]
            at = np.flatnonzero(lengths == dims)
            parts = codes.of(unit(np.stack([vectors.iloc[i] for i in at]))).reshape(len(at), tables, bits)
            for i, keys in zip(at, parts @ (1 << np.arange(bits)), strict=True):
                out[i] = keys.astype(np.int32)
        return pd.Series(out)

    coded = written(on_workers(classes).withColumn("keys", keys_of("vector")).drop("least"))
    place = ["label", "dims", "table", "key"]
    spread = coded.select("class", "weight", "label", "dims", "keys", "vector", F.posexplode("keys").alias("table", "key"))
    large = spread.groupBy(*place).agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
    large = written(large.select(*place, F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    spread = spread.join(large, place, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    spread = spread.withColumn("mine", F.pmod(F.xxhash64("class"), F.col("chunks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    spread = spread.withColumn("low", F.least("mine", "other")).withColumn("high", F.greatest("mine", "other"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("class", ignore_index=True)
        ids, first = frame["class"].to_numpy(), frame.iloc[0]
        at = [np.flatnonzero(frame["mine"] == c) for c in (first["low"], first["high"])]
        counts, low = bucket_links(
            ids, frame["weight"].to_numpy(), np.stack(frame["vector"]), np.stack(frame["keys"]), int(first["table"]), at[0],
            at[0] if first["low"] == first["high"] else at[1], cosine)
        some = counts > 0
        return pd.DataFrame({"class": ids[some], "links": counts[some], "root": ids[low][some]})

    found = written(spread.groupBy(*place, "low", "high").applyInPandas(compare, "class bigint, links bigint, root bigint"))
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    groups = connected(found.select(F.col("class").alias("a"), F.col("root").alias("b")))
    out = classes.join(links, "class", "left").join(groups, F.col("class") == F.col("node"), "left")
    out = written(out.select(
        "label", "vector", "least", F.coalesce("root", "class").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    out = out.join(out.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    out = out.select("label", "vector", "n_links", "component_id")
    matched = usable.join(out, ["label", "vector"]).select("id", "n_links", "component_id")
    alone = rows.filter("not coalesce(usable, false)").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return matched.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
