"""Merkle manifest of a table: subtrees of bounded height, each stored in van Emde Boas order."""

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from newsloom.llm.shared import column, on_workers, row_id, written

FAN_OUT = 16
#: Bytes of a digest, and characters of it in hexadecimal.
DIGEST, HEX = 32, 64
RUN = FAN_OUT * HEX


# One subtree.

def level_sizes(n: int, levels: int) -> list[int]:
    """Nodes on each level of a tree over n leaves, from the leaves up."""
    sizes = [n]
    for _ in range(levels - 1):
        sizes.append(-(-sizes[-1] // FAN_OUT))
    return sizes


def levels_over(n: int) -> int:
    """Levels of a tree that ends in one node."""
    levels = 1
    while n > 1:
        n, levels = -(-n // FAN_OUT), levels + 1
    return levels


def address(level: int, index: np.ndarray, n: int, levels: int) -> np.ndarray:
    """Places of the nodes `index` of a level in the layout of a tree over n leaves.

    The tree is cut at half its height: the upper part comes first, then the
    lower subtrees one after the other, each laid out by the same rule. Only
    the last subtree can be incomplete, so nothing lies behind it that it moves.
    """
    if levels == 1:
        return index
    lower = levels // 2
    span = FAN_OUT ** (lower - 1)
    above = -(-n // (span * FAN_OUT))
    if level >= lower:
        return address(level - lower, index, above, levels - lower)
    subtree, inside = np.divmod(index, FAN_OUT ** (lower - 1 - level))
    last = (n - 1) // span
    place = np.where(
        subtree == last, address(level, inside, n - last * span, lower), address(level, inside, span, lower))
    return sum(level_sizes(above, levels - lower)) + subtree * sum(level_sizes(span, lower)) + place


@lru_cache(maxsize=64)
def places(n: int, levels: int) -> list[np.ndarray]:
    """The places of all nodes, level by level."""
    return [address(level, np.arange(size), n, levels) for level, size in enumerate(level_sizes(n, levels))]


def grown(leaves: bytes, levels: int) -> bytes:
    """Layout of the subtree over these digests: every 16 consecutive nodes become the digest of their hex text."""
    n = len(leaves) // DIGEST
    nodes = np.empty((sum(level_sizes(n, levels)), DIGEST), np.uint8)
    for at in places(n, levels):
        nodes[at] = np.frombuffer(leaves, np.uint8).reshape(-1, DIGEST)
        text = leaves.hex().encode()
        leaves = b"".join(sha256(text[i:i + RUN]).digest() for i in range(0, len(text), RUN))
    return nodes.tobytes()


def siblings(layout: bytes, n: int, levels: int, leaf: int) -> list[str]:
    """For one leaf, level by level, the hex text of the run's nodes left and right of its way up.
    Reads the few nodes of its runs by their addresses."""
    nodes, out = np.frombuffer(layout, np.uint8).reshape(-1, DIGEST), []
    for level, size in enumerate(level_sizes(n, levels)[:-1]):
        start = leaf - leaf % FAN_OUT
        run = np.arange(start, min(start + FAN_OUT, size))
        text = nodes[address(level, run, n, levels)].tobytes().hex()
        out += [text[:HEX * (leaf - start)], text[HEX * (leaf - start + 1):]]
        leaf //= FAN_OUT
    return out


def all_siblings(layout: bytes, n: int, levels: int) -> Iterator[list[str]]:
    """`siblings` of every leaf."""
    nodes = np.frombuffer(layout, np.uint8).reshape(-1, DIGEST)
    texts = [nodes[at].tobytes().hex() for at in places(n, levels)[:-1]]
    for leaf in range(n):
        out, at = [], leaf
        for text in texts:
            start = at - at % FAN_OUT
            out += [text[HEX * start:HEX * at], text[HEX * (at + 1):HEX * start + RUN]]
            at //= FAN_OUT
        yield out


def folded(digest: str, path: list[str]) -> str:
    """The root that a digest and its siblings give."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        digest = sha256(f"{left}{digest}{right}".encode()).hexdigest()
    return digest


# Many subtrees.

def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """(key, rows) for each run of equal keys in batches that are sorted by them."""
    last, parts = None, []
    for batch in batches:
        values = list(zip(*(batch[k].to_pylist() for k in keys), strict=True))
        start = 0
        for key, same in groupby(values):
            size = sum(1 for _ in same)
            if parts and key != last:
                yield last, pa.Table.from_batches(parts)
                parts = []
            last = key
            parts.append(batch.slice(start, size))
            start += size
    if parts:
        yield last, pa.Table.from_batches(parts)


def numbered(df: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """`df` with `pos`, each row's place in its tree from 0, and `n`, the rows of the tree.

    Rows are sorted over all tasks by tree and order (equal ones as they come),
    written, and counted by tree and task; a tree's rows in a task start after those in earlier
    tasks. So a tree of any size is spread out, and what is added up is a row a tree and task.
    """
    keys = [tree, *order, "tie"]
    df = df.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = written(df.drop("tie").withColumn("row", row_id())).withColumn("part", F.shiftright("row", 33))
    counts = rows.groupBy(tree, "part").agg(F.count("*").alias("size"), F.min("row").alias("first"))
    whole = Window.partitionBy(tree)
    before = F.sum("size").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        tree, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("size").over(whole).alias("n"))
    return rows.join(counts, [tree, "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop("row", "part", "shift")


def subtrees(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Stored subtrees of at most `levels` levels, in rounds from the leaves up.

    A layout begins with its root. nodes: tree, pos, n, digest, and maybe id and claim, which are kept beside
    the leaves. A round's rows: tree, block, n_tree (nodes of the tree in this
    round), n, levels, layout, root, ids, claims. Where a tree has several
    subtrees in a round, all have full height and their roots are the nodes of
    the next round; else its root is the tree's.
    """
    capacity = FAN_OUT ** (levels - 1)
    if "id" not in nodes.columns:
        nodes = nodes.withColumns({"id": F.lit(None).cast("string"), "claim": F.lit(None).cast("binary")})
    schema = T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n_tree", T.LongType()),
        T.StructField("n", T.LongType()), T.StructField("levels", T.LongType()), T.StructField("layout", T.BinaryType()),
        T.StructField("root", T.BinaryType()), T.StructField("ids", T.ArrayType(nodes.schema["id"].dataType)),
        T.StructField("claims", T.ArrayType(T.BinaryType())),
    ])

    def build(batches):
        for (tree, block, n_tree), rows in runs(batches, ["tree", "block", "n"]):
            height = levels if n_tree > capacity else levels_over(n_tree)
            layout = grown(b"".join(rows["digest"].to_pylist()), height)
            kept = [rows[name].combine_chunks() for name in ("id", "claim")]
            kept = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), k) for k in kept]
            head = [[tree], [block], [n_tree], [len(rows)], [height], [layout], [layout[:DIGEST]]]
            types = (pa.string(), *[pa.int64()] * 4, pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([*map(pa.array, head, types), *kept], names=schema.names)

    most, rounds = nodes.agg(F.max("n")).first()[0] or 0, []
    while True:
        blocked = nodes.select("tree", F.expr(f"pos div {capacity}").alias("block"), "pos", "n", "digest", "id", "claim")
        blocked = blocked.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
        rounds.append(written(on_workers(blocked).mapInArrow(build, schema)))
        if most <= capacity:
            return rounds
        most = -(-most // capacity)
        nodes = rounds[-1].filter(F.col("n_tree") > capacity).select(
            "tree", F.col("block").alias("pos"), F.expr(f"(n_tree + {capacity - 1}) div {capacity}").alias("n"),
            F.col("root").alias("digest"), F.element_at("ids", 1).alias("id"), F.lit(None).cast("binary").alias("claim"))


def tree_roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """(tree, root) of every tree."""
    tops = [r.filter(F.col("n_tree") <= FAN_OUT ** (levels - 1)).select("tree", "root") for r in rounds]
    out = tops[0]
    for more in tops[1:]:
        out = out.unionByName(more)
    return out


def _served(blocks: DataFrame, paths: DataFrame, capacity: int) -> DataFrame:
    """(tree, block, path, subroot, top, id) for the nodes of these subtrees, each of which is a
    subtree of the round below: its siblings here and further up, to the root."""
    schema = T.StructType([
        T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("path", T.ArrayType(T.StringType())),
        T.StructField("subroot", T.BinaryType()), T.StructField("top", T.BinaryType()), T.StructField("id", blocks.schema["ids"].dataType.elementType),
    ])
    at_once = 512

    def serve(batches):
        types = _arrow(schema)
        for batch in batches:
            for b in batch.to_pylist():
                rows = []
                for at, (own, id_) in enumerate(zip(all_siblings(b["layout"], b["n"], b["levels"]), b["ids"], strict=True)):
                    rows.append({"tree": b["tree"], "block": b["block"] * capacity + at, "path": own + b["path"], "subroot": b["subroot"], "top": b["top"], "id": id_})
                    if len(rows) == at_once or at + 1 == b["n"]:
                        yield pa.RecordBatch.from_pylist(rows, schema=types)
                        rows = []

    joined = blocks.select("tree", "block", "n", "levels", "layout", "ids").join(paths, ["tree", "block"])
    return on_workers(joined).mapInArrow(serve, schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def node_paths(rounds: list[DataFrame], tops: DataFrame, levels: int, down_to: int = 0) -> DataFrame:
    """(tree, block, path, subroot, top, id) for the nodes of round `down_to`, where `tops` has
    (tree, path, subroot, top): the siblings from a tree's root up."""
    capacity = FAN_OUT ** (levels - 1)
    paths = None
    for k in range(len(rounds) - 1, down_to - 1, -1):
        paths = _paths_into(rounds, k, tops, paths, capacity)
        paths = written(_served(rounds[k], paths, capacity))
    return paths


def _paths_into(rounds, k, tops, served, capacity):
    """The way on from the root of every subtree of round k."""
    ends = rounds[k].filter(F.col("n_tree") <= capacity).select("tree", "block").join(tops, "tree")
    return ends if served is None else ends.unionByName(served.drop("id"))


# The manifest of a table.

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """SHA-256 of the fields, each its byte count and value or a mark for null."""
    return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))


def merkle_proofs(
    df: DataFrame, id_col: str = "doc_id", tree_col: str = "source",
    leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    changed: dict[str, Column] | None = None, levels: int = 4,
) -> DataFrame:
    """One row per input row: id_col, leaf, subroot, root, proof_sha256, folded_root, verified.

    Each row is a leaf, a tree is grown over the leaves of each `tree_col`
    value in order of id, and one over the trees' roots in order of that value
    (null first). Trees are stored as subtrees of at most `levels` levels in
    van Emde Boas order; subtree roots are the leaves of the next subtrees, so
    a tree of n leaves takes log(n) / log(16^(levels - 1)) rounds and no task
    holds more than one subtree and a way up.

    `changed` replaces columns (by name) for the rows' claims: `folded_root`
    is the root that a row's claim and the stored siblings give, `verified`
    whether that is the manifest's. Without it the rows are checked as they are.

    Null ids come first and rows with equal ids in order of their leaf digest; repeated rows
    are leaves of their own. Null texts are a field of their own, apart from
    empty ones. An empty table has no rows and no root. Extra columns are left
    out, as long as `leaf_cols` does not name them.
    """
    if levels < 2:
        raise ValueError("a subtree needs two levels at least")
    changed = changed or {}
    values = [column(name) for name in leaf_cols]
    claims = [changed.get(name, column(name)) for name in leaf_cols]
    tree = F.coalesce(F.concat(F.lit("="), column(tree_col).cast("string")), F.lit(""))
    leaves = df.select(
        tree.alias("tree"), column(id_col).alias("id"), leaf_digest(values).alias("digest"), leaf_digest(claims).alias("claim"))
    rounds = subtrees(numbered(leaves, "tree", ["id", "digest"]), levels)

    roots = tree_roots(rounds, levels).select(F.lit("").alias("tree"), F.col("tree").alias("id"), F.col("root").alias("digest"))
    upper = subtrees(numbered(roots.withColumn("claim", F.lit(None).cast("binary")), "tree", ["id"]), levels)
    top = tree_roots(upper, levels).select("tree", F.array().cast("array<string>").alias("path"), F.col("root").alias("subroot"), F.col("root").alias("top"))
    tops = node_paths(upper, top, levels).select(F.col("id").alias("tree"), "path", "top")
    tops = tops.join(tree_roots(rounds, levels).withColumnRenamed("root", "subroot"), "tree").select("tree", "path", "subroot", "top")
    above = node_paths(rounds, tops, levels, 1) if len(rounds) > 1 else None
    paths = _paths_into(rounds, 0, tops, above, FAN_OUT ** (levels - 1))

    schema = T.StructType([T.StructField("id", leaves.schema["id"].dataType), *(
        T.StructField(name, T.StringType()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root"))])

    def prove(batches):
        types = _arrow(schema)
        for batch in batches:
            for i in range(len(batch)):
                b = {name: batch[name][i].as_py() for name in ("n", "levels", "layout", "path", "subroot", "top", "claims")}
                n, path, nodes = b["n"], b["path"], np.frombuffer(b["layout"], np.uint8).reshape(-1, DIGEST)
                text = nodes[places(n, b["levels"])[0]].tobytes().hex()
                upward = "".join(path)
                proofs, roots = [], []
                for own, claim in zip(all_siblings(b["layout"], n, b["levels"]), b["claims"], strict=True):
                    proofs.append(sha256(("".join(own) + upward).encode()).hexdigest())
                    roots.append(folded(claim.hex(), own + path))
                yield pa.RecordBatch.from_arrays([
                    batch["ids"][i].values, pa.array([text[k:k + HEX] for k in range(0, n * HEX, HEX)], pa.string()),
                    pa.array([b["subroot"].hex()] * n, pa.string()), pa.array([b["top"].hex()] * n, pa.string()),
                    pa.array(proofs, pa.string()), pa.array(roots, pa.string()),
                ], schema=types)

    stored = rounds[0].select("tree", "block", "n", "levels", "layout", "ids", "claims").join(paths, ["tree", "block"])
    out = on_workers(stored).mapInArrow(prove, schema)
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.col("root")).alias("verified"))
