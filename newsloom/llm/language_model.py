"""Language-model scores of whole documents, learned from the rest of the corpus."""

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.recurrent import OTHER, Network, Trainer, log_likelihoods
from newsloom.llm.shared import column, on_workers, row_id, written

#: Different words that a task counts before it hands them on.
COUNTED_WORDS = 1 << 19
#: Words that a task scores at a time.
SCORED_WORDS = 1 << 21
#: Floats of a model that are averaged together.
BLOCK = 1 << 14
_lists: dict = {}


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(column(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) over all rows of a frame with `data`; the empty word counts the ends."""
    def count(batches):
        found = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], names=["word", "c"])
            found.clear()
            return batch

        for batch in batches:
            for text in batch["data"]:
                found.update(text.as_py().lower().split())
                found[b""] += 1
                if len(found) > COUNTED_WORDS:
                    yield rows()
        yield rows()

    return on_workers(texts).select("data").mapInArrow(count, "word binary, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


def frequent_words(counts: DataFrame, most: int) -> tuple[int, list]:
    """(least count, [(word, count)] by falling count): the words of at least that
    count, the least for which they are no more than `most`. Words of one count
    are listed together or not at all, and the end is not among them."""
    words = counts.filter(F.col("word") != F.lit(b""))
    least, listed = None, 0
    for c, n in sorted(words.groupBy("c").agg(F.count("*")).collect(), reverse=True):  # as many rows as there are different counts
        if listed + n > most:
            break
        least, listed = c, listed + n
    if least is None:
        return 1 << 62, []
    top = words.filter(F.col("c") >= least).collect()  # at most `most` rows
    return least, sorted(((bytes(w), c) for w, c in top), key=lambda x: (-x[1], x[0]))


def _word_ids(name: str, words: list[bytes]) -> dict:
    if _lists.get("name") != name:
        _lists.update(name=name, ids={w: i for i, w in enumerate(words)})
    return _lists["ids"]


def _flat(net: Network) -> np.ndarray:
    return np.concatenate([a.ravel() for a in net.arrays()])


def _filled(net: Network, flat: np.ndarray) -> None:
    at = 0
    for array in net.arrays():
        array[...] = flat[at:at + array.size].reshape(array.shape)
        at += array.size


def _averaged(parts: DataFrame) -> DataFrame:
    """Blocks of models averaged by weight, in two steps so that no task gets the blocks of all trainers."""
    def mean(frame: pd.DataFrame) -> pd.DataFrame:
        weights = frame["weight"].to_numpy(np.float64)
        values = np.stack([np.frombuffer(v, np.float32) for v in frame["part"]])
        part = (values * (weights / weights.sum())[:, None]).sum(axis=0).astype(np.float32)
        return pd.DataFrame({"block": [frame["block"].iloc[0]], "trainer": [0], "weight": [int(weights.sum())], "part": [part.tobytes()]})

    schema = "block int, trainer int, weight bigint, part binary"
    groups = F.floor(F.sqrt(F.col("trainer"))).alias("group")
    some = parts.withColumn("group", groups).groupBy("block", "group").applyInPandas(lambda f: mean(f.drop(columns="group")), schema)
    return some.groupBy("block").applyInPandas(mean, schema)


def train(source: DataFrame, net: Network, vocabulary: int, shared, n_words: int, rounds: int, trainer_words: int) -> Network:
    """Data-parallel training: in each round every trainer goes on from the mean
    of the last, over its part of the input. Every document takes part in one of
    the rounds, so trainers and what they learn from grow with the corpus; none
    of it is moved. A model, whose size is fixed, is all that a trainer returns."""
    for turn in range(rounds):
        start = source.sparkSession.sparkContext.broadcast(net.to_bytes())
        part = source.filter(F.pmod(F.xxhash64("name", F.lit(97)), F.lit(rounds)) == turn).select("data")
        trainers = max(1, math.ceil(n_words / rounds / trainer_words))

        def fit(batches, start=start):
            own = {w: i for i, w in enumerate(shared.value[0][:vocabulary - 2], 2)}
            net, texts = Network.from_bytes(start.value), []
            for batch in batches:
                for text in batch["data"]:
                    spoken = text.as_py().lower().split()
                    texts.append(np.fromiter(map(own.get, spoken, repeat(OTHER)), np.int32, len(spoken)))
            if not texts:
                return
            trainer = Trainer(net)
            trainer.fit(texts)
            flat, weight, me = _flat(net), sum(len(t) + 1 for t in texts), TaskContext.get().partitionId()
            blocks = range(0, len(flat), BLOCK)
            yield pa.RecordBatch.from_arrays([
                pa.array(range(len(blocks)), pa.int32()), pa.array([me] * len(blocks), pa.int32()), pa.array([weight] * len(blocks), pa.int64()),
                pa.array([flat[b:b + BLOCK].tobytes() for b in blocks], pa.binary())], names=["block", "trainer", "weight", "part"])

        models = on_workers(part).coalesce(trainers).mapInArrow(fit, "block int, trainer int, weight bigint, part binary")
        blocks = {b: bytes(p) for b, p in _averaged(models).select("block", "part").collect()}  # one model
        if blocks:
            _filled(net, np.concatenate([np.frombuffer(blocks[b], np.float32) for b in sorted(blocks)]))
        start.unpersist()
    return net


def language_scores(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: int = 8_192, listed: int = 1 << 18, hidden: int = 24,
    rounds: int = 2, trainer_words: int = 1 << 19,
) -> DataFrame:
    """One row per input row: id_col, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probability of the whole text with its end).

    Learns from the rows that are not `held_out`. Counts and
    gradients cover all their words (`train`).
    The `vocabulary` most frequent are the network's own; any other word is
    predicted as one of the rest, times its share among the rest by count plus
    one, so the probabilities of all texts add up to one. A table of at most
    `listed` words is sent to every task; the counts of rarer words are joined.

    Null text counts as empty: its end is scored. Rows with a null id are not
    held out. Rows repeated are learned from and scored each. Extra columns are
    left out. Without anything to learn from, all counts are 0.
    """
    spark = df.sparkSession
    source = df.select(
        column(id_col).alias("id"), column(id_col).cast("string").alias("name"), held_out(id_col).alias("held_out"),
        F.coalesce(column(text_col), F.lit("")).cast("binary").alias("data"))
    counts = written(word_counts(source.filter("not held_out")))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.coalesce(F.sum(F.when(F.col("word") == F.lit(b""), F.col("c"))), F.lit(0))).first()
    n_words, n_types, n_texts = map(int, total)
    least, top = frequent_words(counts, listed)
    words, found = [w for w, _ in top], np.array([c for _, c in top], dtype=np.float64)
    vocabulary = min(vocabulary, len(words) + 2)
    own = found[:vocabulary - 2]
    rest_words, rest_types = n_words - n_texts - own.sum(), n_types - (n_texts > 0) - len(own)
    net = Network.new(np.concatenate([[rest_words, n_texts], own]), hidden)
    name = f"{spark.sparkContext.applicationId}-{xxhash.xxh64_hexdigest(b' '.join(words))}"
    shared = spark.sparkContext.broadcast((words, np.log10(found + 1), math.log10(n_texts + 1)))
    net = train(source.filter("not held_out"), net, vocabulary, shared, n_words, rounds, trainer_words)
    model = spark.sparkContext.broadcast(net.to_bytes())
    rest_log = math.log10(rest_words + rest_types + 1)
    id_type = source.schema["id"].dataType
    tail = T.ArrayType(T.StructType([T.StructField("key", T.LongType()), T.StructField("n", T.LongType())]))
    schema = T.StructType([T.StructField("id", id_type), T.StructField("held_out", T.BooleanType())] + [
        T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")] + [
        T.StructField(c, T.DoubleType()) for c in ("base", "score")] + [T.StructField("tail", tail)])

    def score(batches):
        listed_words, logs, end_log = shared.value
        ids_of, network = _word_ids(name, listed_words), Network.from_bytes(model.value)
        # By a word's place in the list, the last (-1) for words that are not listed: its number in the network, its logarithm, and what it adds to the network's.
        places = np.arange(len(logs) + 1)
        other = places >= vocabulary - 2
        other[-1] = True
        numbers, logs = np.where(other, OTHER, places + 2).astype(np.int32), np.append(logs, 0.0)
        added = np.where(other, logs - rest_log, 0.0)
        ids, held, kept, known, base, extra, keys, times, tails, size = [], [], [], [], [], [], [], [], [0], 0

        def rows(id_type):
            scores = log_likelihoods(network, kept) / math.log(10) + np.array(extra)
            tail = pa.StructArray.from_arrays([pa.array(keys, pa.int64()), pa.array(times, pa.int64())], names=["key", "n"])
            batch = pa.RecordBatch.from_arrays([
                pa.array(ids, id_type), pa.array(held, pa.bool_()), pa.array([len(k) + 1 for k in kept], pa.int64()), pa.array(known, pa.int64()),
                pa.array(base, pa.float64()), pa.array(scores, pa.float64()), pa.ListArray.from_arrays(pa.array(tails, pa.int32()), tail)], names=schema.names)
            for part in (ids, held, kept, known, base, extra, keys, times):
                part.clear()
            tails[:] = [0]
            return batch

        for batch in batches:
            for key, out, text in zip(batch["id"], batch["held_out"], batch["data"], strict=True):
                spoken = text.as_py().lower().split()
                found = np.fromiter(map(ids_of.get, spoken, repeat(-1)), np.int32, len(spoken))
                rare = Counter(map(spoken.__getitem__, np.flatnonzero(found < 0).tolist()))
                ids.append(key.as_py())
                held.append(out.as_py())
                kept.append(numbers.take(found))
                known.append(int(np.count_nonzero(found >= 0)) + (n_texts > 0))
                base.append(float(logs.take(found).sum()) + end_log)
                extra.append(float(added.take(found).sum()))
                keys.extend(xxhash.xxh64_intdigest(w) - (1 << 63) for w in rare)
                times.extend(rare.values())
                tails.append(len(keys))
                size += len(spoken) + 1
                if size >= SCORED_WORDS:
                    yield rows(batch["id"].type)
                    size = 0
        if ids:
            yield rows(batch["id"].type)

    scored = on_workers(source).select("id", "held_out", "data").mapInArrow(score, schema)
    scored = written(scored.withColumn("row", row_id()))
    # Words below the list: their counts by hash, joined with the texts that have them.
    rare = counts.filter((F.col("c") < least) & (F.col("word") != F.lit(b"")))
    hashed = F.arrow_udf(lambda words: pa.array((xxhash.xxh64_intdigest(w.as_py()) - (1 << 63) for w in words), pa.int64()), T.LongType())
    rare = rare.select(hashed("word").alias("key"), F.col("c").alias("c"))
    each = scored.select("row", F.explode("tail").alias("word")).select("row", "word.key", "word.n")
    added = each.join(rare, "key").groupBy("row").agg(
        F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("log"))
    out = scored.drop("tail").join(added, "row", "left")
    log = F.coalesce("log", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(n_words).cast("bigint").alias("train_tokens"),
        (F.col("base") + log - F.col("n_tokens") * math.log10(n_words + n_types + 1)).alias("base_score"),
        (F.col("score") + log).alias("score"))
