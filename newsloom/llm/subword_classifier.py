"""Quality classifier: learned vectors of hashed words and character n-grams,
averaged over a document, with a softmax on top."""

import io
from array import array
from collections import Counter
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.shared import column, held_alone, on_workers

#: Words whose sums a worker keeps at hand; the rest is computed again.
KEPT_WORDS = 1 << 17
#: Bytes up to which a word is short: its sums are kept, and its n-grams hashed one by one.
SHORT = 64
#: Bytes of a longer word that are hashed together.
BLOCK = 1 << 16
_CRC = np.array([crc32(bytes([b])) ^ crc32(b"\0") for b in range(256)], dtype=np.uint32)


def held_out(id_col: str) -> Column:
    return F.crc32(column(id_col).cast("string").cast("binary")) % 3 == 1


def features(word: bytes, buckets: int, sizes=(2, 3, 4)) -> list[int]:
    """Buckets of the word itself and of the n-grams of <word>."""
    found = [crc32(word, 1) % buckets]
    inner = b"<" + word + b">"
    for n in sizes:
        found += [crc32(inner[i:i + n]) % buckets for i in range(len(inner) - n + 1)]
    return found


def long_features(word: bytes, buckets: int, sizes=(2, 3, 4)):
    """The same in arrays, for words of any length."""
    yield np.array([crc32(word, 1) % buckets])
    inner = np.frombuffer(b"<" + word + b">", dtype=np.uint8)
    for n in sizes:
        for at in range(0, len(inner) - n + 1, BLOCK):
            block = inner[at:at + BLOCK + n - 1]
            crc = np.full(len(block) - n + 1, 0xFFFFFFFF, dtype=np.uint32)
            for k in range(n):
                crc = _CRC[(crc ^ block[k:k + len(crc)]) & 0xFF] ^ (crc >> 8)
            yield (crc ^ np.uint32(0xFFFFFFFF)).astype(np.int64) % buckets


class Words:
    """Buckets of the words seen so far, in one array."""

    def __init__(self, buckets: int):
        self.buckets, self.number, self.flat, self.ends = buckets, {}, array("i"), array("q", [0])

    def document(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the different words of a text, and how often each occurs."""
        words = Counter(text.split())
        for word in words:
            if word not in self.number:
                self.number[word] = len(self.number)
                if len(word) <= SHORT:
                    self.flat.extend(features(word, self.buckets))
                else:
                    for ids in long_features(word, self.buckets):
                        self.flat.frombytes(ids.astype(np.int32).tobytes())
                self.ends.append(len(self.flat))
        return np.fromiter((self.number[w] for w in words), np.int32, len(words)), np.fromiter(words.values(), np.int32, len(words))


class Model:
    """Bucket vectors E, output weights W and bias b of two classes."""

    def __init__(self, buckets: int, dim: int, seed: int):
        rng = np.random.default_rng(seed)
        self.E = rng.uniform(-1 / dim, 1 / dim, (buckets, dim))
        self.W, self.b = np.zeros((2, dim)), np.zeros(2)

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], words: Words, y: np.ndarray, epochs: int, rate: float, batch: int, seed: int) -> None:
        """Stochastic gradient descent on the log loss, over documents with words."""
        chosen = [i for i, (w, _) in enumerate(docs) if len(w)]
        if not chosen:
            return
        flat, ends = np.frombuffer(words.flat, np.int32), np.frombuffer(words.ends, np.int64)
        rng, steps, step = np.random.default_rng(seed), max(1, epochs * -(-len(chosen) // batch)), 0
        target = np.eye(2)[y]
        for _ in range(epochs):
            order = rng.permutation(chosen)
            for at in range(0, len(order), batch):
                some = order[at:at + batch]
                spoken = np.concatenate([docs[i][0] for i in some])
                sizes = ends[spoken + 1] - ends[spoken]
                ids = flat[np.repeat(ends[spoken] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
                counts = np.repeat(np.concatenate([docs[i][1] for i in some]), sizes)
                starts = np.concatenate([[0], np.cumsum([len(docs[i][0]) for i in some])])
                bounds = np.concatenate([[0], np.cumsum(sizes)])[starts]
                lengths = np.diff(bounds)
                share = counts / np.repeat(np.add.reduceat(counts, bounds[:-1]), lengths)
                mean = np.add.reduceat(self.E[ids] * share[:, None], bounds[:-1], axis=0)
                z = mean @ self.W.T + self.b
                p = np.exp(z - z.max(axis=1, keepdims=True))
                p /= p.sum(axis=1, keepdims=True)
                error = p - target[some]
                lr = rate * (1 - step / steps)
                back = np.repeat(error @ self.W, lengths, axis=0) * share[:, None]
                self.W -= lr * error.T @ mean / len(some) * batch ** 0.5
                self.b -= lr * error.mean(axis=0)
                for d in range(self.E.shape[1]):
                    self.E[:, d] -= lr * np.bincount(ids, back[:, d], minlength=len(self.E))
                step += 1

    def table(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log odds of class 1, and the bias. An
        average of vectors times weights is an average of these numbers."""
        return (self.E @ (self.W[1] - self.W[0])).astype(np.float32), float(self.b[1] - self.b[0])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        table, bias = self.table()
        np.savez(out, table=table, bias=bias)
        return out.getvalue()


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    sample: int = 4_000, buckets: int = 1 << 17, dim: int = 8, epochs: int = 8, rate: float = 5.0, batch: int = 32, seed: int = 7,
) -> bytes:
    """The fitted table, from at most `sample` labelled documents outside the
    held-out third: those of the smallest hashes of their ids.

    The sample's ids are broadcast (at most `sample` rows); its texts are fitted
    in one task, whose work does not grow with the corpus. Rows without id or
    label teach nothing; of a document's several labels the smallest counts, of
    its several texts the smallest. Without any labelled row all scores are 0.5.
    """
    known = labels.filter(column(label_col).isin(0, 1) & column(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(column(id_col).alias("id")).agg(F.min(column(label_col)).alias("y"))
    chosen = F.broadcast(known.orderBy(F.xxhash64(F.col("id"), F.lit(seed)), "id").limit(sample))
    texts = docs.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    rows = texts.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.min("y").alias("y"))

    def fit(frames):
        ids, found, y, words = [], [], [], Words(buckets)
        for frame in frames:
            ids += list(frame["id"])
            y += list(frame["y"])
            found += [words.document(text) for text in frame["text"]]
        order = np.argsort(np.array(ids)) if ids else []
        model = Model(buckets, dim, seed)
        model.fit([found[i] for i in order], words, np.array(y, dtype=np.int64)[order], epochs, rate, batch, seed)
        yield pd.DataFrame({"model": [model.to_bytes()]})

    fitted = on_workers(rows).coalesce(1).mapInPandas(fit, "model binary").first()
    return bytes(fitted["model"]) if fitted else Model(buckets, dim, seed).to_bytes()


def score_texts(texts, model_id: str, table: np.ndarray, bias: float) -> list[float]:
    """Probability of class 1 for each text. Texts without words get the bias alone."""
    sums, scores = held_alone(("word sums", model_id), dict), []
    if len(sums) > KEPT_WORDS:
        sums.clear()
    for text in texts:
        total, n = 0.0, 0
        for word in text.split():
            known = sums.get(word)
            if known is None:
                if len(word) <= SHORT:
                    ids = features(word, len(table))
                    known = (float(table[ids].sum()), len(ids))
                    if len(sums) <= 2 * KEPT_WORDS:
                        sums[word] = known
                else:
                    parts = [(float(table[ids].sum()), len(ids)) for ids in long_features(word, len(table))]
                    known = tuple(map(sum, zip(*parts, strict=True)))
            total += known[0]
            n += known[1]
        z = bias + (total / n if n else 0.0)
        scores.append(1 / (1 + np.exp(-z)))
    return scores


def with_score(df: DataFrame, model: bytes, text_col: str = "text", to: str = "score") -> DataFrame:
    """`df` with the score of each whole text; null counts as empty. The model,
    of a size fixed by its buckets, is broadcast."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        loaded = np.load(io.BytesIO(shared.value))
        name = f"{crc32(shared.value)}"
        return pa.array(score_texts((t.as_py() or b"" for t in texts), name, loaded["table"], float(loaded["bias"])), pa.float64())

    return on_workers(df).withColumn(to, score(column(text_col).cast("binary")))


def quality_scores(df: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id_col, held_out, score, predicted (score >= 0.5).

    Rows repeated or with a null id keep a row each; extra columns are left out.
    """
    slim = df.select(column(id_col).alias("id"), column(text_col).alias("text"))
    out = with_score(slim, model)
    return out.select(
        F.col("id").alias(id_col), F.coalesce(held_out("id"), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(df: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """The rows of `df` whose text is predicted to be of class 1."""
    rows = df.select(F.struct("*").alias("row"), column(text_col).alias("text"))
    return with_score(rows, model).filter("score >= 0.5").select("row.*")
