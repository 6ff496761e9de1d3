"""Licences in texts: phrases, and templates found by votes of word windows for diagonals."""

from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from newsloom.llm.license_texts import PHRASES, TEMPLATES
from newsloom.llm.shared import column, on_workers, row_id, written

#: Bytes that part words become blanks, A-Z become a-z.
_TABLE = bytes(
    b if 48 <= b < 58 or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: Odd multiplier of the rolling hash, modulo 2^64.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass(frozen=True)
class Rules:
    """Templates ((label, text) pairs), phrases ((text, label) pairs) and the words in a window.

    Words are numbered; 0 is any word that no template and no phrase has.
    """

    templates: tuple[tuple[str, str], ...]
    phrases: tuple[tuple[str, str], ...]
    window: int

    @cached_property
    def numbers(self) -> dict[bytes, int]:
        words = {w for text in [*(t for _, t in self.templates), *(p for p, _ in self.phrases)] for w in words_of(text.encode())}
        return {w: i + 1 for i, w in enumerate(sorted(words))}

    def ids(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.numbers.get, words, repeat(0)), np.uint16, len(words))

    @cached_property
    def template_ids(self) -> list[np.ndarray]:
        return [self.ids(words_of(text.encode())) for _, text in self.templates]

    @cached_property
    def phrase_ids(self) -> list[tuple[np.ndarray, str]]:
        return [(self.ids(words_of(text.encode())), label) for text, label in self.phrases]

    def windows(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and rolling hashes of the windows of known words; a window with
        any other word is in no template."""
        n = len(ids) - self.window + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        known = np.ones(n, bool)
        for i in range(self.window):
            known &= ids[i:i + n] > 0
        at = np.flatnonzero(known)
        hashed = np.zeros(len(at), np.uint64)
        for i in range(self.window):
            hashed = hashed * _FACTOR + ids[at + i]
        return at, hashed.view(np.int64)

    def places(self, ids: np.ndarray, phrase: np.ndarray) -> np.ndarray:
        n = len(ids) - len(phrase) + 1
        found = np.ones(max(n, 0), bool)
        for i, word in enumerate(phrase):
            found &= ids[i:i + len(found)] == word
        return np.flatnonzero(found)

    @cached_property
    def masks(self) -> list[dict[int, int]]:
        """For each template the places of its words, as bits."""
        out = []
        for ids in self.template_ids:
            places = {}
            for i, word in enumerate(ids.tolist()):
                places[word] = places.get(word, 0) | 1 << i
            out.append(places)
        return out

    def shared_words(self, template: int, span: list[int]) -> int:
        """Words of the template that a span of a text has in the same order, at
        most: their longest common subsequence, a bit for each template word."""
        size, masks = len(self.template_ids[template]), self.masks[template]
        full = (1 << size) - 1
        left = full
        for word in span:
            hit = left & masks.get(word, 0)
            left = ((left + hit) | (left - hit)) & full
        return size - left.bit_count()


def _scanned(df: DataFrame, id_col: str, text_col: str, rules: Rules) -> DataFrame:
    """(row, id, n_words, n_base, first_word, last_word, base, words, at, hash): counts of each
    text, and for texts with windows of known words their word numbers, places and hashes."""
    source = df.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).cast("binary").alias("text"))
    number = T.LongType()
    schema = T.StructType([
        T.StructField("id", source.schema["id"].dataType), *(T.StructField(name, number) for name in ("n_words", "n_base", "first_word", "last_word")),
        T.StructField("base", T.ArrayType(T.StringType())), T.StructField("words", T.BinaryType()),
        T.StructField("at", T.ArrayType(number)), T.StructField("hash", T.ArrayType(number)),
    ])

    def scan(batches):
        for batch in batches:
            ids = [rules.ids(words_of(text.as_py())) for text in batch["text"]]
            rows = []
            for words in ids:
                found = [(rules.places(words, phrase), label) for phrase, label in rules.phrase_ids] if words.any() else []
                hits = [at for at, _ in found if len(at)]
                at, hashed = rules.windows(words)
                rows.append((
                    len(words), sum(map(len, hits)), min((int(h[0]) for h in hits), default=None),
                    max((int(h[-1]) for h in hits), default=None), sorted({label for at_, label in found if len(at_)}),
                    words.tobytes() if len(at) else None, at, hashed,
                ))
            columns = list(zip(*rows, strict=True)) or [[]] * 8
            types = [pa.int64()] * 4 + [pa.list_(pa.string()), pa.binary()] + [pa.list_(pa.int64())] * 2
            yield pa.RecordBatch.from_arrays([batch["id"], *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=schema.names)

    return on_workers(source).mapInArrow(scan, schema).withColumn("row", row_id())


def diagonal_spans(windows: DataFrame, templates: DataFrame, drift: int) -> DataFrame:
    """(row, template, low, high): stretches of places where a text may hold a template.

    windows: row, at, hash; templates: template, place, hash. Each window votes
    for the diagonal at - place; neighbouring diagonals of a template (at most `drift` words
    apart, as words put in or left out shift it) make one stretch, from the first to the last
    place that a vote gives the template's first word.
    """
    votes = windows.join(F.broadcast(templates), "hash").withColumn("diagonal", F.col("at") - F.col("place"))
    diagonals = votes.groupBy("row", "template", "diagonal").agg(F.count("*").alias("votes"))
    along = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > drift, F.lit(True))
    stretches = diagonals.withColumn("new", apart.cast("int")).withColumn("stretch", F.sum("new").over(along))
    return stretches.groupBy("row", "template", "stretch").agg(
        F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.sum("votes").alias("votes")).drop("stretch")


def verified_spans(spans: DataFrame, scanned: DataFrame, rules: Rules, drift: int) -> DataFrame:
    """`spans` with `share`: how much of the template the text's words around the stretch hold, in order,
    at most, in spans little longer than the template."""
    joined = spans.join(scanned.filter("words is not null").select("row", "words"), "row")

    @F.arrow_udf(T.DoubleType())
    def share(template: pa.Array, low: pa.Array, high: pa.Array, words: pa.Array) -> pa.Array:
        out = []
        for t, first, last, text in zip(template.to_pylist(), low.to_pylist(), high.to_pylist(), words, strict=True):
            size, all_words = len(rules.template_ids[t]), np.frombuffer(text.as_buffer(), np.uint16)
            spans = (all_words[max(0, at - drift):max(0, at + size + 2 * drift)] for at in range(first, last + 1, drift + 1))
            out.append(max(rules.shared_words(t, span.tolist()) for span in spans) / size)
        return pa.array(out, pa.float64())

    return on_workers(joined).withColumn("share", share("template", "low", "high", "words")).drop("words")


def license_scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, list[str]] | None = None,
    phrases: dict[str, str] | None = None, window: int = 4, least_share: float = 0.9, drift: int = 8,
) -> DataFrame:
    """One row per input row: id_col, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans.

    n_base counts the places of all phrases ({phrase: label}), first_word and
    last_word are the least and greatest of them. A template ({label: texts}) is found where the
    text has `least_share` of its words in order around a diagonal that windows of
    `window` words vote for (see `diagonal_spans`). labels are those of both;
    score is the greatest share of a found template, 0.5 with phrases alone, else 0. spans has
    (label, low, high, share) of the templates found, low and high being
    where the text's copy may begin.

    Words are runs of a-z, 0-9 and characters beyond ASCII; A-Z count as a-z.
    Texts of any length are searched whole. Null and blank texts have no words
    and no labels; null ids and repeated rows keep a row each; an empty table has no rows. Extra
    columns are left out. Templates and phrases together may have 65,535 different words;
    templates are a setting, so the table sent to every task does not grow with the corpus.
    """
    templates, phrases = TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases
    rules = Rules(tuple((label, text) for label, texts in templates.items() for text in texts), tuple(phrases.items()), window)
    spark = df.sparkSession
    seeds = []
    for template, ids in enumerate(rules.template_ids):
        if len(ids) < window:
            raise ValueError(f"a template needs {window} words at least: {rules.templates[template]}")
        seeds += [(template, int(at), int(hashed)) for at, hashed in zip(*rules.windows(ids), strict=True)]
    if len(rules.numbers) > 65535 or len(seeds) > 1_000_000:
        raise ValueError("too many words in templates and phrases")
    places = spark.createDataFrame(seeds, "template int, place bigint, hash bigint")
    labels = spark.createDataFrame([(i, label) for i, (label, _) in enumerate(rules.templates)], "template int, label string")

    scanned = written(_scanned(df, id_col, text_col, rules))
    windows = scanned.filter("words is not null").select("row", F.inline(F.arrays_zip("at", "hash")))
    spans = verified_spans(diagonal_spans(windows, places, drift), scanned, rules, drift)
    found = spans.filter(F.col("share") >= least_share).join(F.broadcast(labels), "template")
    found = found.groupBy("row").agg(
        F.array_sort(F.collect_list(F.struct("label", "low", "high", "share"))).alias("spans"), F.max("share").alias("share"))
    out = scanned.drop("words", "at", "hash").join(found, "row", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<label:string,low:bigint,high:bigint,share:double>>"))
    labels = F.array_sort(F.array_distinct(F.concat("base", F.transform(spans, lambda s: s.label))))
    return out.select(
        F.col("id").alias(id_col), "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce("share", F.when(F.col("n_base") > 0, 0.5).otherwise(0.0)).alias("score"), spans.alias("spans"))
