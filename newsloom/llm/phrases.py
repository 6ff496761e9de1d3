"""Phrase counts and collocations: a bidirectional FM-index over word ids for each shard of texts."""

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from newsloom.llm.shared import column, on_workers, written

#: What ends a piece, what stands between words, letters in lower case.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_MARK = b"\n"
_TABLE = bytes.maketrans(bytes(range(65, 91)) + ENDS + BLANKS, bytes(range(97, 123)) + _MARK * len(ENDS) + b" " * len(BLANKS))


# One shard.

class HalfIndex:
    """Burrows-Wheeler transform of ids in which 0 parts the pieces, for patterns of up to `depth` ids.

    Suffixes are ordered by their first `depth` ids, equal ones by place. That
    is enough for steps to patterns of that length: a step only asks how many
    of an id stand before a boundary between patterns.
    """

    def __init__(self, ids: np.ndarray, depth: int, symbols: int):
        n, bits = len(ids), max(1, int(symbols).bit_length())
        padded = np.concatenate([ids, np.zeros(depth, np.int64)])
        # As many ids to a sort key as fit, the later ones sorted first.
        order, each, end = None, 63 // bits, depth
        while end > 0:
            start = max(0, end - each)
            key = np.zeros(n, np.int64)
            for i in range(start, end):
                key = (key << bits) | padded[i:i + n]
            order = np.argsort(key) if order is None else order[np.argsort(key[order], kind="stable")]
            end = start
        self.n = n
        self.last = ids[order - 1]
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=symbols + 1))])
        # The rows of each id, one id after the other.
        by_id = np.argsort(self.last, kind="stable")
        self.occurrences = self.last[by_id] * n + by_id
        self.words_before = np.concatenate([[0], np.cumsum(self.last != 0)])

    def rank(self, ids: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """How often each id stands in the transform before its row."""
        return np.searchsorted(self.occurrences, ids * self.n + rows) - self.starts[ids]

    def neighbours(self, low: np.ndarray, size: np.ndarray) -> np.ndarray:
        """In how many rows of each interval a word stands in the transform."""
        return self.words_before[low + size] - self.words_before[low]

    def extended(self, low: np.ndarray, size: np.ndarray, other: np.ndarray):
        """All extensions of the intervals' patterns by the id in the transform.

        Returns, for each: the pattern's number, the id, its interval here, the
        other half's interval, and the count. `other` has the patterns'
        intervals in the other half, where those of the extensions lie one
        after the other by id.
        """
        owner = np.repeat(np.arange(len(low)), size)
        begin = np.cumsum(size) - size
        symbols = self.last[np.arange(len(owner)) - np.repeat(begin - low, size)]
        width = int(self.last.max(initial=0)) + 1
        key = np.sort(owner * width + symbols)
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        counts = np.diff(np.concatenate([first, [len(key)]]))
        owner, symbols = np.divmod(key[first], width)
        smaller = first - begin[owner]
        word = symbols != 0
        owner, symbols, counts, smaller = owner[word], symbols[word], counts[word], smaller[word]
        return owner, symbols, self.starts[symbols] + self.rank(symbols, low[owner]), other[owner] + smaller, counts


class PhraseIndex:
    """Both halves of the index over ids (0 parts the pieces), for phrases of up to `depth` ids."""

    def __init__(self, ids: np.ndarray, depth: int):
        ids = np.concatenate([[0], ids, [0]]).astype(np.int64)
        self.depth, self.symbols = depth, int(ids.max())
        #: The forward half steps to the left, the backward half to the right.
        self.forward, self.backward = HalfIndex(ids, depth, self.symbols), HalfIndex(ids[::-1].copy(), depth, self.symbols)

    def phrases(self, allowed=None):
        """For each length: the phrases as rows of ids, their counts, and how many of
        their occurrences have a word before and after them in the piece.

        One word is an interval in both halves; longer phrases come from shorter
        ones by a step to the right and to the left in turn. `allowed` tells of
        rows whether phrases that hold them are wanted; the others are not
        extended, and no phrase is given whose first or last part is one of them.
        """
        words = np.arange(1, self.symbols + 1)
        low = high = self.forward.starts[1:self.symbols + 1]
        size = self.forward.starts[2:self.symbols + 2] - low
        rows = words[:, None]
        for length in range(1, self.depth + 1):
            yield rows, size, self.forward.neighbours(low, size), self.backward.neighbours(high, size)
            if length == self.depth:
                return
            if allowed is not None:
                wanted = allowed(rows)
                rows, low, high, size = rows[wanted], low[wanted], high[wanted], size[wanted]
            if length % 2:
                owner, added, high, low, size = self.backward.extended(high, size, low)
                rows = np.concatenate([rows[owner], added[:, None]], axis=1)
            else:
                owner, added, low, high, size = self.forward.extended(low, size, high)
                rows = np.concatenate([added[:, None], rows[owner]], axis=1)
            if allowed is not None:
                wanted = allowed(rows[:, :-1]) & allowed(rows[:, 1:])
                rows, low, high, size = rows[wanted], low[wanted], high[wanted], size[wanted]


class Shard:
    """Pieces of texts as word ids; a word of another language is another id."""

    def __init__(self):
        self._next = count(1)
        self.languages, self.parts, self.size = {}, [], 0

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.languages:
            self.languages[lang] = defaultdict(self._next.__next__, {_MARK: 0, b"": -1})
        known = self.languages[lang]
        words = text.translate(_TABLE).replace(_MARK, b" \n ").split(b" ")
        ids = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        ids = ids[ids >= 0]
        self.parts += [ids, np.zeros(1, np.int64)]
        self.size += len(ids) + 1

    def rows(self, lengths: range, neighbours: bool, filters: dict[int, bytes]):
        """(key, n) of the phrases of some lengths as Arrow batches, and with `neighbours` preceded and followed; a
        key is language, line break, phrase. `filters` (see `phrase_filter`) leave out what is not wanted, by length."""
        n_words = sum(len(known) - 2 for known in self.languages.values())
        words, langs = [None] * (n_words + 1), np.zeros(n_words + 1, np.int64)
        names = [lang.encode() + _MARK for lang in self.languages]
        for k, known in enumerate(self.languages.values()):
            for word, i in known.items():
                if i > 0:
                    words[i], langs[i] = word, k
        ids = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        totals = np.bincount(langs[ids[ids > 0]], minlength=len(names))
        # A phrase's first word brings the language along.
        first_words = [None] + [names[k] + word for k, word in zip(langs[1:].tolist(), words[1:], strict=True)]
        first = pa.array(first_words, pa.binary()).cast(pa.string())
        words, names = pa.array(words, pa.binary()).cast(pa.string()), pa.array(names, pa.binary()).cast(pa.string())
        if 1 in lengths:
            yield _rows(names, totals, *[totals * 0] * 2 * neighbours)
        hashes = np.zeros(n_words + 1, np.uint64)
        if filters:
            hashes[1:] = [xxhash.xxh64_intdigest(word) for word in first_words[1:]]
        bits = {length: np.frombuffer(data, np.uint8) for length, data in filters.items()}
        allowed = lambda rows: _found(_places(hashes[rows], 8 * len(bits[rows.shape[1]])), bits[rows.shape[1]]) if rows.shape[1] in bits else np.ones(len(rows), bool)
        at_once = 1 << 17
        for rows, size, preceded, followed in PhraseIndex(ids, lengths[-1]).phrases(allowed if filters else None) if n_words else ():
            if rows.shape[1] not in lengths:
                continue
            for start in range(0, len(rows), at_once):
                part = slice(start, start + at_once)
                texts = [first.take(pa.array(rows[part, 0])), *(words.take(pa.array(column_)) for column_ in rows[part, 1:].T)]
                key = pc.binary_join_element_wise(*texts, " ") if len(texts) > 1 else texts[0]
                yield _rows(key, size[part], *[preceded[part], followed[part]] * neighbours)


def _rows(key, *numbers):
    return pa.RecordBatch.from_arrays([key, *(pa.array(x, pa.int64()) for x in numbers)], names=["key", "n", "preceded", "followed"][:1 + len(numbers)])


# Which phrases may be wanted, in as many bits at every size of the corpus.

FILTER_BITS = 26


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """Place of each phrase among `size` bits, from the hashes of its words."""
    out = np.full(len(hashes), 0xCBF29CE484222325, np.uint64)
    for column_ in hashes.T:
        out = (out ^ column_) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out & np.uint64(size - 1)


def _found(places: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return (bits[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1 > 0


def phrase_filter(counts: DataFrame, filter_bits: int = FILTER_BITS) -> bytes:
    """2^26 bits (8 MB) by default in which those of the phrases of a frame (lang, phrase; of one length) are set.

    Phrases share bits, so a phrase that is not in the frame may seem to be,
    more often the more there are; one that is never seems not to be.
    """
    @F.arrow_udf(T.LongType())
    def place(lang: pa.Array, phrase: pa.Array) -> pa.Array:
        words = [[xxhash.xxh64_intdigest(f"{l}\n{w}".encode()) for w in p.split(" ")] for l, p in zip(lang.to_pylist(), phrase.to_pylist(), strict=True)]
        return pa.array(_places(np.array(words, np.uint64), 1 << filter_bits).astype(np.int64) if words else [], pa.int64())

    # Spark's bitmaps count places from 1, in buckets of 2^15.
    places = on_workers(counts).select((place("lang", "phrase") + 1).alias("place"))
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
    out = bytearray(1 << (filter_bits - 3))
    for bucket, bits in parts.collect():  # 2^11 buckets at most
        out[(bucket - 1) << 12:bucket << 12] = bits
    return bytes(out)


# The corpus.

def _parts(text: bytes, most: int, depth: int):
    """(part, sign): a long text in parts whose phrase counts, the negative ones taken
    off, add up to the text's.

    It is cut at the next blank; the words around a cut are a part of their own, for the phrases that
    run over it, and what these have on either side alone is taken off again.
    """
    def before(start, at):
        """Where the last depth - 1 words between `start` and `at` begin."""
        for _ in range(depth):
            while at > start and text[at - 1] == 32:
                at -= 1
            if _ < depth - 1:
                at = max(text.rfind(b" ", start, at) + 1, start)
        return at

    def after(at):
        """Where the first depth - 1 words from `at` on end."""
        for _ in range(depth - 1):
            while at < len(text) and text[at] == 32:
                at += 1
            at = text.find(b" ", at)
            if at < 0:
                return len(text)
        return at

    if len(text) > most:
        text = text.translate(_TABLE)
    start = 0
    while len(text) - start > most:
        cut = text.find(b" ", start + most)
        if cut < 0:
            break
        left, right = before(start, cut), after(cut)
        yield text[start:cut], 1
        yield text[left:right], 1
        yield text[left:cut], -1
        yield text[cut:right], -1
        start = cut
    yield text[start:], 1


def phrase_counts(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = 3, shard_words: int = 1 << 19,
    default_lang: str = "und", at_least: int = 1, neighbours: bool = True, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """(lang, phrase, n, preceded, followed): every phrase of up to `depth` words
    that occurs `at_least` times in its language, how often it does, and (with `neighbours`) how
    many of these occurrences have a word before and after them in the piece.
    The phrase '' stands for all words of a language.

    A-Z count as a-z; pieces end at punctuation and line breaks, words at
    blanks; phrases lie within a piece and overlaps count. Tasks index their
    texts in shards of about `shard_words` words, and shards' counts are added
    up, so how texts are dealt out does not matter. A shard has one row a phrase, so
    its rows are shuffled as they are: adding up before would find next to nothing to add. Texts longer than a shard
    are cut, with the phrases across the cut counted on their own.

    With `at_least` over 1, phrases of three words and more are counted in
    rounds, each only where both parts one word shorter may be frequent: tasks
    get 2^`filter_bits` bits that say so, which err to one side alone. What is returned
    is exact at any size; with very many frequent phrases, the bits just spare less.

    Null text counts as empty, null languages as `default_lang`; a repeated row
    counts again; an empty table has no phrases. Extra columns are left out.
    """
    texts = df.select(
        F.make_valid_utf8(F.coalesce(column(lang_col).cast("string"), F.lit(default_lang))).alias("lang"),
        F.make_valid_utf8(F.coalesce(column(text_col), F.lit(""))).cast("binary").alias("text"))
    if at_least <= 1 or depth < 3:
        return _counted(texts, range(1, depth + 1), shard_words, at_least, neighbours, {})
    # A frequent phrase has frequent parts: longer ones are only looked for where these may be, a round for each length.
    found = [written(_counted(texts, range(1, 3), shard_words, at_least, neighbours, {}))]
    filters = {}
    for length in range(3, depth + 1):
        shorter = found[-1].filter(F.size(F.split("phrase", " ")) == length - 1)
        filters[length - 1] = phrase_filter(shorter.filter("phrase <> ''"), filter_bits)
        found.append(written(_counted(texts, range(length, length + 1), shard_words, at_least, neighbours, filters)))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _counted(texts: DataFrame, lengths: range, shard_words: int, at_least: int, neighbours: bool, filters: dict[int, bytes]) -> DataFrame:
    """(lang, phrase, n, ...) of the phrases of some lengths, added up over all shards."""
    depth, spark = lengths[-1], texts.sparkSession
    numbers = ("n", "preceded", "followed") if neighbours else ("n",)
    schema = T.StructType([T.StructField("key", T.StringType()), *(T.StructField(name, T.LongType()) for name in numbers)])
    shared = spark.sparkContext.broadcast(filters)

    def index(batches):
        shards = {1: Shard(), -1: Shard()}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"], strict=True):
                for part, sign in _parts(text.as_py(), shard_words * 4, depth):
                    shards[sign].add(lang, part)
                    if shards[sign].size >= shard_words:
                        yield from _signed(shards[sign].rows(lengths, neighbours, shared.value), sign)
                        shards[sign] = Shard()
        for sign, shard in shards.items():
            yield from _signed(shard.rows(lengths, neighbours, shared.value), sign)

    rows = on_workers(texts).mapInArrow(index, schema)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    added = rows.repartition(parts, "key").groupBy("key").agg(*(F.sum(name).alias(name) for name in numbers))
    lang = F.left("key", F.length("key") - F.length(F.substring_index("key", "\n", -1)) - 1)
    added = added.select(lang.alias("lang"), F.substring_index("key", "\n", -1).alias("phrase"), *numbers)
    return added.filter((F.col("n") >= at_least) | (F.col("phrase") == ""))


def _signed(batches, sign: int):
    for batch in batches:
        if sign < 0:
            batch = pa.RecordBatch.from_arrays([batch.columns[0], *(pc.negate(x) for x in batch.columns[1:])], names=batch.schema.names)
        yield batch


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(10^6 a^2 / (l r)), exact for counts up to 10^15."""
    wide = lambda x: x.cast("decimal(15,0)")
    whole = F.call_function("div", wide(a) * wide(a) * F.lit(1_000_000).cast("decimal(7,0)"), wide(left) * wide(right))
    return whole.cast("bigint")


def collocations(
    df: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = 3, min_count: int = 10, best: int = 2000,
    inside_percent: int = 50, shard_words: int = 1 << 19,
) -> DataFrame:
    """The `best` phrases of each language by score: lang, rank (from 1), phrase, a
    (its count), l and r (its two parts' counts), n (all words of the language), score.

    Candidates are phrases of 2 to `depth` words that occur `min_count` times. A
    candidate is cut in two where a^2 / (l r) is least (in millionths, rounded
    down; the first such cut). It is dropped if a longer candidate that holds its words occurs in
    `inside_percent` per cent of its places. Equal scores go by count, then by
    phrase. Nulls and odd rows: see `phrase_counts`.
    """
    found = written(phrase_counts(df, text_col, lang_col, depth, shard_words, at_least=min_count, neighbours=False))
    words = F.split("phrase", " ")
    joined = lambda start, size: F.array_join(F.slice("words", start, size), " ")
    many = found.filter(F.contains("phrase", F.lit(" "))).withColumn("words", words).withColumn("k", F.size("words"))

    cuts = many.select("lang", "phrase", F.col("n").alias("a"), "k", "words", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cuts = cuts.withColumns({"head": joined(F.lit(1), F.col("cut")), "rest": joined(F.col("cut") + 1, F.col("k") - F.col("cut"))}).drop("words", "k")
    for side, to in (("head", "l"), ("rest", "r")):
        cuts = cuts.join(found.select("lang", F.col("phrase").alias(side), F.col("n").alias(to)), ["lang", side])
    cuts = cuts.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    least = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a")).alias("best"))
    least = least.select("lang", "phrase", "best.*")

    longer = many.filter("k > 2").select(
        "lang", F.col("n").alias("longer"), F.explode(_inner(depth)).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = least.join(longer, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a")))

    totals = found.filter("phrase = ''").select("lang", F.col("n").alias("all_words"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("all_words").alias("n"), "score")


def _inner(depth: int) -> Column:
    """The different shorter phrases, of two words and more, in a row's `words`."""
    size = F.size("words")
    return F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(2), F.greatest(size - 1, F.lit(2))),
        lambda k: F.transform(F.sequence(F.lit(1), size - k + 1), lambda i: F.array_join(F.slice("words", i, k), " ")))))
