"""Quality rules: counts of each text, and lines that too many documents share."""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.search import greatest_up_to
from newsloom.functions.steps import computed_once
from newsloom.llm.shared import column, written

_SPACE = r"[\x20\x09-\x0D]+"
_BLANKS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _plain(text: Column) -> Column:
    """The words with one space between them."""
    return F.trim(F.regexp_replace(text, _SPACE, " "))


def _n_words(plain: Column) -> Column:
    return F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit(""))) + 1)


def _line_key(plain: Column) -> Column:
    """Hash of a normalised line, given with single spaces: lower case, 0 for every digit."""
    return F.xxhash64(F.regexp_replace(F.lower(plain), "[0-9]", "0"))


def _placed_lines(text: Column) -> Column:
    """(at, line, words) of each line with a word: its place among all lines, hash and number of words."""
    plain = F.transform(F.split(text, "\n"), lambda line, at: F.struct(at.alias("at"), _plain(line).alias("plain")))
    return F.transform(F.filter(plain, lambda p: p["plain"] != ""), lambda p: F.struct(
        p["at"].alias("at"), _line_key(p["plain"]).alias("line"), _n_words(p["plain"]).alias("words")))


def _word_lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: F.trim(line, F.lit(_BLANKS)) != "")


def _with_base(df: DataFrame, text: str) -> DataFrame:
    """Adds the counts of each text. Repeated windows are found by sorting their
    hashes with their places; a word under several of them counts once."""
    body = F.col(text)
    df = df.withColumn("plain", _plain(body))
    df = df.withColumn("words", F.when(F.col("plain") == "", F.array().cast("array<string>")).otherwise(F.split("plain", " ")))
    df = computed_once(df, "plain", "words")
    n = F.size("words")
    df = computed_once(df.withColumn("marks", F.transform("words", lambda w: F.xxhash64(w))), "marks")
    window = lambda i: F.xxhash64(F.get("marks", i), F.get("marks", i + 1), F.get("marks", i + 2))
    df = computed_once(df.withColumn("hashes", F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), window))), "hashes")
    placed = F.transform("hashes", lambda h, at: F.struct(h.alias("h"), at.alias("at")))
    some = F.size(F.array_distinct("hashes")) < F.size("hashes")
    df = df.withColumn("windows", F.when(some, F.sort_array(placed)).otherwise(_no_windows()))
    df = computed_once(df, "windows")
    same = lambda w, i: (w.h == F.get("windows", i - 1).h) | (w.h == F.get("windows", i + 1).h)
    found = F.sort_array(F.transform(F.filter("windows", same), lambda w: w["at"]))
    spread = F.aggregate(
        found, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("sum")),
        lambda s, at: F.struct(at.alias("last"), (s["sum"] + F.least(F.lit(3), at - s["last"])).alias("sum")))
    lines = _word_lines(body)
    symbols = F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))
    return df.select(
        "*", n.cast("bigint").alias("n_words"), (F.length("plain") - F.greatest(n - 1, F.lit(0))).cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        spread["sum"].alias("n_repeat_words"),
    ).drop("plain", "words", "marks", "hashes", "windows")


def _no_windows() -> Column:
    return F.array().cast("array<struct<h:bigint,at:int>>")


def _among(key: Column, sorted_keys: Column) -> Column:
    return F.coalesce(greatest_up_to(sorted_keys, key, (1 << 30) - 1) == key, F.lit(False))


def _marks(id_: Column, text: Column, host: Column) -> list[Column]:
    """Two numbers that stand for a document: rows with equal ones are treated alike."""
    return [F.xxhash64(F.lit(k), id_.isNull(), id_, host, text).alias(f"mark{k}") for k in (1, 2)]


def removed_lines(df: DataFrame, id_col: str, text_col: str, host_col: str, min_docs: int, share_percent: int) -> DataFrame:
    """(mark1, mark2, at, words): places and numbers of words of the lines to
    remove from each document that has any.

    A line goes if over `min_docs` documents (different ids) of its host have it, and over
    `share_percent` per cent of them where that is asked for. Lines are judged
    and found by host and hash, so nothing has the size of a host.
    """
    id_, host, text = column(id_col), F.coalesce(column(host_col), F.lit("")), F.coalesce(column(text_col), F.lit(""))
    keys = F.array_distinct(F.transform(_placed_lines(text), lambda placed: placed["line"]))
    # Rows of an equal id are one document; each row without an id is one of its own.
    own = F.when(id_.isNull(), F.monotonically_increasing_id())
    lines = df.select(host.alias("host"), id_.alias("id"), F.explode(keys).alias("line"))
    over = lines.groupBy("host", "line").agg(F.count("*").alias("n"), F.min("id").alias("first")).filter(F.col("n") > min_docs)
    # Lines in so many rows are few; only for these the documents are told apart.
    placed = df.select(host.alias("host"), id_.alias("id"), own.alias("own"), *_marks(id_, text, host), _placed_lines(text).alias("lines"))
    placed = placed.select("host", "id", "own", "mark1", "mark2", F.inline("lines"))
    hits = written(placed.join(written(over.select("host", "line", "first")), ["host", "line"]))
    docs = hits.select("host", "line", "id", "own").distinct().groupBy("host", "line").agg(F.count("*").alias("docs"))
    docs = docs.filter(F.col("docs") > min_docs)
    if share_percent:
        every = df.select(host.alias("host"), id_.alias("id"), own.alias("own")).distinct()
        hosts = every.groupBy("host").agg(F.count("*").alias("n_docs"))
        docs = docs.join(hosts, "host").filter(F.col("docs") * 100 > F.col("n_docs") * share_percent)
    hits = hits.join(docs.select("host", "line"), ["host", "line"], "left_semi")
    hits = hits.filter(F.col("first").isNull() | F.col("id").isNull() | (F.col("first") != F.col("id")))
    return hits.select("mark1", "mark2", "at", "words").distinct()


def _marked(df: DataFrame, id_col: str, text_col: str, host_col: str) -> DataFrame:
    """(row, id, text, counts, mark1, mark2)"""
    text = F.coalesce(column(text_col), F.lit(""))
    docs = df.select(F.struct("*").alias("row"), *_marks(column(id_col), text, F.coalesce(column(host_col), F.lit(""))))
    docs = docs.select("row", F.col("row")[id_col].alias("id"), F.coalesce(F.col("row")[text_col], F.lit("")).alias("text"), "mark1", "mark2")
    return _with_base(docs, "text")


def _with_verdict(docs: DataFrame, min_left_percent: int, min_words: int) -> DataFrame:
    """Adds lines_removed, left_words, base_failed and kept, from the `gone` and `gone_words` of the lines to remove."""
    docs = docs.withColumn("lines_removed", F.coalesce("gone", F.lit(0)).cast("bigint"))
    # A line's end parts words, so what is left has all words but those of the removed lines.
    docs = docs.withColumn("left_words", (F.col("n_words") - F.coalesce("gone_words", F.lit(0))).cast("bigint"))
    docs = docs.withColumn("base_failed", _base_failed(min_words))
    return docs.withColumn("kept", ~F.col("base_failed") & (100 * F.col("left_words") >= min_left_percent * F.col("n_words")))


def _base_failed(min_words: int) -> Column:
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = 20,
    share_percent: int = 0, min_left_percent: int = 50, min_words: int = 50,
) -> DataFrame:
    """One row per input row: id_col, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, lines_removed, left_words.

    Lines above the limits of their host (`removed_lines`) are removed from all
    its documents but the one of the smallest id, so that no text is lost
    altogether. A document is rejected if it fails the base rules (fewer than
    `min_words` words, or over half of them in repeated three-word windows) or if
    under `min_left_percent` per cent of its words are left.

    Null text: no words, rejected. Documents without a host form one host; those
    without an id keep no frequent line, and each counts as one. Repeated rows are one document, and are treated alike. Extra
    columns are left out.
    """
    slim = df.select(*map(column, dict.fromkeys((id_col, text_col, host_col))))
    gone = removed_lines(slim, id_col, text_col, host_col, min_docs, share_percent).groupBy("mark1", "mark2").agg(
        F.count("*").alias("gone"), F.sum("words").alias("gone_words"))
    # Only counts meet the removed lines; no text is moved.
    docs = computed_once(_marked(slim, id_col, text_col, host_col).drop("row", "text"), *BASE)
    out = _with_verdict(docs.join(gone, ["mark1", "mark2"], "left"), min_left_percent, min_words)
    return out.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "lines_removed", "left_words")


def cleaned(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", min_docs: int = 20,
    share_percent: int = 0, min_left_percent: int = 50, min_words: int = 50,
) -> DataFrame:
    """The rows of `df` that `quality_rules` keeps, their texts without the lines
    it removes; all other columns as they are."""
    gone = removed_lines(df, id_col, text_col, host_col, min_docs, share_percent).groupBy("mark1", "mark2").agg(
        F.count("*").alias("gone"), F.sum("words").alias("gone_words"), F.sort_array(F.collect_list("at")).alias("mine"))
    docs = computed_once(_marked(df, id_col, text_col, host_col).drop("text"), *BASE).filter(~_base_failed(min_words)).drop(*BASE[1:-1])
    # Texts meet their lines in a merge at every size, so that what is moved grows with the texts alone.
    docs = docs.join(gone.hint("merge"), ["mark1", "mark2"], "left")
    out = _with_verdict(docs, min_left_percent, min_words).filter("kept")
    text = F.col("row")[text_col]
    left = F.array_join(F.filter(F.split(text, "\n"), lambda line, at: ~_among(at, F.col("mine"))), "\n")
    text = F.when(F.col("lines_removed") == 0, F.coalesce(text, F.lit(""))).otherwise(left)
    return out.select(*(
        text.alias(name) if name == text_col else F.col("row")[name].alias(name) for name in df.columns))
