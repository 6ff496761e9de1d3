"""Packing of token ids into training windows, with lexical neighbours together."""

import json
import re
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from newsloom.llm.shared import Kept, column, held_alone, on_workers

#: Words left to the tokenizer itself whose ids a worker keeps (twice as many at most), and characters up to which they are kept.
KEPT_WORDS, KEPT_CHARS = 1 << 16, 64
#: Characters that are encoded at a time, where a text can be cut.
BLOCK = 1 << 16
#: Characters from here on are left to the tokenizer itself.
LATIN = "\u0250"
_FOREIGN = re.compile(f"[{LATIN}-\U0010ffff]")
#: White space before `LATIN`, as the tokenizer has it.
_WHITE = "\t-\r \x85\xa0"
_RUN = re.compile(f"[{_WHITE}][{_WHITE}]")
_RUN_END = re.compile(f"(?<=[{_WHITE}])(?=[{_WHITE}][^{_WHITE}])")
_SAFE_CUT = re.compile(r"(?<=\S)(?=\x20\S)")


class Encoder:
    """The tokenizer of a byte-level BPE file, with a quicker one of the same
    vocabulary for Latin text without special tokens, on which both agree.

    The quicker one looks ahead nowhere: what looking ahead does, leaving the last
    character of a run of white space to what follows, is done by cutting there."""

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.whole, self.kept = Tokenizer.from_file(path), Kept(KEPT_WORDS)
        with open(path, encoding="utf-8") as file:
            stored = json.load(file)
        self.special = [t["content"] for t in stored["added_tokens"]]
        ranks = {_bytes_of(token): i for token, i in stored["model"]["vocab"].items() if token not in self.special}
        pattern = PATTERN.replace(r"\s+(?!\S)|", "")
        self.quick = tiktoken.Encoding("bytes", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bool:
        """Whether the quicker tokenizer takes it."""
        return (text.isascii() or not _FOREIGN.search(text)) and not any(s in text for s in self.special)

    def plain_ids(self, text: str) -> bytes:
        ids = []
        for part in _RUN_END.split(text) if _RUN.search(text) else [text]:
            ids += self.quick.encode_ordinary(part)
        return np.array(ids, dtype="<u4").tobytes()

    def other_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word. Short ones are kept."""
        short = iter(self.kept.values([w for w in words if len(w) <= KEPT_CHARS], self.fill))
        return [next(short) if len(w) <= KEPT_CHARS else self.found([w])[0] for w in words]

    def fill(self, words: list[str]) -> None:
        self.kept.new.update(zip(words, self.found(words), strict=True))

    def found(self, words: list[str]) -> list[bytes]:
        return [np.array(found.ids, dtype="<u4").tobytes() for found in self.whole.encode_batch(words, add_special_tokens=False)]

    def ids(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit numbers.

        The tokenizer never joins anything over a space between two characters
        that are not white space, so texts are cut there: long ones into blocks,
        and those with other characters or special tokens into words."""
        out = []
        for block in _blocks(text):
            if self.plain(block):
                out.append(self.plain_ids(block))
                continue
            for plain, words in groupby(_SAFE_CUT.split(block), self.plain):
                out += [self.plain_ids("".join(words))] if plain else self.other_ids(list(words))
        return b"".join(out)


def _blocks(text: str):
    """A text in parts of `BLOCK` characters, each up to the next safe cut."""
    start = 0
    while len(text) - start > BLOCK and (cut := _SAFE_CUT.search(text, start + BLOCK)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]


def _bytes_of(token: str) -> bytes:
    """Bytes of a token of a byte-level vocabulary: printable bytes stand for themselves, the others follow from U+0100 on."""
    return bytes(_BYTES[c] for c in token)


_PRINTABLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTES = {chr(b): b for b in _PRINTABLE} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}


def encoded(texts: list[str], path: str) -> list[bytes]:
    """Ids of each text, as little-endian unsigned 32-bit numbers."""
    encoder = held_alone(("encoder", path), lambda: Encoder(path))
    return list(map(encoder.ids, texts))


class Index:
    """BM25 over the documents of a shard; terms are token ids."""

    def __init__(self, docs: list[np.ndarray], k1: float = 1.2, b: float = 0.75):
        counted = [np.unique(ids, return_counts=True) for ids in docs]
        terms = np.concatenate([t for t, _ in counted])
        tf = np.concatenate([c for _, c in counted])
        sizes = np.array([len(t) for t, _ in counted])
        owner = np.repeat(np.arange(len(docs), dtype=np.int32), sizes)
        lengths = np.array([len(d) for d in docs])
        self.df = np.bincount(terms)
        idf = np.log(1 + (len(docs) - self.df + 0.5) / (self.df + 0.5))
        weight = idf[terms] * tf * (k1 + 1) / (tf + k1 * (1 - b + b * lengths[owner] / lengths.mean()))
        self.own = np.concatenate([[0], np.cumsum(sizes)])
        self.terms, self.weights = terms, weight
        order = np.argsort(terms, kind="stable")
        self.posted, self.scores = owner[order], weight[order]
        self.ends = np.cumsum(self.df)
        self.n = len(docs)

    def neighbours(self, doc: int, used: np.ndarray, query_terms: int, found: int) -> list[int]:
        """Unused documents that share the seed's weightiest terms, best first; of equal ones the earlier first."""
        mine = slice(self.own[doc], self.own[doc + 1])
        terms, weights = self.terms[mine], self.weights[mine]
        shared = self.df[terms] > 1
        terms, weights = terms[shared], weights[shared]
        if len(terms) > query_terms:
            terms = terms[np.argpartition(-weights, query_terms)[:query_terms]]
        if not len(terms):
            return []
        spans = [slice(self.ends[t] - self.df[t], self.ends[t]) for t in terms]
        scores = np.bincount(
            np.concatenate([self.posted[s] for s in spans]), np.concatenate([self.scores[s] for s in spans]), minlength=self.n)
        scores[used] = 0
        best = np.argpartition(-scores, found)[:found] if len(scores) > found else np.arange(len(scores))
        best = best[np.lexsort((best, -scores[best]))]
        return [int(i) for i in best if scores[i] > 0]


class Windows:
    """Windows in the making: pieces of (document key, start, length)."""

    def __init__(self, window: int):
        self.window, self.open, self.room, self.full = window, [], window, []

    def add(self, key, length: int) -> bool:
        """Put a document in, cut wherever a window is full. True if it opened the window that is now open."""
        start = 0
        while start < length:
            take = min(self.room, length - start)
            self.open.append((key, start, take))
            start += take
            self.room -= take
            if not self.room:
                self.full.append(self.open)
                self.open, self.room = [], self.window
        return len(self.open) == 1

    def finish(self) -> None:
        """Cut what is left into windows whose lengths are powers of two, so that nothing needs padding."""
        left, pieces = self.window - self.room, self.open
        while left:
            size, part = 1 << (left.bit_length() - 1), []
            left -= size
            while size:
                key, start, length = pieces.pop(0)
                take = min(size, length)
                part.append((key, start, take))
                size -= take
                if take < length:
                    pieces.insert(0, (key, start + take, length - take))
            self.full.append(part)
        self.open, self.room = [], self.window


def pack_shard(docs: list[np.ndarray], windows: Windows, query_terms: int, found: int) -> None:
    """Add every document of a shard. The document that opens a window is its
    seed; the seed's best unused neighbours follow until it is full, and the one
    that is cut there is the next seed. Without neighbours, the next unused
    document in order is the seed."""
    index, used, at, queue = Index(docs), np.zeros(len(docs), dtype=bool), 0, []
    for _ in docs:
        while queue and used[queue[0]]:
            queue.pop(0)
        if queue:
            doc = queue.pop(0)
        else:
            while used[at]:
                at += 1
            doc = at
        used[doc] = True
        opened = windows.add(doc, len(docs[doc]))
        if opened or not queue:
            queue = index.neighbours(doc, used, query_terms, found)


def packed(
    df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", window: int = 2048, end_id: int = 1,
    shard_tokens: int = 1 << 21, query_terms: int = 12, found: int = 16,
) -> DataFrame:
    """One row per piece of a document: id_col, start, length, ids (binary,
    little-endian unsigned 32-bit), doc_tokens, sequence_id, offset.

    The documents of an input split are a shard of the index, or several, of
    about `shard_tokens` ids, whatever the split's size. A window that is open
    at the end of one goes on in the next; only the last of a split is short,
    and is cut into lengths that are powers of two. `found` neighbours are
    looked up at a time, and more when they are used up.

    Every document ends with `end_id`; null text counts as empty and is that id
    alone. Rows repeated or with a null id are documents of their own; extra
    columns are left out.
    """
    source = df.select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))
    schema = T.StructType([T.StructField("id", source.schema["id"].dataType)] + [
        T.StructField(name, kind) for name, kind in (
            ("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()), ("doc_tokens", T.LongType()),
            ("sequence_id", T.LongType()), ("offset", T.LongType()))])
    end = np.array([end_id], dtype="<u4").tobytes()

    def pack(batches):
        windows, sequence = Windows(window), TaskContext.get().partitionId() << 40
        keys, docs, carried, names = [], [], {}, count()

        def out(last):
            nonlocal sequence, keys, docs, carried
            if docs:
                # Pieces of the window that is still open belong to the shard before.
                pack_shard(docs, windows, query_terms, found)
            if last:
                windows.finish()
            rows = [[] for _ in range(7)]
            for pieces in windows.full:
                offset = 0
                for doc, start, length in pieces:
                    key, ids = carried[doc] if isinstance(doc, tuple) else (keys[doc], docs[doc])
                    for cell, value in zip(rows, (key, start, length, ids[start:start + length].tobytes(), len(ids), sequence, offset), strict=True):
                        cell.append(value)
                    offset += length
                sequence += 1
            windows.full = []
            moved, opened = {}, []
            for doc, start, length in windows.open:
                name = doc if isinstance(doc, tuple) else ("carried", next(names))
                moved[name] = carried[doc] if isinstance(doc, tuple) else (keys[doc], docs[doc])
                opened.append((name, start, length))
            windows.open, carried, keys, docs = opened, moved, [], []
            return pa.RecordBatch.from_arrays([
                pa.array(cell, kind) for cell, kind in zip(rows, (id_type, *[pa.int64()] * 2, pa.binary(), *[pa.int64()] * 3), strict=True)
            ], names=schema.names)

        size, id_type = 0, pa.int64()
        for batch in batches:
            id_type = batch["id"].type
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for key, ids in zip(part["id"].to_pylist(), encoded(part["text"].to_pylist(), tokenizer_path), strict=True):
                    keys.append(key)
                    docs.append(np.frombuffer(ids + end, dtype="<u4"))
                    size += len(docs[-1])
                    if size >= shard_tokens:
                        yield out(False)
                        size = 0
        if docs or windows.open:
            yield out(True)

    rows = on_workers(source).mapInArrow(pack, schema)
    return rows.select(F.col("id").alias(id_col), *schema.names[1:])
