"""SentencePiece encoding with seeded merge dropout, and decoding."""

import re
from functools import lru_cache
from heapq import heappop, heappush
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from newsloom.llm.shared import column, on_workers

MARK = "▁"
#: Stands for a mark of the text itself: no character, so no text and no piece has it.
OWN_MARK = "\udcff"
#: Segmentations that a worker keeps; when there are more, it begins anew.
KEPT_NODES = 1 << 19
#: Skipped merges of a word up to which its segmentations are kept.
DEEPEST = 1
#: Words whose merges are drawn at a time.
DRAWN_WORDS = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words up to this length are segmented in arrays, longer ones with a heap.
SHORT = 40
NEVER = float("inf")
#: No candidate.
NOTHING = np.uint64((1 << 64) - 1)
_WORDS = re.compile(r" *[^ ]+| +$")


class Vocabulary:
    """Ids, scores and merges of a BPE model with byte fallback.

    Symbols are piece ids; a character that is no piece has the number of pieces
    plus its code point, and takes part in no merge.
    """

    def __init__(self, path: str):
        import sentencepiece
        import tiktoken

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        plain = [i for i in range(len(pieces)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        ids = {pieces[i]: i for i in plain}
        self.size, self.plain = len(pieces), [pieces[i] for i in plain]
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.bytes_of = np.array(self.byte_ids, dtype=np.int32)
        self.text = [b"" for _ in pieces]
        for i in plain:
            self.text[i] = pieces[i].replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.text[i] = bytes([b])
        self.letters = np.frombuffer(b"".join(self.text), np.uint8)
        self.letter_counts = np.array([len(t) for t in self.text])
        self.letter_starts = np.cumsum(self.letter_counts) - self.letter_counts
        # Characters of each piece (of those in bytes, with the first), and whether a space comes first.
        self.chars = np.array([len(p) for p in pieces])
        self.chars[self.byte_ids] = [b & 0xC0 != 0x80 for b in range(256)]
        self.opens = np.array([p.startswith(MARK) for p in pieces])
        self.plain_ids = np.array(plain)
        self.symbol = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for piece, i in ids.items():
            if len(piece) == 1:
                self.symbol[ord(piece)] = i
        self.rank = np.array([-model.get_score(i) for i in range(self.size)], dtype=np.float32)
        self.merges = {
            self.pair(ids[piece[:k]], ids[piece[k:]]): i
            for piece, i in ids.items() for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids}
        # The same for words in ASCII, a space before each: single bytes come first, merged pieces in the order of their ranks.
        merged = sorted((i for i in set(self.merges.values()) if self.text[i].isascii()), key=lambda i: (self.rank[i], i))
        tokens = [bytes([b]) for b in range(256)] + [self.text[i] for i in merged]
        self.quick = tiktoken.Encoding("words", pat_str=" [^ ]*", mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
        single = [s if s < self.size else self.byte_ids[b] for b, s in enumerate(self.symbol[:256].tolist())]
        single[ord(" ")] = int(self.symbol[ord(MARK)])
        self.id_of = np.array(single + merged)
        # The merges as a hash table in arrays: the first free slot from a pair's own on.
        self.slots = np.full(1 << (len(self.merges).bit_length() + 2), -1, dtype=np.int64)
        self.merged = np.zeros(len(self.slots), dtype=np.int32)
        for pair, i in self.merges.items():
            at = int(self._slot(np.array([pair]))[0])
            while self.slots[at] >= 0:
                at = (at + 1) % len(self.slots)
            self.slots[at], self.merged[at] = pair, i

    def pair(self, left, right):
        return left * (self.size + 0x110000) + right

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        mixed = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def merge_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each pair merges to and its rank; NEVER where there is no merge or no pair (-1)."""
        if np.ndim(left) == 2:
            return tuple(x.reshape(left.shape) for x in self.merge_of(left.ravel(), right.ravel()))
        wanted = self.pair(left.astype(np.int64), right)
        at = self._slot(wanted)
        there = self.slots[at]
        on = np.flatnonzero((there != wanted) & (there >= 0))
        while len(on):
            at[on] = (at[on] + 1) % len(self.slots)
            there[on] = self.slots[at[on]]
            on = on[(there[on] != wanted[on]) & (there[on] >= 0)]
        found = (there == wanted) & (right >= 0) & (left >= 0)
        merged = np.where(found, self.merged[at], 0)
        return merged, np.where(found, self.rank[merged], np.float32(NEVER))

    def ids_of(self, symbols: list[int]) -> bytes:
        """Ids of symbols (-1: none), little-endian; characters that are no piece by the ids of their bytes."""
        out = []
        for s in symbols:
            if 0 <= s < self.size:
                out.append(s)
            elif s >= 0:
                char = chr(s - self.size)
                out += [self.byte_ids[b] for b in (MARK if char == OWN_MARK else char).encode()]
        return np.array(out, dtype="<u4").tobytes()


def _mix(x):
    """A 64-bit finaliser; for integers and for arrays of unsigned ones."""
    whole = (1 << 64) - 1
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = x ^ (x >> shift)
        x = x * np.uint64(factor) if isinstance(x, np.ndarray) else x * factor & whole
    return x ^ (x >> 31)


def _drawn(place: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Candidate merges in one number: place of the first character, resulting piece."""
    return (place.astype(np.uint64) << np.uint64(32)) + piece.astype(np.uint64)


def _draw(own, place, piece):
    """The keyed hash of a candidate merge: word and key, place of its first character, resulting piece."""
    if isinstance(own, np.ndarray):
        return _mix(own + _drawn(place, piece)) >> np.uint64(32)
    return _mix((own + (place << 32) + piece) & (1 << 64) - 1) >> 32


def _segment_short(
    words: list[str], own: np.ndarray, vocabulary: Vocabulary, limit: int, barred: np.ndarray | None = None, taken: list | None = None,
) -> list[bytes]:
    """Ids of words of similar lengths, all together: in each round every word
    takes the least candidate of its agenda and merges or skips it. A symbol
    stays where its first character was, linked to its neighbours. With `barred`,
    candidates are not drawn for: a word skips those of its row. `taken` gets
    (word, place and piece as drawn) of the candidates that are merged."""
    lengths, out = np.array([len(w) for w in words]), [b""] * len(words)
    width = int(lengths.max()) + 2  # with an empty place on either side
    symbols = np.full((len(words), width), -1, dtype=np.int32)
    columns = np.arange(width, dtype=np.int8)
    symbols[(columns > 0) & (columns <= lengths[:, None])] = vocabulary.symbol[
        np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    after, before = (np.tile(columns + d, (len(words), 1)) for d in (np.int8(1), np.int8(-1)))
    merged, ranks = vocabulary.merge_of(symbols, np.roll(symbols, -1, axis=1))
    live = np.arange(len(words))

    def finish(some):
        done = symbols[some]
        single = (done >= vocabulary.size) & (done < vocabulary.size + 128)  # of one byte
        done[single] = vocabulary.bytes_of[done[single] - vocabulary.size]
        there = done >= 0
        data, ends = done[there].astype("<u4").tobytes(), (4 * np.cumsum(there.sum(axis=1))).tolist()
        for i, start, end in zip(live[some].tolist(), [0, *ends[:-1]], ends, strict=True):
            out[i] = data[start:end]
        strange = (done >= vocabulary.size + 128).any(axis=1)
        for i, line in zip(live[some][strange].tolist(), done[strange].tolist(), strict=True):
            out[i] = vocabulary.ids_of(line)

    while len(live):
        at = ranks.argmin(axis=1)
        rows = np.flatnonzero(ranks[np.arange(len(live)), at] != NEVER)
        if 4 * len(rows) < 3 * len(live):
            over = np.ones(len(live), dtype=bool)
            over[rows] = False
            finish(over)
            live, symbols, after, before, merged, ranks, at = (x[rows] for x in (live, symbols, after, before, merged, ranks, at))
            rows = np.arange(len(live))
        at = at[rows]
        piece = merged[rows, at]
        if limit or barred is not None:
            skip = _draw(own[live[rows]], at - 1, piece) < limit if barred is None else (barred[live[rows]] == _drawn(at - 1, piece)[:, None]).any(axis=1)
            ranks[rows[skip], at[skip]] = NEVER
            rows, at, piece = rows[~skip], at[~skip], piece[~skip]
        if taken is not None:
            taken.append((live[rows], _drawn(at - 1, piece)))
        gone = after[rows, at]
        right, left = after[rows, gone], before[rows, at]
        symbols[rows, at], symbols[rows, gone], ranks[rows, gone] = piece, -1, NEVER
        after[rows, at], before[rows, right] = right, at
        merged[rows, at], ranks[rows, at] = vocabulary.merge_of(piece, symbols[rows, right])
        merged[rows, left], ranks[rows, left] = vocabulary.merge_of(symbols[rows, left], piece)
    return out


def _segment_long(word: str, own: int, vocabulary: Vocabulary, limit: int) -> bytes:
    """The same for one word with a heap, so that words of any length take n log n."""
    parts, size = vocabulary.symbol[[ord(c) for c in word]].tolist(), len(word)
    after, before, agenda = [*range(1, size), -1], [*range(-1, size - 1)], []

    def offer(i, j):
        merged = vocabulary.merges.get(vocabulary.pair(parts[i], parts[j]))
        if merged is not None:
            heappush(agenda, (vocabulary.rank[merged], i, j, parts[i], parts[j], merged))

    for i in range(size - 1):
        offer(i, i + 1)
    while agenda:
        _, i, j, left, right, merged = heappop(agenda)
        if after[i] != j or parts[i] != left or parts[j] != right or (limit and _draw(own, i, merged) < limit):
            continue
        parts[i], parts[j] = merged, -1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            offer(i, k)
        if before[i] >= 0:
            offer(before[i], i)
    return vocabulary.ids_of(parts)


def _marked(word: str) -> str:
    """A word as its pieces have it, with the space before it."""
    return MARK + word.replace(MARK, OWN_MARK).replace(" ", MARK)


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Pile:
    """An array that grows at its end."""

    def __init__(self, kind, *shape: int):
        self.room, self.size = np.empty((1024, *shape), kind), 0

    def add(self, values: np.ndarray) -> None:
        end = self.size + len(values)
        if end > len(self.room):
            room = np.empty((2 * end, *self.room.shape[1:]), self.room.dtype)
            room[:self.size] = self.room[:self.size]
            self.room = room
        self.room[self.size:end] = values
        self.size = end


class Found:
    """Segmentations of short words, as trees. The root of a word's tree is the one
    without dropout; a node's candidates are those that are merged, and its
    children skip one more of them each. An occurrence goes down the tree by its
    draws until none of a node's candidates is skipped. The order in which they
    are barred is of no account, as a candidate has one draw however often it comes up.

    What is merged within a piece depends on its characters alone, so a root's
    candidates are those of its pieces, whatever finds these.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()
        nodes = self.add([p for p in vocabulary.plain if len(p) < SHORT], *self.unbarred(sum(len(p) < SHORT for p in vocabulary.plain)))
        whole = self.ids_of(nodes)[1] == 1
        self.inner, sizes = np.zeros(0, np.uint64), np.zeros(vocabulary.size, np.int64)
        ids, (starts, counts) = vocabulary.plain_ids[[len(p) < SHORT for p in vocabulary.plain]], self.candidates_of(nodes)
        sizes[ids[whole]] = counts[whole]
        order = np.argsort(ids[whole])
        self.inner = self.candidates.room[_runs(starts[whole][order], counts[whole][order])]
        self.inner_sizes, self.inner_starts = sizes, np.cumsum(sizes) - sizes
        self.clear()

    def clear(self) -> None:
        self.roots, self.children, self.words = {}, {}, []
        self.ids, self.candidates = Pile("<u4"), Pile(np.uint64)
        self.first_id, self.first_candidate = Pile(np.int64), Pile(np.int64)  # of each node and of the next one
        self.barred, self.depth = Pile(np.uint64, DEEPEST), Pile(np.int8)
        for pile in (self.first_id, self.first_candidate):
            pile.add(np.zeros(1, np.int64))

    def ids_of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and number of the nodes' ids."""
        return (start := self.first_id.room[nodes]), self.first_id.room[nodes + 1] - start

    def candidates_of(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (start := self.first_candidate.room[nodes]), self.first_candidate.room[nodes + 1] - start

    @staticmethod
    def unbarred(n: int) -> tuple[np.ndarray, np.ndarray]:
        return np.full((n, DEEPEST), NOTHING), np.zeros(n, np.int8)

    def append(self, words: list[str], barred, depth, ids, id_counts, candidates, candidate_counts) -> np.ndarray:
        """Nodes for marked words, all in their order."""
        first = len(self.words)
        self.words += words
        for pile, values in ((self.barred, barred), (self.depth, depth), (self.ids, ids), (self.candidates, candidates)):
            pile.add(values)
        for pile, counts in ((self.first_id, id_counts), (self.first_candidate, candidate_counts)):
            pile.add(pile.room[pile.size - 1] + np.cumsum(counts))
        return np.arange(first, len(self.words))

    def add(self, words: list[str], barred: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Nodes for marked words that skip what is barred."""
        lengths, nodes = np.fromiter(map(len, words), np.int64, len(words)), np.empty(len(words), np.int64)
        order = np.argsort(lengths, kind="stable")
        for at in range(0, len(order), 4096):
            some, taken = order[at:at + 4096], []
            these = [words[i] for i in some.tolist()]
            ids = _segment_short(these, np.zeros(len(some), np.uint64), self.vocabulary, 0, barred[some] if depth.any() else None, taken)
            owner, drawn = (np.concatenate(x) for x in zip(*taken, strict=True)) if taken else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
            nodes[some] = self.append(
                these, barred[some], depth[some], np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4,
                drawn[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(some)))
        return nodes

    def add_roots(self, words: list[str]) -> np.ndarray:
        """Roots for words: those in ASCII encoded one after the other, the others as all words are."""
        plain = np.fromiter((w.isascii() and w != "" and " " not in w for w in words), bool, len(words))
        some, v = [words[i] for i in np.flatnonzero(plain).tolist()], self.vocabulary
        ids = v.id_of[np.array(v.quick.encode_ordinary("".join([" " + w for w in some])), np.int64)]
        starts = np.flatnonzero(v.opens[ids])
        if len(starts) != len(some):  # a vocabulary without a mark alone
            plain[:] = False
            some, ids, starts = [], ids[:0], starts[:0]
        id_counts, sizes = np.diff(starts, append=len(ids)), self.inner_sizes[ids]
        places = np.cumsum(v.chars[ids]) - v.chars[ids]
        places -= np.repeat(places[starts], id_counts)
        candidates = self.inner[_runs(self.inner_starts[ids], sizes)] + (np.repeat(places, sizes).astype(np.uint64) << np.uint64(32))
        ends, nodes = np.concatenate([[0], np.cumsum(sizes)]), np.empty(len(words), np.int64)
        nodes[plain] = self.append(
            [MARK + w for w in some], *self.unbarred(len(some)), ids, id_counts, candidates, np.diff(ends[np.append(starts, len(ids))]))
        others = [_marked(words[i]) for i in np.flatnonzero(~plain).tolist()]
        nodes[~plain] = self.add(others, *self.unbarred(len(others)))
        return nodes

    def root(self, words: list[str]) -> np.ndarray:
        """Root of each word; -1 for long words."""
        nodes = np.fromiter(map(self.roots.get, words, repeat(-2)), np.int64, len(words))
        at = np.flatnonzero(nodes == -2).tolist()
        if at:
            new = {words[i] for i in at}
            short = [w for w in new if len(w) < SHORT]
            known = dict.fromkeys(new, -1)
            known.update(zip(short, self.add_roots(short).tolist(), strict=True))
            self.roots.update((w, known[w]) for w in short)
            nodes[at] = [known[words[i]] for i in at]
        return nodes

    def child(self, nodes: np.ndarray, skipped: np.ndarray) -> np.ndarray:
        """The nodes that skip one more candidate each, given by its number; -1 for those too deep to be kept."""
        keys = nodes << 6 | skipped
        below = np.fromiter(map(self.children.get, keys.tolist(), repeat(-1)), np.int64, len(keys))
        new = np.unique(keys[(below < 0) & (self.depth.room[nodes] < DEEPEST)])
        if len(new):
            parent, number = new >> 6, new & 63
            barred, depth = self.barred.room[parent], self.depth.room[parent]
            barred[np.arange(len(new)), depth] = self.candidates.room[self.first_candidate.room[parent] + number]
            made = self.add([self.words[i] for i in parent.tolist()], barred, depth + np.int8(1))
            self.children.update(zip(new.tolist(), made.tolist(), strict=True))
            at = np.minimum(np.searchsorted(new, keys), len(new) - 1)
            below = np.where(new[at] == keys, made[at], below)
        return below


def segmented(words: list[str], own: np.ndarray, found: Found, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, one after the other, and their number for each word; each word with a key of its own.

    A space comes before every word; others that do are part of it.
    Candidate merges leave an agenda by rank, then from left to right. One that
    leaves is skipped if its keyed hash is below `limit`; it comes back only as
    a new candidate, when one of its sides has changed, and with the same hash
    if it is the same piece at the same place. All words are drawn for.
    """
    if len(found.words) > KEPT_NODES:
        found.clear()
    nodes = found.root(words)
    here = np.flatnonzero(nodes >= 0) if limit else np.zeros(0, np.int64)
    while len(here):
        starts, sizes = found.candidates_of(nodes[here])
        hashes = _mix(np.repeat(own[here], sizes) + found.candidates.room[_runs(starts, sizes)]) >> np.uint64(32)
        skipped = np.flatnonzero(hashes < limit)
        owner = np.repeat(np.arange(len(here)), sizes)[skipped]
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        owner, skipped = owner[first], skipped[first]
        number, here = skipped - (np.cumsum(sizes) - sizes)[owner], here[owner]
        nodes[here] = found.child(nodes[here], number)
        here = here[nodes[here] >= 0]
    kept, others = np.flatnonzero(nodes >= 0), np.flatnonzero(nodes < 0)
    alone = dict.fromkeys(others.tolist(), b"")
    lengths = np.array([len(words[i]) for i in alone], np.int64)
    short = others[lengths < SHORT][np.argsort(lengths[lengths < SHORT], kind="stable")]
    for at in range(0, len(short), 4096):
        some = short[at:at + 4096]
        alone.update(zip(some.tolist(), _segment_short([_marked(words[i]) for i in some.tolist()], own[some], found.vocabulary, limit), strict=True))
    for i in others[lengths >= SHORT].tolist():
        alone[i] = _segment_long(_marked(words[i]), int(own[i]), found.vocabulary, limit)
    starts, counts = found.ids_of(nodes[kept])
    sizes = np.empty(len(words), np.int64)
    sizes[kept], sizes[others] = counts, [len(ids) // 4 for ids in alone.values()]
    ids, places = np.empty(sizes.sum(), "<u4"), np.cumsum(sizes) - sizes
    if not len(others):
        return found.ids.room[_runs(starts, counts)], sizes
    ids[_runs(places[kept], counts)] = found.ids.room[_runs(starts, counts)]
    ids[_runs(places[others], sizes[others])] = np.frombuffer(b"".join(alone.values()), "<u4")
    return ids, sizes


@lru_cache(maxsize=2)
def _loaded(path: str):
    return (vocabulary := Vocabulary(path)), Found(vocabulary)


def keys_of(name: str | None, seed: int, n: int) -> np.ndarray:
    """A key for each of the n words of a document: its name, the seed and the word's place."""
    first = np.uint64(xxhash.xxh64_intdigest(name or "", seed))
    return _mix(first + np.arange(1, n + 1, dtype=np.uint64) * _STEP)


def encoded(texts, names, path: str, dropout: float, seed: int) -> list[bytes]:
    """Ids of each text, little-endian unsigned 32-bit. No piece goes on over a
    space, so words are segmented alone; every occurrence has draws of its own."""
    found = _loaded(path)[1]
    words, keys, ends = [], [], []
    for text, name in zip(texts, names, strict=True):
        if not text:
            some = []
        elif "  " not in text and text[0] != " " and text[-1] != " ":
            some = text.split(" ")
        else:
            some = [w[1:] for w in _WORDS.findall(" " + text)]
        words += some
        keys.append(keys_of(name, seed, len(some)))
        ends.append(len(words))
    own, parts = np.concatenate(keys) if keys else np.zeros(0, np.uint64), [(np.zeros(0, "<u4"), np.zeros(1, np.int64))]
    for at in range(0, len(words), DRAWN_WORDS):
        parts.append(segmented(words[at:at + DRAWN_WORDS], own[at:at + DRAWN_WORDS], found, int(dropout * (1 << 32))))
    ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    cuts = np.cumsum(sizes)[[0, *ends]].tolist()
    return [ids[start:end].tobytes() for start, end in zip(cuts[:-1], cuts[1:], strict=True)]


def _in_turn(texts: pa.Array, names: pa.Array, path: str, dropout: float, seed: int):
    """Ids of 512 texts at a time; None for null."""
    for at in range(0, len(texts), 512):
        some = texts.slice(at, 512).to_pylist()
        found = encoded([t or "" for t in some], names.slice(at, 512).to_pylist(), path, dropout, seed)
        yield [None if t is None else ids for t, ids in zip(some, found, strict=True)]


def ids_of(text: Column, name: Column, path: str, dropout: float = 0.1, seed: int = 0) -> Column:
    """Ids of whole texts as binary (little-endian unsigned 32-bit); null for null.

    With dropout 0 these are the model's own ids. Every word is drawn
    for by `name` (of the document), its place and `seed`; the same three give the
    same ids. A mark
    (U+2581) in a text is encoded by its bytes, as it could not be told from a
    space again. Nothing that is special is added or recognised.
    """
    @F.arrow_udf(T.BinaryType())
    def encode(texts: pa.Array, names: pa.Array) -> pa.Array:
        return pa.array((ids for some in _in_turn(texts, names, path, dropout, seed) for ids in some), pa.binary())

    return encode(text, name.cast("string"))


def decoded(ids: bytes, vocabulary: Vocabulary) -> bytes:
    """The text of ids in UTF-8."""
    pieces, out = np.frombuffer(ids, dtype="<u4"), []
    for at in range(0, len(pieces), DRAWN_WORDS):
        some = pieces[at:at + DRAWN_WORDS]
        out.append(vocabulary.letters[_runs(vocabulary.letter_starts[some], vocabulary.letter_counts[some])].tobytes())
    return b"".join(out)[1:]


def text_of(ids: Column, path: str) -> Column:
    """The text of ids as `ids_of` gives them, for any dropout; null for null."""
    @F.arrow_udf(T.BinaryType())
    def decode(batch: pa.Array) -> pa.Array:
        vocabulary = _loaded(path)[0]
        return pa.array((None if i is None else decoded(i, vocabulary) for i in batch.to_pylist()), pa.binary())

    return decode(ids).cast("string")


def with_dropped_merges(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", dropout: float = 0.1, seed: int = 0,
) -> DataFrame:
    """One row per input row: id_col, text, ids, decoded.

    Null text counts as empty and has no ids. Rows repeated in full have equal
    ids; a null id is a name of its own. Extra columns are left out.
    """
    slim = on_workers(df).select(column(id_col).alias("id"), F.coalesce(column(text_col), F.lit("")).alias("text"))

    # In one function: a decoder over `ids_of` would have the planner call that for each of the two columns.
    @F.arrow_udf("ids binary, decoded binary")
    def both(texts: pa.Array, names: pa.Array) -> pa.Array:
        ids = [i for some in _in_turn(texts, names, path, dropout, seed) for i in some]
        vocabulary = _loaded(path)[0]
        return pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array((decoded(i, vocabulary) for i in ids), pa.binary())], ["ids", "decoded"])

    coded = slim.select("*", both(F.col("text"), F.col("id").cast("string")).alias("coded"))
    return coded.select(F.col("id").alias(id_col), "text", "coded.ids", F.col("coded.decoded").cast("string").alias("decoded"))
