"""A gated recurrent language model in numpy, with words in classes."""

import heapq
import io
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: Word 0 stands for all words outside the vocabulary; word 1 ends a text and precedes its first word.
OTHER, END = 0, 1
#: Output weights stay within this, so that no exponential overflows.
LARGEST = 1.5
#: Weights that are moved at a time.
BLOCK = 1 << 14
#: Targets whose class is scored at a time.
ROWS = 1 << 10


def classes_of(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """First word of each class, for words by falling count: classes hold about
    the same mass of square roots of counts, so frequent words share small ones."""
    mass = np.cumsum(np.sqrt(counts + 1.0))
    cut = np.searchsorted(mass, mass[-1] * np.arange(n_classes) / n_classes)
    return np.unique(np.minimum(cut, len(counts) - 1))


def run_starts(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1]) if len(values) else np.zeros(0, np.int64)


def run_sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at starts. Most runs are short: these are summed
    all together, place by place; long ones each for itself."""
    sizes = np.diff(starts, append=len(rows))
    out, place, short = rows.take(starts, axis=0), 1, np.flatnonzero((sizes > 1) & (sizes <= 8))
    while len(short):
        out[short] += rows.take(starts[short] + place, axis=0)
        place += 1
        short = short[sizes[short] > place]
    for i in np.flatnonzero(sizes > 8).tolist():
        np.add.reduce(rows[starts[i]:starts[i] + sizes[i]], axis=0, out=out[i])
    return out


@dataclass
class Network:
    """G: what each input word adds to the gates. U: what the state adds. Wc, bc:
    classes. Ww, bw: words within their class."""

    G: np.ndarray
    U: np.ndarray
    Wc: np.ndarray
    bc: np.ndarray
    Ww: np.ndarray
    bw: np.ndarray
    first: np.ndarray

    @classmethod
    def new(cls, counts: np.ndarray, hidden: int, seed: int = 3) -> "Network":
        """Starts as the distribution of the counts of the whole corpus."""
        rng, first = np.random.default_rng(seed), classes_of(counts, int(np.ceil(np.sqrt(len(counts)))))
        log = np.log(counts + 1.0)
        share = np.log(np.add.reduceat(counts + 1.0, first) / (counts + 1.0).sum())
        spread = lambda *shape: rng.normal(0, 0.1, shape).astype(np.float32)
        return cls(
            spread(len(counts), 3 * hidden), spread(hidden, 3 * hidden), spread(hidden, len(first)), share.astype(np.float32),
            spread(len(counts), hidden), (log - log.max()).astype(np.float32), first)

    def arrays(self) -> list[np.ndarray]:
        return [self.G, self.U, self.Wc, self.bc, self.Ww, self.bw]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.arrays(), self.first)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Network":
        with np.load(io.BytesIO(data)) as stored:
            return cls(*(stored[name] for name in stored.files))

    def step(self, words: np.ndarray, h: np.ndarray):
        """State after reading a word in every lane, and what a window keeps of it."""
        states, back = self.steps(words[None], np.zeros((1, len(words)), bool), h.T)
        return states[0].T, back

    def steps(self, inputs: np.ndarray, new: np.ndarray, h: np.ndarray):
        """States after each step of a window that begins with state h, and what going back needs.

        A lane is a column here (units by lanes), so the rows of a gate lie end to end. With the gates'
        rows negated beforehand, their exponentials need no step of their own for the sign.
        """
        n, (length, width) = len(self.U), inputs.shape
        u, x = self.U.T.copy(), np.ascontiguousarray(self.G.take(inputs, axis=0).transpose(0, 2, 1))
        np.negative(u[:2 * n], out=u[:2 * n])
        np.negative(x[:, :2 * n], out=x[:, :2 * n])
        a, gates = np.empty((length, 3 * n, width), np.float32), np.empty((length, 2 * n, width), np.float32)
        before, fresh, states = (np.empty((length, n, width), np.float32) for _ in range(3))
        views = zip(new.any(axis=1).tolist(), new, x[:, :2 * n], x[:, 2 * n:], a, a[:, :2 * n], a[:, 2 * n:], gates, gates[:, :n], gates[:, n:],
                    fresh, before, states, strict=True)
        for some, starts, x_gate, x_fresh, step, a_gate, a_fresh, gate, r, z, f, old, out in views:
            old[...] = h
            if some:
                old[:, starts] = 0
            u.dot(old, step)
            np.add(x_gate, a_gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.multiply(r, a_fresh, out=f)
            f += x_fresh
            np.tanh(f, out=f)
            h = np.subtract(old, f, out=out)
            h *= z
            h += f
        return states, (before, gates, fresh, a[:, 2 * n:])

    @cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray]:
        """Class of each word, words of each class."""
        sizes = np.diff(self.first, append=len(self.bw))
        return np.repeat(np.arange(len(sizes), dtype=np.int16 if len(sizes) < 1 << 15 else np.int32), sizes), sizes

    @cached_property
    def ends(self) -> list[tuple[int, int]]:
        """First word of each class and of the next."""
        first = self.first.tolist()
        return list(zip(first, [*first[1:], len(self.bw)], strict=True))

    def order(self, targets: np.ndarray):
        """Places of the targets by class, those of classes of one word first; these classes; and how many are of one word."""
        by_word, sizes = self.words
        classes = by_word.take(targets)
        alone = (sizes == 1).take(classes)
        order = np.argsort(np.where(alone, classes.dtype.type(-1), classes), kind="stable")  # short integers are sorted by radix
        return order, classes.take(order), int(np.count_nonzero(alone))

    def within(self, states: np.ndarray, targets: np.ndarray, classes: np.ndarray):
        """For targets by class, all of several words: their states with a 1 for the bias, the
        exponentials of all words of each one's class (end to end), where each one begins there,
        where its own word is and its logit, and for each class its number, the start and end of
        its targets and their exponentials (words by column)."""
        widths = self.words[1][classes]
        begin = np.cumsum(widths) - widths
        own = begin + targets - self.first[classes]
        flat = np.empty(int(widths.sum()), np.float32)
        states = np.concatenate([states, np.ones((len(states), 1), np.float32)], axis=1)
        weights, starts, groups, ends = np.concatenate([self.Ww, self.bw[:, None]], axis=1), run_starts(classes), [], self.ends
        at = begin[starts].tolist()
        for c, s, e, i, j in zip(classes[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(classes)], at, [*at[1:], len(flat)]):
            q = flat[i:j].reshape(e - s, -1)
            first, last = ends[c]
            states[s:e].dot(weights[first:last].T, q)
            groups.append((c, s, e, q))
        logits = flat[own]
        np.exp(flat, out=flat)
        return states, flat, begin, own, logits, groups

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's probability: its class, then the word in it."""
        order, classes, alone = self.order(targets)
        states, ones, found = states.take(order, axis=0), np.ones(len(self.first), np.float32), np.empty(len(targets), np.float32)
        for s in range(0, len(targets), ROWS):
            logits = states[s:s + ROWS] @ self.Wc
            logits += self.bc
            part = logits[np.arange(len(logits)), classes[s:s + ROWS]]
            found[s:s + ROWS] = part - np.log(np.exp(logits, out=logits) @ ones)
        if alone < len(targets):
            _, flat, begin, _, own, _ = self.within(states[alone:], targets[order[alone:]], classes[alone:])
            found[alone:] += own - np.log(np.add.reduceat(flat, begin))
        out = np.empty_like(found)
        out[order] = found
        return out


class Lanes:
    """Texts one after the other in parallel lanes, the fullest lane first.

    Lanes are kept end to end, so they take as much memory as their words; a
    window of steps is laid out when it is read.
    """

    def __init__(self, texts: list[np.ndarray], most: int):
        sizes = [len(t) + 1 for t in texts]
        loads, placed = [(0, lane) for lane in range(min(most, len(texts)))], [[] for _ in range(min(most, len(texts)))]
        for i in sorted(range(len(texts)), key=lambda i: -sizes[i]):
            load, lane = heapq.heappop(loads)
            placed[lane].append(i)
            heapq.heappush(loads, (load + sizes[i], lane))
        loads.sort(key=lambda x: -x[0])
        order = [i for _, lane in loads for i in placed[lane]]
        self.full = np.array([load for load, _ in loads], np.int64)
        self.begin = np.cumsum(self.full) - self.full
        self.steps = int(self.full.max(initial=0))
        total = int(self.full.sum())
        self.inputs, self.targets, self.text = np.full(total, END, np.int32), np.full(total, END, np.int32), np.empty(total, np.int32)
        at = 0
        for i in order:
            n = sizes[i]
            self.inputs[at + 1:at + n] = self.targets[at:at + n - 1] = texts[i]
            self.text[at:at + n] = i
            at += n

    def width(self, step: int) -> int:
        """Lanes in use."""
        return int(np.searchsorted(-self.full, -step, side="left"))

    def window(self, start: int, end: int):
        """Inputs, targets, text (-1: none) and whether a text starts, for the steps start to end of the lanes in use at its start."""
        lanes = self.width(start)
        steps = np.arange(start, min(end, self.steps))[:, None]
        inside = steps < self.full[:lanes]
        at = np.where(inside, self.begin[:lanes] + steps, 0)
        pick = lambda values, none: np.where(inside, values[at], np.int32(none))
        text = pick(self.text, -1)
        before = np.where(steps > 0, self.text[np.maximum(at - 1, 0)], np.int32(-2))
        return pick(self.inputs, END), pick(self.targets, END), text, text != np.where(inside, before, np.int32(-1))


def log_likelihoods(net: Network, texts: list[np.ndarray], lanes: int = 256, window: int = 64) -> np.ndarray:
    """Natural log-likelihood of each whole text, its end included. The state goes
    on from window to window and starts anew only with a text."""
    if not texts:
        return np.zeros(0)
    laid, total, n = Lanes(texts, lanes), np.zeros(len(texts)), len(net.U)
    h = np.zeros((n, len(laid.full)), np.float32)
    for at in range(0, laid.steps, window):
        inputs, targets, text, new = laid.window(at, at + window)
        states, _ = net.steps(inputs, new, h[:, :inputs.shape[1]])
        h, valid = states[-1], text.ravel() >= 0
        found = net.log_probabilities(states.transpose(0, 2, 1).reshape(-1, n)[valid], targets.ravel()[valid])
        total += np.bincount(text.ravel()[valid], found, minlength=len(texts))
    return total


class Trainer:
    """Truncated backpropagation: gradients go back through one window, the state goes on. Steps are Adagrad's."""

    def __init__(self, net: Network, rate: float = 0.1, window: int = 20, lanes: int = 128):
        self.net, self.rate, self.window, self.lanes = net, rate, window, lanes
        self.seen = [np.full(a.shape, 1e-2, np.float32) for a in net.arrays()]
        self.gradient = np.empty((len(net.bw), len(net.U) + 1), np.float32)

    def move(self, which: int, at, gradient: np.ndarray) -> None:
        array, seen = self.net.arrays()[which], self.seen[which]
        if not isinstance(at, slice):
            array[at], seen[at] = self.moved(array.take(at, axis=0), seen.take(at, axis=0), gradient)
            return
        array, seen, gradient = array.reshape(-1), seen.reshape(-1), gradient.reshape(-1)
        for part in range(0, len(gradient), BLOCK):  # what is worked on stays in the cache
            self.moved(array[part:part + BLOCK], seen[part:part + BLOCK], gradient[part:part + BLOCK])

    def moved(self, array: np.ndarray, seen: np.ndarray, gradient: np.ndarray):
        """The weights and what was seen, after a step of both in place; the gradient is used up."""
        if not np.vdot(gradient, gradient) <= 25:  # otherwise none is beyond 5
            np.clip(gradient, -5, 5, out=gradient)
        root = gradient * gradient
        seen += root
        np.sqrt(seen, out=root)
        gradient *= self.rate
        gradient /= root
        array -= gradient
        return array, seen

    def fit(self, texts: list[np.ndarray]) -> None:
        net, laid = self.net, Lanes(texts, self.lanes)
        n = len(net.U)
        h = np.zeros((n, len(laid.full)), np.float32)
        for at in range(0, laid.steps, self.window):
            inputs, targets, text, new = laid.window(at, at + self.window)
            length, width = inputs.shape
            states, back = net.steps(inputs, new, h[:, :width])
            h, valid = states[-1], text.ravel() >= 0
            states = states.transpose(0, 2, 1).reshape(-1, n)
            if valid.all():
                d_states = self.outputs(states, targets.ravel())
            else:
                d_states = np.zeros((length * width, n), np.float32)
                d_states[valid] = self.outputs(states[valid], targets.ravel()[valid])
            self.backward(back, new, np.ascontiguousarray(d_states.reshape(length, width, n).transpose(0, 2, 1)), inputs)

    def outputs(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Move the output weights; the gradient with respect to the states."""
        net, n, scale = self.net, states.shape[1], np.float32(1 / np.sqrt(max(1, len(targets))))
        order, classes, alone = net.order(targets)
        states, targets = states.take(order, axis=0), targets[order]
        # Not the exponentials are divided by their sums, but the narrower states and gradients.
        p = states @ net.Wc
        p += net.bc
        np.exp(p, out=p)
        sums = p @ np.ones(p.shape[1], np.float32)
        p[np.arange(len(p)), classes] -= sums
        part = scale / sums
        d_states = p @ net.Wc.T.copy()
        d_states *= part[:, None]
        gradient = self.gradient
        gradient.fill(0)  # without a gradient, a weight stays where it is
        if alone < len(targets):
            some, flat, begin, own, _, groups = net.within(states[alone:], targets[alone:], classes[alone:])
            sums = np.add.reduceat(flat, begin)
            flat[own] -= sums
            flat *= np.repeat(scale / sums, net.words[1][classes[alone:]])
            within = np.empty((len(some), n), np.float32)
            for c, s, e, q in groups:
                first, last = net.ends[c]
                q.dot(net.Ww[first:last], within[s:e])
                q.T.dot(some[s:e], gradient[first:last])
            d_states[alone:] += within
        self.move(2, slice(None), (states * part[:, None]).T @ p)
        self.move(3, slice(None), part @ p)
        self.move(4, slice(None), gradient[:, :n].copy())
        self.move(5, slice(None), gradient[:, n].copy())
        np.clip(net.Wc, -LARGEST, LARGEST, out=net.Wc)
        np.clip(net.Ww, -LARGEST, LARGEST, out=net.Ww)
        out = np.empty_like(d_states)
        out[order] = d_states
        return out

    def backward(self, back, new: np.ndarray, d_states: np.ndarray, inputs: np.ndarray) -> None:
        """Move the other weights; units by lanes, as in `Network.steps`."""
        net, (before, gates, fresh, a) = self.net, back
        n, (length, width) = len(net.U), inputs.shape
        d_a, d_fresh = np.empty((length, 3 * n, width), np.float32), np.empty((length, n, width), np.float32)
        # Whatever does not wait for the step after it, for all steps at once.
        r, z = gates[:, :n], gates[:, n:]
        rest = 1 - z
        into, closed, held = rest * (1 - fresh * fresh), a * (1 - r), (before - fresh) * rest
        held *= z
        closed *= r
        carried = None
        views = zip(*(v[::-1] for v in (d_states, d_a, d_a[:, :n], d_a[:, n:2 * n], d_a[:, 2 * n:], d_fresh, into, closed, held, r, z, new)),
                    new.any(axis=1)[::-1].tolist(), strict=True)
        for d, step, d_r, d_z, d_h, d_f, to, shut, hold, reset, keep, starts, some in views:
            if carried is not None:
                d += carried
            np.multiply(d, to, out=d_f)
            np.multiply(d_f, shut, out=d_r)
            np.multiply(d, hold, out=d_z)
            np.multiply(d_f, reset, out=d_h)
            d *= keep
            d += net.U.dot(step)
            carried = d
            if some:
                carried[:, starts] = 0
        rows = lambda values: np.ascontiguousarray(values.transpose(0, 2, 1)).reshape(length * width, -1)
        d_x = rows(d_a)
        self.move(1, slice(None), rows(before).T @ d_x)
        d_x[:, 2 * n:] = rows(d_fresh)
        words = inputs.ravel()
        order = np.argsort(words.astype(np.int16) if len(net.G) < 1 << 15 else words, kind="stable")
        words, d_x = words[order], d_x.take(order, axis=0)
        starts = run_starts(words)
        self.move(0, words[starts], run_sums(d_x, starts))
