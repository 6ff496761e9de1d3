"""The network: probabilities, state across windows, gradients."""

import sys
import tracemalloc

import numpy as np

from newsloom.llm.recurrent import Lanes, Network, Trainer, log_likelihoods, run_starts, run_sums

COUNTS = np.array([30, 10, 25, 20, 15, 9, 7, 5, 3, 2, 1, 1], dtype=float)
RNG = np.random.default_rng(5)
TEXTS = [RNG.integers(2, 12, n).astype(np.int32) for n in (0, 1, 7, 300, 41)]


def network():
    net = Network.new(COUNTS, 6)
    net.G *= 5
    return net


def one_by_one(net, text):
    h, total = np.zeros((1, 6), np.float32), 0.0
    for word, target in zip([1, *text], [*text, 1], strict=True):
        h, _ = net.step(np.array([word]), h)
        total += net.log_probabilities(h, np.array([target]))[0]
    return total


def test_probabilities_add_up():
    net, h = network(), RNG.normal(size=(1, 6)).astype(np.float32)
    assert np.isclose(np.exp(net.log_probabilities(np.repeat(h, 12, 0), np.arange(12))).sum(), 1, atol=1e-5)


def test_state_goes_on_over_windows():
    net = network()
    for lanes, window in ((1, 5), (3, 64), (256, 7)):
        assert np.allclose(log_likelihoods(net, TEXTS, lanes, window), [one_by_one(net, t) for t in TEXTS], rtol=1e-4)
    assert len(log_likelihoods(net, [])) == 0


def test_lanes_hold_every_word_once():
    laid = Lanes(TEXTS, 3)
    inputs, targets, places, starts = laid.window(0, laid.steps)
    for i, text in enumerate(TEXTS):
        step, lane = np.nonzero(places == i)
        assert len(set(lane)) == 1 and targets[step, lane].tolist() == [*text, 1] and inputs[step, lane].tolist() == [1, *text]
        assert starts[step, lane].tolist() == [True] + [False] * len(text)
    for at in range(0, laid.steps, 7):
        for whole, part in zip((inputs, targets, places, starts), laid.window(at, at + 7), strict=True):
            assert (whole[at:at + 7, :part.shape[1]] == part).all() and (places[at:at + 7, part.shape[1]:] == -1).all()


def test_a_very_long_text_costs_its_own_length():
    """Two million words beside 255 short texts."""
    texts = [np.full(2_000_000, 5, np.int32)] + [np.full(5, 3, np.int32)] * 255
    tracemalloc.start()
    laid = Lanes(texts, 256)
    inputs, targets, places, starts = laid.window(1_000_000, 1_000_064)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20 and inputs.shape == (64, 1) and (targets == 5).all()
    tracemalloc.stop()
    net = network()
    some = [np.full(30_000, 5, np.int32)] + texts[1:]
    tracemalloc.start()
    log_likelihoods(net, some)
    Trainer(net).fit(some)
    assert tracemalloc.get_traced_memory()[1] < 60 << 20
    tracemalloc.stop()


def test_gradients():
    """Without Adagrad's scaling, a step is the gradient of the mean log loss."""
    net = network()
    trainer, moves = Trainer(net, window=400, lanes=8), {}
    trainer.move = lambda which, at, g: moves.setdefault(which, []).append((at, g.copy()))
    text = [TEXTS[2]]
    trainer.fit(text)
    scale = 1 / np.sqrt(len(text[0]) + 1)
    for which, index in ((1, (2, 3)), (1, (4, 15)), (0, (1, 14)), (2, (3, 1)), (5, (6,))):
        array = net.arrays()[which]
        old, eps = array[index], 1e-2
        array[index] = old + eps
        up = log_likelihoods(net, text)[0]
        array[index] = old - eps
        down = log_likelihoods(net, text)[0]
        array[index] = old
        full = np.zeros_like(array)
        for at, g in moves[which]:
            full[at] += g
        assert np.isclose(full[index], -(up - down) / (2 * eps) * scale, rtol=0.05, atol=2e-3), which


def test_training_helps():
    net, texts = Network.new(COUNTS, 6), [np.tile(np.array([2, 3, 4, 5], np.int32), 20)] * 60
    before = log_likelihoods(net, texts[:1])[0]
    Trainer(net, lanes=8).fit(texts)
    assert log_likelihoods(net, texts[:1])[0] > before / 2
    again = Network.from_bytes(net.to_bytes())
    assert all((a == b).all() for a, b in zip(net.arrays(), again.arrays(), strict=True))


def test_weights_are_moved_once_a_window():
    """Not once a class."""
    net = network()
    trainer, moves = Trainer(net, window=10, lanes=4), []
    trainer.move = lambda which, at, g: moves.append(which)
    trainer.fit(TEXTS)
    windows = -(-Lanes(TEXTS, 4).steps // 10)
    assert len(net.first) > 1 and sorted(moves) == sorted([0, 1, 2, 3, 4, 5] * windows)


def test_sums_of_runs():
    for words in ([], [3], [0] * 40 + [1] + [2] * 8 + [5] * 9 + [7, 7, 9]):
        words, rows = np.array(words, np.int32), RNG.normal(size=(len(words), 4)).astype(np.float32)
        starts = run_starts(words)
        assert words[starts].tolist() == sorted(set(words.tolist()))
        assert np.allclose(run_sums(rows, starts), [rows[words == w].sum(axis=0) for w in words[starts]] or np.zeros((0, 4)), atol=1e-5)


def test_output_gradients_word_by_word():
    """Against the gradient of every target's class and word alone; classes of one word among them."""
    net = Network.new(np.array([300, 300, 40, 30, 20, 10, 5, 5, 2, 2, 1, 1], dtype=float), 6)
    trainer, moves = Trainer(net), {}
    trainer.move = lambda which, at, g: moves.update({which: g.copy()})
    states, targets = RNG.normal(size=(50, 6)).astype(np.float32), RNG.integers(0, 12, 50)
    d_states, scale = trainer.outputs(states, targets), 1 / np.sqrt(50)
    ends, want = [*net.first[1:], 12], [np.zeros(a.shape) for a in (states, net.Wc, net.bc, net.Ww, net.bw)]
    assert 1 in np.diff(net.first, append=12)
    for i, (h, word) in enumerate(zip(states, targets, strict=True)):
        k = int(np.searchsorted(net.first, word, side="right")) - 1
        of = slice(net.first[k], ends[k])
        p, q = np.exp(h @ net.Wc + net.bc), np.exp(net.Ww[of] @ h + net.bw[of])
        p, q = p / p.sum(), q / q.sum()
        p[k] -= 1
        q[word - net.first[k]] -= 1
        want[0][i] = net.Wc @ p + q @ net.Ww[of]
        want[1] += np.outer(h, p)
        want[2] += p
        want[3][of] += np.outer(q, h)
        want[4][of] += q
    for found, wanted in zip((d_states, moves[2], moves[3], moves[4], moves[5]), want, strict=True):
        assert np.allclose(found, wanted * scale, atol=1e-5)


def test_a_window_enters_no_function_for_each_class():
    """What a window costs beside its products: fewer functions of numpy, and steps, are entered than two for each class."""
    net = Network.new(np.sort(RNG.pareto(1, 8_000))[::-1] * 100, 4)
    texts, entered = [RNG.integers(0, 8_000, 99).astype(np.int32) for _ in range(40)], []
    trainer = Trainer(net, window=50, lanes=40)
    own = lambda code: "numpy" in code.co_filename or code.co_name in ("step", "move")
    sys.setprofile(lambda frame, event, arg: entered.append(frame.f_code.co_name) if event == "call" and own(frame.f_code) else None)
    try:
        trainer.fit(texts)
    finally:
        sys.setprofile(None)
    assert len(net.first) > 80 and 0 < len(entered) < 4 * len(net.first), len(entered)  # two windows
