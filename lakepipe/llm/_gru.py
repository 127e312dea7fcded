"""A gated recurrent language model in numpy: class-factored output, truncated backpropagation, carried state."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

LN10 = float(np.log(10))
#: Sum of squared gradients that AdaGrad starts with: the first steps stay below the rate.
SEEN = 1.0
#: Documents of more symbols are dealt to training lanes first.
LONG = 4096
#: So many windows of all lanes are laid out at a time.
WINDOWS = 16


@dataclass
class Layout:
    """Which class each output symbol is in.

    Symbols 0 .. n_words-1 are words with an output vector of their own, in ``n_word_classes`` classes of
    consecutive symbols; symbol n_words + t stands for tail class t, which the class softmax predicts as a
    whole.
    """

    n_words: int
    first: np.ndarray  # first symbol of each word class, and n_words at the end
    n_tails: int
    class_bias: np.ndarray
    word_bias: np.ndarray
    class_of: np.ndarray = field(init=False)

    def __post_init__(self):
        sizes = np.diff(self.first)
        self.class_of = np.concatenate([np.repeat(np.arange(len(sizes)), sizes),
                                        len(sizes) + np.arange(self.n_tails)]).astype(np.int32)

    @property
    def n_word_classes(self) -> int:
        return len(self.first) - 1

    @property
    def n_classes(self) -> int:
        return self.n_word_classes + self.n_tails


def make_layout(counts: np.ndarray, tail_mass: np.ndarray, n_classes: int) -> Layout:
    """Words by falling count in classes of about equal sums of root counts; biases are log shares."""
    n = len(counts)
    roots = np.cumsum(np.sqrt(counts)) if n else np.zeros(0)
    cut = np.searchsorted(roots, roots[-1] * np.arange(1, n_classes) / n_classes) + 1 if n else []
    first = np.unique(np.concatenate([[0], np.minimum(cut, n), [n]])).astype(np.int64)
    mass = np.concatenate([np.add.reduceat(counts, first[:-1]) if n else np.zeros(0), tail_mass]).astype(float)
    word = np.concatenate([np.log(counts[a:b] / counts[a:b].sum()) for a, b in zip(first, first[1:], strict=False)]
                          or [np.zeros(0)])
    return Layout(n, first, len(tail_mass), np.log(mass / mass.sum()).astype(np.float32), word.astype(np.float32))


def new_parameters(layout: Layout, hidden: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Small random recurrent weights; the output starts as the class and word shares of the corpus."""
    rng = np.random.default_rng(seed)
    f = np.float32
    return {"x": (rng.standard_normal((layout.n_words + layout.n_tails, 3 * hidden)) * 0.3).astype(f),
            "u": (rng.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(f),
            "wc": np.zeros((layout.n_classes, hidden), f), "bc": layout.class_bias[:, None].copy(),
            "ww": np.zeros((layout.n_words, hidden), f), "bw": layout.word_bias[:, None].copy()}


def deal(docs: list[np.ndarray], lanes: int) -> list[list[int]]:
    """Document numbers of each lane, the longest lane first: whole documents one after the other.

    Each document goes to the lane that is shortest so far, so none is cut; those over ``LONG`` symbols come first, the longest
    first, the others in the order given. So lanes end about together.
    """
    ends = [(0, lane) for lane in range(lanes)]
    dealt: list[list[int]] = [[] for _ in ends]
    for k in sorted((k for k, d in enumerate(docs) if len(d)), key=lambda k: min(0, LONG - len(docs[k]))):
        n, lane = ends[0]
        dealt[lane].append(k)
        heapq.heapreplace(ends, (n + len(docs[k]), lane))
    return sorted((x for x in dealt if x), key=lambda x: -sum(len(docs[k]) for k in x))


def joined(docs: list[np.ndarray], dealt: list[list[int]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(symbols, starts) of each lane."""
    symbols = [np.concatenate([docs[k] for k in x]) for x in dealt]
    starts = [np.zeros(len(s), bool) for s in symbols]
    for x, first in zip(dealt, starts, strict=True):
        first[np.cumsum([0, *(len(docs[k]) for k in x[:-1])])] = True
    return symbols, starts


def lanes_of(docs: list[np.ndarray], lanes: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(symbols, starts) of each lane that ``deal`` makes, the longest first."""
    return joined(docs, deal(docs, lanes))


def lane_windows(symbols: list[np.ndarray], starts: list[np.ndarray], window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(symbols, starts) [window, lanes not ended] of the lanes; -1 fills up the last window of a lane."""
    length = np.array([len(s) for s in symbols])
    block = window * WINDOWS
    for start in range(0, int(length[0]) if len(length) else 0, block):
        active = int((length > start).sum())
        ids, first = np.full((block, active), -1, np.int32), np.zeros((block, active), bool)
        for lane in range(active):
            piece = symbols[lane][start:start + block]
            ids[:len(piece), lane], first[:len(piece), lane] = piece, starts[lane][start:start + block]
        for at in range(0, min(block, int(length[0]) - start), window):
            left = int((length > start + at).sum())
            yield ids[at:at + window, :left], first[at:at + window, :left]


@dataclass
class Gates:
    """What a window's backward pass needs, [steps, hidden, lanes]: gates, candidates and their recurrent part."""

    z: np.ndarray
    r: np.ndarray
    c: np.ndarray
    gn: np.ndarray


def gate_weights(p: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Recurrent weights and inputs by gate; sigmoid(a) = 1 / (1 + exp(-a)): both gates' are negated."""
    u, inputs = p["u"].T.copy(), p["x"].T.copy()
    for w in (u, inputs):
        w[:2 * p["u"].shape[0]] *= -1
    return u, inputs


def run_window(weights: tuple[np.ndarray, np.ndarray], h: np.ndarray, ids: np.ndarray, starts: np.ndarray, keep: bool = False):
    """States [steps, hidden, lanes] before each symbol of a window, the state after it, and with ``keep`` the gates.

    Lanes come last, so that each gate of a step is one piece of memory. Where ``starts`` is set, a document starts:
    the state before its symbol is empty.
    """
    u, inputs = weights
    n, steps, lanes = u.shape[1], *ids.shape
    kind = u.dtype
    states, at = np.empty((steps, n, lanes), kind), np.maximum(ids, 0).astype(np.intp)
    kept = steps if keep else 1
    zr, c, g = (np.empty((kept, k * n, lanes), kind) for k in (2, 1, 3))
    begins = starts.any(1)
    for t in range(steps):
        k = t if keep else 0
        if begins[t]:
            h = h * ~starts[t]
        states[t] = h
        x, both, new = inputs.take(at[t], axis=1), zr[k], c[k]
        np.matmul(u, h, out=g[k])
        np.add(g[k, :2 * n], x[:2 * n], out=both)
        np.exp(both, out=both)
        both += 1
        np.divide(1, both, out=both)
        np.multiply(both[n:], g[k, 2 * n:], out=new)
        new += x[2 * n:]
        np.tanh(new, out=new)
        h = h - new
        h *= both[:n]
        h += new
    return states, h, Gates(zr[:, :n], zr[:, n:], c, g[:, 2 * n:]) if keep else None


def by_place(x: np.ndarray) -> np.ndarray:
    """[steps, k, lanes] as [k, steps * lanes]."""
    return x.transpose(1, 0, 2).reshape(x.shape[1], -1)


def backward(p: dict[str, np.ndarray], states: np.ndarray, gates: Gates, dstates: np.ndarray,
             starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients [3 * hidden, places] of the inputs and of the recurrent sums of a window, from those of its states."""
    steps, n, lanes = states.shape
    z, r, c = gates.z, gates.r, gates.c
    # all that does not depend on the gradient of the next state, for the whole window at once: factors of the
    # candidate's recurrent sum, of both gates and of the candidate's input, turned into gradients step by step
    d = np.empty((steps, 4, n, lanes), states.dtype)
    of_c = d[:, 3]
    np.multiply(1 - z, 1 - c * c, out=of_c)
    np.multiply(of_c, r, out=d[:, 0])
    d[:, 1] = (states - c) * z * (1 - z)
    np.multiply(d[:, 0], gates.gn * (1 - r), out=d[:, 2])
    dh, begins = np.zeros((n, lanes), states.dtype), starts.any(1)
    back = np.roll(p["u"], n, axis=1)
    for t in range(steps - 1, -1, -1):
        d[t] *= dh
        dh = dh * z[t]
        dh += back @ d[t, :3].reshape(3 * n, lanes)
        dh += dstates[t]
        if begins[t]:
            dh *= ~starts[t]
    d = by_place(d.reshape(steps, 4 * n, lanes))
    return d[n:], np.roll(d[:3 * n], -n, axis=0)


def sorted_symbols(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, symbols) of a window without what fills it up, by symbol: so classes and words are stretches."""
    flat = ids.reshape(-1)
    at = np.flatnonzero(flat >= 0)
    at = at[np.argsort(flat[at], kind="stable")]
    return at, flat[at]


def _with_ones(x: np.ndarray) -> np.ndarray:
    """One more row, of ones."""
    return np.concatenate([x, np.ones((1, x.shape[1]), x.dtype)])


#: Beyond e to this power, sums over the output could leave the range of 32-bit floats.
LARGE = 60.0


def _largest(weights: np.ndarray, bias: np.ndarray) -> float:
    """No logit is larger in size: states lie between -1 and 1."""
    return float((np.abs(weights).sum(1) + np.abs(bias[:, 0])).max(initial=0))


def _stretches(layout: Layout, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(first word, end, first place, end) of each word class among sorted symbols."""
    ends = np.searchsorted(ids, layout.first)
    return [(layout.first[c], layout.first[c + 1], ends[c], ends[c + 1]) for c in np.flatnonzero(np.diff(ends))]


def _log_share(weights: np.ndarray, hid: np.ndarray, mine: np.ndarray, shift: bool) -> np.ndarray:
    """Log softmax of one row of the logits ``weights @ hid`` per column."""
    logits = weights @ hid
    if shift:
        logits -= logits.max(0)
    own = logits[mine, np.arange(len(mine))]
    np.exp(logits, out=logits)
    return own - np.log(np.ones(len(logits), logits.dtype) @ logits)


def log_likelihood(p: dict, layout: Layout, hid: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural log of P(class) * P(word | class) of each column of ``hid`` [hidden, places], whose symbols are sorted."""
    hid = _with_ones(hid)
    out = _log_share(np.hstack([p["wc"], p["bc"]]), hid, layout.class_of[ids],
                     _largest(p["wc"], p["bc"]) > LARGE).astype(np.float64)
    weights, shift = np.hstack([p["ww"], p["bw"]]), _largest(p["ww"], p["bw"]) > LARGE
    for a, b, i, j in _stretches(layout, ids):
        if b - a > 1:
            out[i:j] += _log_share(weights[a:b], hid[:, i:j], ids[i:j] - a, shift)
    return out


def _expected(weights: np.ndarray, sums: np.ndarray, hid: np.ndarray, shift: bool, grad: np.ndarray) -> np.ndarray:
    """Mean output vector under the softmax of ``weights @ hid``, per column; adds the share of each row times ``hid`` to ``grad``.

    ``sums`` are the output vectors and a last row of ones: one product gives the weighted vectors and the sum
    to divide by.
    """
    e = weights @ hid
    if shift:
        e -= e.max(0)
    np.exp(e, out=e)
    mean = sums @ e
    of_sum = 1 / mean[-1]
    grad += e @ (hid * of_sum).T
    mean = mean[:-1]
    mean *= of_sum
    return mean


def output_gradient(p: dict, layout: Layout, hid: np.ndarray, ids: np.ndarray, grad: dict):
    """Gradient of ``hid`` [hidden, places] where symbols are sorted; adds those of the output to ``grad``."""
    hid = _with_ones(hid)
    of_class, of_word = (np.zeros((len(p[k]), len(hid)), hid.dtype) for k in ("wc", "ww"))
    dhid = _expected(np.hstack([p["wc"], p["bc"]]), _with_ones(p["wc"].T), hid, _largest(p["wc"], p["bc"]) > LARGE, of_class)
    weights, sums, shift = np.hstack([p["ww"], p["bw"]]), _with_ones(p["ww"].T), _largest(p["ww"], p["bw"]) > LARGE
    for a, b, i, j in _stretches(layout, ids):
        dhid[:, i:j] += _expected(weights[a:b], sums[:, a:b], hid[:, i:j], shift, of_word[a:b])
    # what occurred, less: sums by symbol, then by class
    first = np.flatnonzero(np.diff(ids, prepend=-1))
    touched = ids[first]
    occurred = np.add.reduceat(hid, first, axis=1)
    cls = layout.class_of[touched]
    from_class = np.flatnonzero(np.diff(cls, prepend=-1))
    of_class[cls[from_class]] -= np.add.reduceat(occurred, from_class, axis=1).T
    n = int(np.searchsorted(touched, layout.n_words))
    of_word[touched[:n]] -= occurred[:, :n].T
    own = p["wc"][cls]
    own[:n] += p["ww"][touched[:n]]
    dhid -= np.repeat(own.T, np.diff(first, append=len(ids)), axis=1)
    for k, b, g in (("wc", "bc", of_class), ("ww", "bw", of_word)):
        grad[k] += g[:, :-1]
        grad[b] += g[:, -1:]
    return dhid


@np.errstate(over="ignore")
def score(p: dict, layout: Layout, docs: list[np.ndarray], lanes: int = 256, window: int = 32) -> np.ndarray:
    """log10 probability of the symbols of each whole document."""
    total = np.zeros(len(docs))
    hidden = p["u"].shape[0]
    dealt = deal(docs, lanes)
    numbers = np.array([k for x in dealt for k in x], np.int64)
    # where each lane's document of the moment stands among the numbers
    now = np.cumsum([0, *map(len, dealt[:-1])]) - 1
    weights, h = gate_weights(p), np.zeros((hidden, len(dealt)), p["u"].dtype)
    for ids, starts in lane_windows(*joined(docs, dealt), window):
        lanes_left = ids.shape[1]
        states, h, _ = run_window(weights, h[:, :lanes_left], ids, starts)
        at, symbols = sorted_symbols(ids)
        logs = log_likelihood(p, layout, by_place(states).take(at, axis=1), symbols)
        document = now[:lanes_left] + np.cumsum(starts, axis=0)
        now = document[-1]
        total += np.bincount(numbers[document.reshape(-1)[at]], logs, len(docs))
    return total / LN10


@dataclass
class Progress:
    """What training carries from one call to the next: sums of squared gradients, how often each row was used, symbols of the largest window."""

    seen: dict[str, np.ndarray]
    used: dict[str, np.ndarray]
    widest: int = 1


def new_progress(p: dict[str, np.ndarray]) -> Progress:
    return Progress({k: np.full_like(v, SEEN) for k, v in p.items()}, {k: np.zeros(len(v)) for k, v in p.items()})


@np.errstate(over="ignore")
def train(p: dict, layout: Layout, docs: list[np.ndarray], lanes: int = 64, window: int = 64,
          rate: float = 0.1, progress: Progress | None = None) -> dict[str, np.ndarray]:
    """Truncated backpropagation over whole documents; returns how often each row of a parameter was used.

    Gradients stop at a window's start, the state itself is carried from window to window to a document's end. ``p`` changes in
    place, with AdaGrad rates that go on from ``progress``.
    """
    hidden = p["u"].shape[0]
    progress = progress or new_progress(p)
    seen, used = progress.seen, progress.used
    h = np.zeros((hidden, lanes), np.float32)
    for ids, starts in lane_windows(*lanes_of(docs, lanes), window):
        states, h, gates = run_window(gate_weights(p), h[:, :ids.shape[1]], ids, starts, True)
        at, flat = sorted_symbols(ids)
        grad = {k: np.zeros_like(p[k]) for k in ("wc", "bc", "ww", "bw")}
        hid = by_place(states)
        dstates = np.zeros_like(hid)
        dstates[:, at] = output_gradient(p, layout, hid.take(at, axis=1), flat, grad)
        dx, dgs = backward(p, states, gates, dstates.reshape(hidden, *ids.shape).transpose(1, 0, 2), starts)
        grad["u"] = hid @ dgs.T
        # by the largest window: a symbol in a window of few lanes counts no more than others
        progress.widest = max(progress.widest, len(at))
        scale = 1 / progress.widest ** 0.5
        first = np.flatnonzero(np.diff(flat, prepend=-1))
        touched, times = flat[first], np.diff(first, append=len(flat))
        gx = np.add.reduceat(dx.take(at, axis=1), first, axis=1).T * scale
        for k, g in grad.items():
            g *= scale
            seen[k] += g * g
            p[k] -= rate * g / np.sqrt(seen[k])
            used[k] += len(at) if k in ("u", "wc", "bc") else 0
        # every word of a class is trained whenever one of them occurs
        of_class = np.bincount(layout.class_of[touched], times, layout.n_classes)[:layout.n_word_classes]
        per_word = np.repeat(of_class, np.diff(layout.first))
        used["ww"] += per_word
        used["bw"] += per_word
        seen["x"][touched] += gx * gx
        p["x"][touched] -= rate * gx / np.sqrt(seen["x"][touched])
        used["x"][touched] += times
    return used
