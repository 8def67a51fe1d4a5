"""A gated recurrent network over word ids, with a class-factored softmax, in numpy.

The network reads the previous word (a start mark before the first) and predicts the class of
the next one from its state, then the word within its class. Words of a frequency band share
one class and one input; their place in the band is not the network's business. Documents
lie one after the other in lanes. Lanes are worked through in windows, and the state goes on
from window to window; only a start mark resets it, so a document of any length is read whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PARTS = ("embed", "inward", "inward_bias", "gates", "class_out", "class_bias", "word_out", "word_bias")
FIXED = ("class_bias", "word_bias")


@dataclass(frozen=True)
class Shape:
    """``words`` ids have an output of their own, ``bands`` ids after them only a class."""

    words: int
    bands: int
    per_class: int = 32
    hidden: int = 24

    @property
    def word_classes(self) -> int:
        return -(-self.words // self.per_class)

    @property
    def classes(self) -> int:
        return self.word_classes + self.bands

    @property
    def start(self) -> int:
        return self.words + self.bands

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, c = self.hidden, self.word_classes
        return {"embed": (self.start + 1, h), "inward": (h, 3 * h), "inward_bias": (3 * h,), "gates": (h, 3 * h),
                "class_out": (h, self.classes), "class_bias": (self.classes,),
                "word_out": (c, h, self.per_class), "word_bias": (c, self.per_class)}

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids < self.words, ids // self.per_class, ids - self.words + self.word_classes)


def initial(shape: Shape, word_weights: np.ndarray, band_weights: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Small random weights; the biases already give the unigram distribution of the weights."""
    r = np.random.default_rng(seed)
    p = {name: (r.standard_normal(size) * 0.1).astype(np.float32) for name, size in shape.sizes().items()}
    for name in ("class_out", "word_out"):
        p[name] *= 0.1
    p["inward_bias"][:] = 0
    padded = np.zeros(shape.word_classes * shape.per_class)
    padded[:shape.words] = word_weights
    grid = padded.reshape(-1, shape.per_class)
    with np.errstate(divide="ignore"):
        p["word_bias"] = np.maximum(np.log(grid), -1e9).astype(np.float32)  # no probability for the padding
        p["class_bias"] = np.log(np.concatenate([grid.sum(1), band_weights])).astype(np.float32)
    p["class_bias"] -= p["class_bias"].max()
    return p


def flat(params: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([params[name].ravel() for name in PARTS])


def unflat(values: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, size in ((n, shape.sizes()[n]) for n in PARTS):
        n = int(np.prod(size))
        out[name] = np.asarray(values[at:at + n], np.float32).reshape(size)
        at += n
    return out


# --- lanes -----------------------------------------------------------------------------

def lanes(docs: list[np.ndarray], count: int, start: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, targets (-1 beyond a lane's end), document numbers and lane lengths.

    Each document goes to the lane that is shortest so far, long ones first; lanes come back
    longest first.
    """
    import heapq

    heap = [(0, lane) for lane in range(min(count, len(docs)) or 1)]
    held: list[list[int]] = [[] for _ in heap]
    for number in sorted(range(len(docs)), key=lambda i: -len(docs[i])):
        length, lane = heapq.heappop(heap)
        held[lane].append(number)
        heapq.heappush(heap, (length + len(docs[number]), lane))
    length = {lane: n for n, lane in heap}
    order = sorted(range(len(held)), key=lambda lane: -length[lane])
    lengths = np.array([length[lane] for lane in order])
    shape = (int(lengths.max(initial=0)), len(order))
    x, y, d = np.full(shape, start), np.full(shape, -1), np.zeros(shape, np.int64)
    for column, lane in enumerate(order):
        at = 0
        for number in held[lane]:
            ids, to = docs[number], at + len(docs[number])
            y[at:to, column], d[at:to, column] = ids, number
            x[at + 1:to, column] = ids[:-1]
            at = to
    return x, y, d, lengths


# --- the network -----------------------------------------------------------------------

def _log_softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


def _gates(x: np.ndarray, a: np.ndarray, hidden: int) -> tuple[np.ndarray, np.ndarray]:
    """Update and reset gates side by side, and the candidate state."""
    both = x[:, :2 * hidden] + a[:, :2 * hidden]
    both *= 0.5
    np.tanh(both, out=both)
    both += 1
    both *= 0.5
    candidate = both[:, hidden:] * a[:, 2 * hidden:]
    candidate += x[:, 2 * hidden:]
    np.tanh(candidate, out=candidate)
    return both, candidate


def run_window(p: dict, shape: Shape, table: np.ndarray, x: np.ndarray, state: np.ndarray, trace: list | None = None):
    """States after every step of a window; ``table`` holds the inputs of the gates by id."""
    h, out = state, np.empty((*x.shape, shape.hidden), np.float32)
    fresh, inward = x == shape.start, table[x]
    some = fresh.any(1)
    for t in range(len(x)):
        if some[t]:
            h = h * ~fresh[t][:, None]
        a = h @ p["gates"]
        both, candidate = _gates(inward[t], a, shape.hidden)
        if trace is not None:
            trace.append((h, a, both, candidate))
        h = candidate + both[:, :shape.hidden] * (h - candidate)
        out[t] = h
    return out


def log_probabilities(p: dict, shape: Shape, states: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Natural log of class and, for words, of the word within it."""
    kind = shape.class_of(y)
    out = _log_softmax(states @ p["class_out"] + p["class_bias"])[np.arange(len(y)), kind].astype(np.float64)
    for c, at in _by_class(kind, shape):
        logs = _log_softmax(states[at] @ p["word_out"][c] + p["word_bias"][c])
        out[at] += logs[np.arange(len(at)), y[at] - c * shape.per_class]
    return out


def _by_class(kind: np.ndarray, shape: Shape):
    order = np.argsort(kind, kind="stable")
    edges = np.searchsorted(kind[order], np.arange(shape.word_classes + 1))
    for c in range(shape.word_classes):
        if edges[c] < edges[c + 1]:
            yield c, order[edges[c]:edges[c + 1]]


def inputs(p: dict) -> np.ndarray:
    return p["embed"] @ p["inward"] + p["inward_bias"]


def score(p: dict, shape: Shape, docs: list[np.ndarray], count: int = 256, steps: int = 32) -> np.ndarray:
    """Log probability of every document, its tokens read in order from start to end."""
    x, y, d, lengths = lanes(docs, count, shape.start)
    table, total = inputs(p), np.zeros(len(docs))
    state = np.zeros((x.shape[1], shape.hidden), np.float32)
    for at in range(0, len(x), steps):
        live = int(np.searchsorted(-lengths, -at, "left"))  # lanes that still have tokens
        states = run_window(p, shape, table, x[at:at + steps, :live], state[:live])
        state = states[-1]
        valid = y[at:at + steps, :live] >= 0
        logs = log_probabilities(p, shape, states[valid], y[at:at + steps, :live][valid])
        total += np.bincount(d[at:at + steps, :live][valid], logs, len(docs))
    return total


def gradients(p: dict, shape: Shape, x: np.ndarray, y: np.ndarray, state: np.ndarray):
    """Mean loss of a window, its gradients, and the last state. Nothing flows back beyond the
    window's start: the truncation of backpropagation through time."""
    trace: list = []
    states = run_window(p, shape, inputs(p), x, state, trace)
    valid = y >= 0
    o, goal = states[valid], y[valid]
    n, kind = max(1, len(goal)), shape.class_of(goal)
    g = {name: np.zeros_like(value) for name, value in p.items()}
    logs = _log_softmax(o @ p["class_out"] + p["class_bias"])
    loss = -float(logs[np.arange(len(goal)), kind].sum())
    wrong = np.exp(logs)
    wrong[np.arange(len(goal)), kind] -= 1
    wrong /= n
    g["class_out"], g["class_bias"] = o.T @ wrong, wrong.sum(0)
    back = wrong @ p["class_out"].T
    for c, at in _by_class(kind, shape):
        logs = _log_softmax(o[at] @ p["word_out"][c] + p["word_bias"][c])
        slot = goal[at] - c * shape.per_class
        loss -= float(logs[np.arange(len(at)), slot].sum())
        wrong = np.exp(logs)
        wrong[np.arange(len(at)), slot] -= 1
        wrong /= n
        g["word_out"][c], g["word_bias"][c] = o[at].T @ wrong, wrong.sum(0)
        back[at] += wrong @ p["word_out"][c].T
    outward = np.zeros_like(states)
    outward[valid] = back
    h, width = shape.hidden, x.shape[1]
    dx, da = (np.empty((*x.shape, 3 * h), np.float32) for _ in range(2))
    dh = np.zeros((width, h), np.float32)
    for t in range(len(x) - 1, -1, -1):
        before, a, both, candidate = trace[t]
        dh = dh + outward[t]
        z, r = both[:, :h], both[:, h:]
        dc = dh * (1 - z) * (1 - candidate ** 2)
        dz = dh * (before - candidate) * z * (1 - z)
        dr = dc * a[:, 2 * h:] * r * (1 - r)
        dx[t, :, :h], dx[t, :, h:2 * h], dx[t, :, 2 * h:] = dz, dr, dc
        da[t, :, :h], da[t, :, h:2 * h], da[t, :, 2 * h:] = dz, dr, dc * r
        dh = (dh * z + da[t] @ p["gates"].T) * (x[t] != shape.start)[:, None]
    dx, da, ids = dx.reshape(-1, 3 * h), da.reshape(-1, 3 * h), x.ravel()
    g["gates"] = np.concatenate([step[0] for step in trace]).T @ da
    g["inward"], g["inward_bias"] = p["embed"][ids].T @ dx, dx.sum(0)
    order = np.argsort(ids, kind="stable")
    seen, first = np.unique(ids[order], return_index=True)
    g["embed"][seen] = np.add.reduceat((dx @ p["inward"].T)[order], first)
    return loss / n, g, states[-1]


class Trainer:
    """Adam over windows of lanes. The output biases stay: they hold counts of all training rows,
    which a sample of them could only make worse."""

    def __init__(self, params: dict[str, np.ndarray], shape: Shape, rate: float):
        self.p = {k: v.copy() for k, v in params.items()}
        self.shape, self.rate, self.steps, self.tokens = shape, rate, 0, 0
        self.first, self.second = ({k: np.zeros_like(v) for k, v in params.items()} for _ in range(2))

    def read(self, docs: list[np.ndarray], count: int = 32, steps: int = 32) -> None:
        x, y, _, lengths = lanes(docs, count, self.shape.start)
        state = np.zeros((x.shape[1], self.shape.hidden), np.float32)
        for at in range(0, len(x), steps):
            live = int(np.searchsorted(-lengths, -at, "left"))
            _, g, state = gradients(self.p, self.shape, x[at:at + steps, :live], y[at:at + steps, :live], state[:live])
            self.update(g)
        self.tokens += int(lengths.sum())

    def update(self, g: dict[str, np.ndarray]) -> None:
        self.steps += 1
        norm = float(np.sqrt(sum(float((v * v).sum()) for v in g.values())))
        shrink = np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
        rate = np.float32(self.rate * np.sqrt(1 - 0.999 ** self.steps) / (1 - 0.9 ** self.steps))
        for name, value in g.items():
            if name in FIXED:
                continue
            value *= shrink
            self.first[name] += np.float32(0.1) * (value - self.first[name])
            self.second[name] += np.float32(0.001) * (value * value - self.second[name])
            self.p[name] -= rate * self.first[name] / (np.sqrt(self.second[name]) + np.float32(1e-8))
