"""A gated recurrent network over word slots, in numpy.

Slots are the outputs: frequent words and groups of the others. They are dealt into
classes of equal number by frequency, and a slot's probability is that of its class
times that within the class, each from the state of the network.

Documents are laid end to end on lanes that advance together, a step of all lanes
being one batch. The state is set to zero where a document begins and carried over
everything else, so a document of any length is scored whole. Training goes back
over windows of fixed length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np

HIDDEN = 16
CLASSES = 32
WIDTH = 32
SLOTS = CLASSES * WIDTH
START = SLOTS  # the input at the start of a document
WINDOW = 16
# Lanes at most; to learn, so many that about STEPS windows come of the documents given.
LANES = 512
LEAST_LANES = 32
STEPS = 512
RATE = 0.008
SEED = 5
# Logits below this in size have powers of e, and sums of them, that 32-bit numbers hold.
SAFE = 60.0

SHAPES = {
    "table": (SLOTS + 1, 3 * HIDDEN),
    "recurrent": (HIDDEN, 3 * HIDDEN),
    "recurrent_bias": (HIDDEN,),
    "class_weight": (HIDDEN, CLASSES),
    "class_bias": (CLASSES,),
    "word_weight": (CLASSES, HIDDEN, WIDTH),
    "word_bias": (CLASSES, WIDTH),
}
Model = dict[str, np.ndarray]


def pack(model: Model) -> np.ndarray:
    return np.concatenate([model[name].ravel() for name in SHAPES])


def unpack(flat: np.ndarray) -> Model:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def new_model(mass: np.ndarray) -> Model:
    """A model that gives every slot its share of `mass`, whatever came before."""
    draw = np.random.default_rng(SEED)
    share = (mass.reshape(CLASSES, WIDTH) + 1e-6) / (mass.sum() + SLOTS * 1e-6)
    model = {name: np.zeros(shape, np.float32) for name, shape in SHAPES.items()}
    for name, scale in (("table", 0.3), ("recurrent", HIDDEN**-0.5), ("class_weight", 0.05), ("word_weight", 0.05)):
        model[name] = (scale * draw.standard_normal(SHAPES[name])).astype(np.float32)
    model["table"][:, :HIDDEN] += 1.0  # states last for some words from the start
    model["class_bias"] = np.log(share.sum(1)).astype(np.float32)
    model["word_bias"] = np.log(share / share.sum(1, keepdims=True)).astype(np.float32)
    return model


class Lanes:
    """Documents of slots, laid on lanes."""

    def __init__(self, documents: list[np.ndarray], lanes: int = LANES):
        """`documents`: the slots of each, none empty."""
        loads = [(0, lane) for lane in range(min(lanes, len(documents)))]
        on_lane: list[list[int]] = [[] for _ in loads]
        for k in sorted(range(len(documents)), key=lambda k: -len(documents[k])):
            load, lane = heapq.heappop(loads)
            on_lane[lane].append(k)
            heapq.heappush(loads, (load + len(documents[k]), lane))
        on_lane.sort(key=lambda own: -sum(len(documents[k]) for k in own))
        self.order = [k for own in on_lane for k in own]
        sizes = np.array([len(documents[k]) for k in self.order], np.int64)
        self.offsets = np.cumsum(sizes) - sizes
        self.targets = np.concatenate([documents[k] for k in self.order]).astype(np.int32)
        self.inputs = np.empty_like(self.targets)
        self.inputs[1:] = self.targets[:-1]
        self.inputs[self.offsets] = START
        self.lengths = np.array([sum(len(documents[k]) for k in own) for own in on_lane])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def windows(self) -> Iterator[np.ndarray]:
        """Places (time x lane) in the flat arrays; -1 behind the end of a lane."""
        for begin in range(0, int(self.lengths[0]), WINDOW):
            active = int(np.searchsorted(-self.lengths, -begin, "left"))
            time = begin + np.arange(min(WINDOW, self.lengths[0] - begin))[:, None]
            yield np.where(time < self.lengths[:active], self.starts[:active] + time, -1)


def _recur(model: Model, inputs: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
    """States after each step of a window, and what going back needs."""
    h = HIDDEN
    table, recurrent, bias = model["table"], model["recurrent"], model["recurrent_bias"]
    steps, lanes = inputs.shape
    states = np.empty((steps + 1, lanes, h), np.float32)
    gates = np.empty((steps, lanes, 2 * h), np.float32)
    candidates = np.empty((steps, lanes, h), np.float32)
    pulls = np.empty((steps, lanes, h), np.float32)
    keep = (inputs != START).astype(np.float32)[:, :, None]
    states[0] = state
    given = table[inputs]
    for t in range(steps):
        before = states[t]
        before *= keep[t]
        pushed = before @ recurrent
        gate = gates[t]
        np.add(given[t, :, : 2 * h], pushed[:, : 2 * h], out=gate)
        gate *= 0.5
        np.tanh(gate, out=gate)
        gate *= 0.5
        gate += 0.5
        np.add(pushed[:, 2 * h :], bias, out=pulls[t])
        new = candidates[t]
        np.multiply(gate[:, h:], pulls[t], out=new)
        new += given[t, :, 2 * h :]
        np.tanh(new, out=new)
        np.subtract(before, new, out=states[t + 1])
        states[t + 1] *= gate[:, :h]
        states[t + 1] += new
    return states, (gates, candidates, pulls, keep)


def _bounded(weight: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no logit of these outputs is large, as no state is beyond -1 and 1."""
    return bool((np.abs(weight).sum(-2) + np.abs(bias)).max() < SAFE)


def _softmax(logits: np.ndarray, learn: bool, bounded: bool) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities (only to learn) and log normalisers of rows, in place. The greatest
    of each row is looked for, which takes long, only where logits may be large."""
    top = np.float32(0)
    if not bounded:
        top = logits.max(1)
        logits -= top[:, None]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], np.float32)
    if learn:
        logits /= total[:, None]
    return logits, np.log(total) + top


def _outputs(model: Model, states: np.ndarray, targets: np.ndarray, learn: bool) -> tuple:
    """Log probabilities of the targets; to learn, also the gradients of their sum, negated."""
    n = len(targets)
    kind, place = targets // WIDTH, targets % WIDTH
    logits = states @ model["class_weight"] + model["class_bias"]
    rows = np.arange(n)
    chosen = logits[rows, kind]
    p, norm = _softmax(logits, learn, _bounded(model["class_weight"], model["class_bias"]))
    logp = chosen - norm
    order = np.argsort(kind.astype(np.int16), kind="stable")
    ends = np.cumsum(np.bincount(kind, minlength=CLASSES))
    sorted_states, sorted_place = states[order], place[order]
    within = np.empty(n, np.float32)
    grads: Model = {}
    if learn:
        p[rows, kind] -= 1
        grads["class_weight"], grads["class_bias"] = states.T @ p, p.sum(0)
        d_states = p @ model["class_weight"].T
        d_sorted = np.empty_like(sorted_states)
        grads["word_weight"] = np.zeros_like(model["word_weight"])
        grads["word_bias"] = np.zeros_like(model["word_bias"])
    bounded = _bounded(model["word_weight"], model["word_bias"])
    begin = 0
    for c, end in enumerate(ends.tolist()):
        if end > begin:
            own, at = sorted_states[begin:end], sorted_place[begin:end]
            logits = own @ model["word_weight"][c] + model["word_bias"][c]
            here = np.arange(end - begin)
            chosen = logits[here, at]
            p, norm = _softmax(logits, learn, bounded)
            within[begin:end] = chosen - norm
            if learn:
                p[here, at] -= 1
                grads["word_weight"][c], grads["word_bias"][c] = own.T @ p, p.sum(0)
                d_sorted[begin:end] = p @ model["word_weight"][c].T
            begin = end
    logp[order] += within
    if learn:
        d_states[order] += d_sorted
        return logp, grads, d_states
    return logp, grads, None


def _back(model: Model, inputs: np.ndarray, states: np.ndarray, kept: tuple, d_states: np.ndarray, grads: Model) -> None:
    """Add the gradients of the recurrent part, from those of the states of a window."""
    h = HIDDEN
    gates, candidates, pulls, keep = kept
    steps, lanes = inputs.shape
    d_given = np.empty((steps, lanes, 3 * h), np.float32)
    d_pushed = np.empty((steps, lanes, 3 * h), np.float32)
    carried = np.zeros((lanes, h), np.float32)
    back = np.ascontiguousarray(model["recurrent"].T)
    z, r, new = gates[:, :, :h], gates[:, :, h:], candidates
    # What the gradients are multiplied by does not depend on them: made for all steps at once.
    by_new = (1 - z) * (1 - new * new)
    by_z = (states[:-1] - new) * z * (1 - z)
    by_r = pulls * r * (1 - r)
    for t in range(steps - 1, -1, -1):
        d = d_states[t] + carried
        given, pushed = d_given[t], d_pushed[t]
        d_new = np.multiply(d, by_new[t], out=given[:, 2 * h :])
        np.multiply(d, by_z[t], out=pushed[:, :h])
        np.multiply(d_new, by_r[t], out=pushed[:, h : 2 * h])
        np.multiply(d_new, r[t], out=pushed[:, 2 * h :])
        carried = pushed @ back
        d *= z[t]
        carried += d
        carried *= keep[t]
    d_given[:, :, : 2 * h] = d_pushed[:, :, : 2 * h]
    grads["recurrent"] = states[:-1].reshape(-1, h).T @ d_pushed.reshape(-1, 3 * h)
    grads["recurrent_bias"] = d_pushed[:, :, 2 * h :].sum((0, 1))
    flat, d_rows = inputs.ravel(), d_given.reshape(-1, 3 * h)
    order = np.argsort(flat.astype(np.int16), kind="stable")  # of short numbers it takes no comparisons
    first = np.flatnonzero(np.r_[True, np.diff(flat[order]) > 0])
    grads["table"] = (flat[order][first], np.add.reduceat(d_rows[order], first, axis=0))


class Learner:
    """Adam on windows; of the table only the rows that a window uses are changed."""

    def __init__(self, model: Model):
        self.model = {name: value.copy() for name, value in model.items()}
        self.mean = {name: np.zeros_like(value) for name, value in model.items()}
        self.square = {name: np.zeros_like(value) for name, value in model.items()}
        self.steps = 0

    def _change(self, name: str, rows: slice | np.ndarray, gradient: np.ndarray, share: float) -> None:
        mean = self.mean[name][rows] * 0.9 + 0.1 * gradient
        square = self.square[name][rows] * 0.99 + 0.01 * gradient * gradient
        self.mean[name][rows], self.square[name][rows] = mean, square
        fix = share * RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps)
        self.model[name][rows] -= (fix * mean / (np.sqrt(square) + 1e-6)).astype(np.float32)

    def learn(self, documents: list[np.ndarray]) -> int:
        """Learn from every window of `documents`, none empty; the tokens that gave a gradient."""
        seen = 0
        width = sum(map(len, documents)) // (WINDOW * STEPS)
        width = min(LANES, max(LEAST_LANES, width))
        lanes = Lanes(documents, width)
        state = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
        for at in lanes.windows():
            state = state[: at.shape[1]]
            there = at >= 0
            inputs = np.where(there, lanes.inputs[at], START)
            states, kept = _recur(self.model, inputs, state)
            state = states[-1].copy()
            self.steps += 1
            _, grads, d = _outputs(self.model, states[1:][there], lanes.targets[at[there]], True)
            d_states = np.zeros(there.shape + (HIDDEN,), np.float32)
            d_states[there] = d
            _back(self.model, inputs, states, kept, d_states, grads)
            # A window of few lanes tells little and moves the weights little.
            seen += int(there.sum())
            share = there.sum() / (width * WINDOW)
            scale = np.float32(1 / max(1, there.sum()))
            rows, values = grads.pop("table")
            for name, rows, gradient in (*((n, slice(None), g) for n, g in grads.items()), ("table", rows, values)):
                self._change(name, rows, gradient * scale, share)
        return seen


def log_probabilities(model: Model, documents: list[np.ndarray]) -> np.ndarray:
    """The natural log probability of each whole document's slots, none empty."""
    if not documents:
        return np.zeros(0)
    lanes = Lanes(documents)
    found = np.empty(len(lanes.targets))
    state = np.zeros((len(lanes.lengths), HIDDEN), np.float32)
    for at in lanes.windows():
        there = at >= 0
        inputs = np.where(there, lanes.inputs[at], START)
        states, _ = _recur(model, inputs, state[: at.shape[1]])
        state = states[-1].copy()
        places = at[there]
        found[places] = _outputs(model, states[1:][there], lanes.targets[places], False)[0]
    out = np.empty(len(documents))
    out[lanes.order] = np.add.reduceat(found, lanes.offsets)
    return out
