"""A small gated recurrent language model in numpy.

Words are ranked by training count; rank ranges of about equal mass are the
classes, the last class is for words outside the ranking. The probability of a
word is that of its class, a softmax over the state, times that of the word in
its class: a softmax over the state too for the classes of the ``own`` most
frequent words, the training frequency for the others. Before any training the
model is the unigram distribution.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

HIDDEN = 24
CLASSES = 64
OWN = 4096
WINDOW = 24  # steps of truncated backpropagation
SCORE_WINDOW = 32
TRAIN_LANES, SCORE_LANES = 512, 256
#: Logits made at a time, so that they stay in the cache.
PIECE = 32_768
#: Words in a window that make a whole step; fewer make a smaller one.
FULL_STEP = 2304
#: Training cuts documents longer than this and than an even lane, so that all lanes end together.
SEGMENT = 512


@dataclass
class Ranking:
    """Classes over words ranked by count; ``edges[c]:edges[c + 1]`` are the
    ranks of class c. The rank ``len(counts)`` stands for all other words."""

    counts: np.ndarray
    edges: np.ndarray
    own: int  # ranks below this have an output vector
    own_classes: int
    of_rank: np.ndarray
    class_log: np.ndarray  # log of the class masses
    word_log: np.ndarray  # log of the share in the class

    @staticmethod
    def of(counts: np.ndarray, other_mass: float) -> Ranking:
        counts = counts.astype(np.float64)
        share = np.cumsum(counts) / max(counts.sum(), 1.0)
        of_rank = np.minimum((share * (CLASSES - 1)).astype(np.int64), CLASSES - 2)
        edges = np.searchsorted(of_rank, np.arange(CLASSES))  # class CLASSES - 1 is the others'
        own_classes = int(np.searchsorted(edges, min(OWN, len(counts)), "right")) - 1
        mass = np.array([counts[a:b].sum() for a, b in zip(edges, edges[1:])] + [other_mass])
        smoothed = np.where(np.append(np.diff(edges) > 0, True), mass + 0.5, 1e-12)  # no word is in an empty class
        class_log = np.log(smoothed / smoothed.sum())
        word_log = np.append(np.log(np.maximum(counts, 1e-9) / np.maximum(mass[of_rank], 1e-9)), 0.0) if len(counts) else np.zeros(1)
        return Ranking(counts, edges, int(edges[own_classes]), own_classes, np.append(of_rank, CLASSES - 1), class_log, word_log)


def _shapes(own: int) -> list[tuple[str, tuple[int, ...]]]:
    h = HIDDEN
    return [
        ("e", (own + CLASSES, h)), ("wx", (h, 3 * h)), ("wh", (h, 3 * h)), ("b", (3 * h,)),
        ("oc", (h, CLASSES)), ("bc", (CLASSES,)), ("ow", (h, own)), ("bw", (own,)),
    ]


def unpack(flat: np.ndarray, own: int) -> dict[str, np.ndarray]:
    """Views into one flat vector."""
    out, at = {}, 0
    for name, shape in _shapes(own):
        size = int(np.prod(shape))
        out[name] = flat[at : at + size].reshape(shape)
        at += size
    return out


def fresh(ranking: Ranking, seed: int = 11) -> np.ndarray:
    flat = np.zeros(sum(int(np.prod(s)) for _, s in _shapes(ranking.own)), np.float32)
    p, rng = unpack(flat, ranking.own), np.random.default_rng(seed)
    p["e"][:] = rng.normal(0, 0.3, p["e"].shape)
    p["wx"][:] = rng.normal(0, 0.3, p["wx"].shape)
    p["wh"][:] = rng.normal(0, 0.2, p["wh"].shape)
    p["b"][HIDDEN : 2 * HIDDEN] = 1.0  # keep the state at first
    p["bc"][:] = ranking.class_log
    p["bw"][:] = ranking.word_log[: ranking.own]
    return flat


def lanes_of(docs: list[np.ndarray], width: int, start: int, window: int, widen: bool = False):
    """Deal whole documents to lanes and yield windows: inputs, targets,
    document numbers and 0/1 where a document begins (0: forget the state).
    All have the shape (steps, active lanes); lanes end at different times, the
    longest comes first, and a target of -1 is none. Widened windows take more
    steps where few lanes are left."""
    order = sorted(range(len(docs)), key=lambda i: -len(docs[i]))
    heap = [(0, lane, []) for lane in range(min(width, len(docs)))]
    for i in order:
        length, lane, held = heapq.heappop(heap)
        held.append(i)
        heapq.heappush(heap, (length + len(docs[i]), lane, held))
    lanes = sorted(((n, held) for n, _, held in heap), key=lambda x: -x[0])
    lengths = np.array([n for n, _ in lanes], np.int64)
    offsets, total, longest = np.cumsum(lengths) - lengths, int(lengths.sum()), int(lengths.max(initial=0))
    # lane after lane, and at last the place of no word
    order = [i for _, held in lanes for i in held]
    sizes = np.array([len(docs[i]) for i in order], np.int64)
    first = np.cumsum(sizes) - sizes
    targets, inputs, numbers = (np.full(total + 1, x, np.int32) for x in (-1, 0, 0))
    keep = np.ones(total + 1, np.float32)
    if order:
        np.concatenate([docs[i] for i in order], out=targets[:-1])
        inputs[1:-1] = targets[:-2]
        inputs[first], keep[first] = start, 0
        numbers[:-1] = np.repeat(np.array(order, np.int32), sizes)
    at, steps = 0, 0
    while (at := at + steps) < longest:
        active = int((lengths > at).sum())
        steps = min(window * (width // active) if widen else window, longest - at)
        step = np.arange(at, at + steps)[:, None]
        places = step + offsets[:active]
        if at + steps > lengths[active - 1]:  # some lanes end
            places[step >= lengths[:active]] = total
        yield inputs.take(places), targets.take(places), numbers.take(places), keep.take(places)


class _Trace:
    """What backpropagation needs of each step: the kept state before it, the
    gates r and z, the new state and its part from the state."""

    def __init__(self, steps: int, lanes: int):
        self.before, self.new, self.from_state = (np.empty((steps, lanes, HIDDEN), np.float32) for _ in range(3))
        self.gate = np.empty((steps, lanes, 2 * HIDDEN), np.float32)


class _Steps:
    """The states of fixed weights: steps in place, the gates of the input rows
    (negative, for 1 / (1 + exp(-x))) made once."""

    def __init__(self, p: dict[str, np.ndarray]):
        gates = p["e"] @ p["wx"] + p["b"]
        self.gates_in, self.new_in = -gates[:, : 2 * HIDDEN], gates[:, 2 * HIDDEN :].copy()
        self.gates_h, self.new_h = -p["wh"][:, : 2 * HIDDEN], p["wh"][:, 2 * HIDDEN :].copy()

    def __call__(self, rows: np.ndarray, keep: np.ndarray, h: np.ndarray, trace: _Trace | None = None) -> np.ndarray:
        """States after each step, with a last column of ones."""
        steps, lanes = rows.shape
        out = np.ones((steps, lanes, HIDDEN + 1), np.float32)
        gate, add = (np.empty((lanes, 2 * HIDDEN), np.float32) for _ in range(2))
        kept, new, from_state, add_new = (np.empty((lanes, HIDDEN), np.float32) for _ in range(4))
        begun = keep == 0
        begins = begun.any(axis=1).tolist()
        for t in range(steps):
            if trace is not None:
                kept, gate, new, from_state = trace.before[t], trace.gate[t], trace.new[t], trace.from_state[t]
            kept[:] = h
            if begins[t]:
                kept[begun[t]] = 0
            self.gates_in.take(rows[t], 0, gate, "clip")
            np.dot(kept, self.gates_h, out=add)
            gate += add
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.dot(kept, self.new_h, out=from_state)
            np.multiply(from_state, gate[:, :HIDDEN], out=new)
            self.new_in.take(rows[t], 0, add_new, "clip")
            new += add_new
            np.tanh(new, out=new)
            np.subtract(kept, new, out=add_new)
            add_new *= gate[:, HIDDEN:]
            h = np.add(add_new, new, out=out[t, :, :HIDDEN])
        return out


class _Softmax:
    """Logs of some columns' softmax, the last row of their weights being the
    bias: less a bound on all logits if ``bounded``."""

    def __init__(self, weights: np.ndarray, bounded: bool):
        self.weights, self.bounded = weights, bounded
        self.ones = np.ones(weights.shape[1], np.float32)

    @staticmethod
    def of(weights: np.ndarray, bias: np.ndarray, starts: np.ndarray) -> list[_Softmax]:
        """One for each slice of the columns. No state is above 1, so a bound on
        all logits stands in for each row's largest, unless that could lose digits."""
        reach = np.abs(weights).sum(axis=0)
        top = np.maximum.reduceat(bias + reach, starts)
        bounded = top - np.maximum.reduceat(bias - reach, starts) < 60
        ends = np.append(starts[1:], len(bias))
        less = np.repeat(np.where(bounded, top, np.float32(0)), ends - starts)
        both = np.vstack([weights, bias - less])
        return [_Softmax(both[:, a:b], k) for a, b, k in zip(starts.tolist(), ends.tolist(), bounded.tolist())]

    def __call__(self, states: np.ndarray, hit: np.ndarray, share: float | None = None):
        """The logs of the hits; with a share of the loss: the states' gradient
        and that of weights and bias too."""
        n = max(PIECE // len(self.ones), 128)
        if len(states) <= n:
            return self._piece(states, hit, share)
        parts = [self._piece(states[i : i + n], hit[i : i + n], share) for i in range(0, len(states), n)]
        if share is None:
            return np.concatenate(parts)
        logs, back, grads = zip(*parts)
        return np.concatenate(logs), np.concatenate(back), sum(grads)

    def _piece(self, states: np.ndarray, hit: np.ndarray, share: float | None):
        logits = states @ self.weights
        if not self.bounded:
            logits -= logits.max(axis=1, keepdims=True)
        flat, columns = logits.reshape(-1), logits.shape[1]
        at = np.arange(0, len(flat), columns)
        at += hit
        chosen = flat.take(at)
        np.exp(logits, out=logits)
        total = logits @ self.ones
        logs = chosen - np.log(total)
        if share is None:
            return logs
        logits *= (np.float32(share) / total)[:, None]
        flat[at] -= np.float32(share)
        return logs, logits @ self.weights[:-1].T, states.T @ logits


class _Logs:
    """Natural logs of words after states, for fixed weights."""

    def __init__(self, p: dict[str, np.ndarray], ranking: Ranking):
        self.ranking, edges = ranking, ranking.edges
        (self.classes,) = _Softmax.of(p["oc"], p["bc"], np.zeros(1, np.int64))
        filled = [c for c in range(ranking.own_classes) if edges[c + 1] > edges[c]]
        softmaxes = _Softmax.of(p["ow"], p["bw"], edges[filled]) if filled else []
        self.words = {c: (slice(edges[c], edges[c + 1]), x) for c, x in zip(filled, softmaxes) if edges[c + 1] - edges[c] > 1}

    def __call__(self, states: np.ndarray, targets: np.ndarray, grads: dict | None = None):
        """Places of the words (those of no target -1) and their logs; states
        have a column of ones. With grads: sets the gradients of the mean loss
        there and returns that of the states too."""
        ranking, targets = self.ranking, targets.ravel()
        at = np.flatnonzero(targets >= 0)
        cls = ranking.of_rank[targets[at]].astype(np.int8)
        # in the order of the classes, so that each is a slice
        order = np.argsort(cls, kind="stable")
        at, cls = at[order], cls[order].astype(np.int64)
        targets, states, places = targets[at], states.reshape(-1, HIDDEN + 1).take(at, 0), len(targets)
        ends = np.searchsorted(cls, np.arange(ranking.own_classes + 1))
        share, back = None if grads is None else 1 / len(targets), None
        logs = self.classes(states, cls, share)
        if grads is not None:
            logs, back, d = logs
            grads["oc"][:], grads["bc"][:] = d[:-1], d[-1]
        logs[ends[-1] :] += ranking.word_log[targets[ends[-1] :]]
        for c, (columns, softmax) in self.words.items():
            mine = slice(ends[c], ends[c + 1])
            if mine.start == mine.stop:
                continue
            found = softmax(states[mine], targets[mine] - columns.start, share)
            if grads is not None:
                found, d_states, d = found
                back[mine] += d_states
                grads["ow"][:, columns], grads["bw"][columns] = d[:-1], d[-1]
            logs[mine] += found
        if grads is None:
            return at, logs
        from_place = np.full(places, len(at))  # places of no word get the row of zeros
        from_place[at] = np.arange(len(at))
        return at, logs, np.vstack([back, np.zeros((1, HIDDEN), np.float32)]).take(from_place, 0)


class Model:
    def __init__(self, ranking: Ranking, flat: np.ndarray):
        self.ranking, self.flat = ranking, flat
        self.p = unpack(flat, ranking.own)
        # input row of a word: its own or that of its class
        self.row_of = np.append(np.arange(ranking.own), ranking.own + ranking.of_rank[ranking.own :])

    def score(self, docs: list[np.ndarray], start: int) -> np.ndarray:
        """log10 probability of each document (an array of ranks). The state is
        carried through all windows of a document."""
        sums = np.zeros(len(docs))
        states_of, logs_of = _Steps(self.p), _Logs(self.p, self.ranking)
        h = None
        for inputs, targets, numbers, keep in lanes_of(docs, SCORE_LANES, start, SCORE_WINDOW, widen=True):
            active = inputs.shape[1]
            h = np.zeros((active, HIDDEN), np.float32) if h is None else h[:active]
            states = states_of(self.row_of.take(inputs), keep, h)
            h = states[-1, :, :HIDDEN].copy()
            at, logs = logs_of(states, targets)
            sums += np.bincount(numbers.ravel()[at], logs, len(docs))
        return sums / np.log(10)

    def _steps_back(self, trace: _Trace, rows: np.ndarray, d_states: np.ndarray, keep: np.ndarray, grads: dict) -> None:
        """Sets the gradients of wh, b, wx and e; the products are made step by step, while its arrays are in the cache."""
        steps, lanes = rows.shape
        d = np.empty((lanes, 4 * HIDDEN), np.float32)  # of the new state, r, z and the new state's part from the state
        d_in, d_h = d[:, : 3 * HIDDEN], d[:, HIDDEN:]
        wx_back, wh_back = np.roll(self.p["wx"], HIDDEN, axis=1).T.copy(), self.p["wh"].T.copy()
        d_wx, d_wh, of_step = (np.zeros((HIDDEN, 3 * HIDDEN), np.float32) for _ in range(3))
        d_b, ones = np.zeros(3 * HIDDEN, np.float32), np.ones(lanes, np.float32)
        d_inputs, dh = np.empty((steps, lanes, HIDDEN), np.float32), np.zeros((lanes, HIDDEN), np.float32)
        one_less, dn, part, other = (np.empty((lanes, n), np.float32) for n in (2 * HIDDEN, HIDDEN, HIDDEN, HIDDEN))
        begun = keep == 0
        begins = begun.any(axis=1).tolist()
        for t in range(steps - 1, -1, -1):
            before, gate, new = trace.before[t], trace.gate[t], trace.new[t]
            np.subtract(1, gate, out=one_less)
            dh += d_states[t]
            # new state
            np.multiply(new, new, out=dn)
            np.subtract(1, dn, out=dn)
            dn *= dh
            dn *= one_less[:, HIDDEN:]
            d[:, :HIDDEN] = dn
            # gates; r (1 - r) and z (1 - z)
            np.multiply(dn, trace.from_state[t], out=part)
            np.subtract(before, new, out=other)
            other *= dh
            one_less *= gate
            np.multiply(part, one_less[:, :HIDDEN], out=d[:, HIDDEN : 2 * HIDDEN])
            np.multiply(other, one_less[:, HIDDEN:], out=d[:, 2 * HIDDEN : 3 * HIDDEN])
            np.multiply(dn, gate[:, :HIDDEN], out=d[:, 3 * HIDDEN :])
            dh *= gate[:, HIDDEN:]
            np.matmul(d_h, wh_back, out=part)
            dh += part
            if begins[t]:
                dh[begun[t]] = 0
            d_wh += np.matmul(before.T, d_h, out=of_step)
            self.p["e"].take(rows[t], 0, other, "clip")
            d_wx += np.matmul(other.T, d_in, out=of_step)
            d_b += ones @ d_in
            np.matmul(d_in, wx_back, out=d_inputs[t])
        grads["wh"][:], grads["b"][:], grads["wx"][:] = d_wh, np.roll(d_b, -HIDDEN), np.roll(d_wx, -HIDDEN, axis=1)
        places = rows.reshape(-1, 1) * HIDDEN + np.arange(HIDDEN)
        grads["e"][:] = np.bincount(places.ravel(), d_inputs.ravel(), grads["e"].size).reshape(-1, HIDDEN)

    def train(self, docs: list[np.ndarray], start: int, rate: float = 1e-2) -> int:
        """One pass of truncated backpropagation with Adam; the words seen. A
        window with few words left makes a small step."""
        longest = max(SEGMENT, sum(map(len, docs)) // TRAIN_LANES)
        docs = [d[i : i + longest] for d in docs for i in range(0, len(d), longest)]
        m, v, flat, change = (np.zeros_like(self.flat) for _ in range(4))
        grads = unpack(flat, self.ranking.own)
        p, seen, step, h = self.p, 0, 0, None
        for inputs, targets, _, keep in lanes_of(docs, TRAIN_LANES, start, WINDOW):
            active, rows = inputs.shape[1], self.row_of.take(inputs)
            h = np.zeros((active, HIDDEN), np.float32) if h is None else h[:active]
            trace = _Trace(len(rows), active)
            states = _Steps(p)(rows, keep, h, trace)
            h = states[-1, :, :HIDDEN].copy()
            flat[:] = 0
            at, _, d_states = _Logs(p, self.ranking)(states, targets, grads)
            self._steps_back(trace, rows, d_states.reshape(*rows.shape, HIDDEN), keep, grads)
            norm = np.sqrt(np.multiply(flat, flat, out=change).sum())
            if norm > 1:
                flat /= norm
            step += 1
            # Adam in place: m += 0.1 (g - m), v += 0.01 (g g - v)
            m *= 0.9
            m += np.multiply(flat, np.float32(0.1), out=change)
            v *= 0.99
            np.multiply(flat, flat, out=change)
            change *= 0.01
            v += change
            np.multiply(v, 1 / (1 - 0.99**step), out=change)
            np.sqrt(change, out=change)
            change += 1e-6
            np.divide(m, change, out=change)
            change *= rate * min(1.0, len(at) / FULL_STEP) / (1 - 0.9**step)
            self.flat -= change
            seen += len(at)
        return seen
