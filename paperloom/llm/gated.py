"""A gated recurrent language model in numpy with a class-factored output softmax.

One gated layer reads the tokens before; the probability of the next token is that of its class times that
of the token within the class. Words are put into classes by frequency, such that frequent classes are small. Documents run
in parallel lanes: each lane is a chain of documents, worked through in windows of ``WINDOW`` steps with the
state carried from window to window and cleared where a document begins. Training unrolls one window back.
"""

from __future__ import annotations

import heapq
import math

import numpy as np

WINDOW = 32


def class_starts(counts: np.ndarray, classes: int) -> np.ndarray:
    """First token of each class, for tokens in falling order of ``counts``, then the number of tokens.

    Classes share out the square roots of the counts evenly.
    """
    share = np.cumsum(np.sqrt(counts + 1.0))
    which = np.minimum((share / share[-1] * classes).astype(np.int64), classes - 1)
    return np.append(np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))), len(counts))


def fresh_model(counts: np.ndarray, hidden: int = 24, classes: int = 64, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights for tokens ``0 .. len(counts) - 1`` in falling order of frequency; it predicts the frequencies at first."""
    random = np.random.default_rng(seed)
    size = len(counts)
    starts = class_starts(counts, classes)
    mass = np.add.reduceat(counts + 0.1, starts[:-1])
    normal = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
    return {
        "starts": starts, "read": normal(size + 1, 3 * hidden), "turn": normal(hidden, 3 * hidden),
        "turn_bias": np.zeros(hidden, np.float32), "class_w": np.zeros((hidden, len(mass)), np.float32),
        "class_b": np.log(mass / mass.sum()).astype(np.float32), "word_w": np.zeros((hidden, size), np.float32),
        "word_b": np.log(counts + 0.1).astype(np.float32),
    }


class Lanes:
    """Documents (arrays of tokens) as chains of about equal length, the longest first.

    With ``cut`` the chains are even: they are pieces of one long chain, so a document may go on in the next lane, where its
    tokens are read as before but from a cleared state. Otherwise every document lies in one lane as a whole.
    """

    def __init__(self, documents: list[np.ndarray], lanes: int, begin: int, cut: bool = False) -> None:
        lengths = np.array([len(d) for d in documents], np.int64)
        if cut:
            total = int(lengths.sum())
            count = max(1, min(lanes, total // WINDOW))
            order = list(range(len(documents)))
            edges = np.arange(count + 1) * total // count
            self.size = np.sort(np.diff(edges))[::-1]
        else:
            count = max(1, min(lanes, len(documents)))
            heap = [(0, i) for i in range(count)]
            chains: list[list[int]] = [[] for _ in range(count)]
            for number in np.argsort(-lengths, kind="stable").tolist():
                held, lane = heapq.heappop(heap)
                chains[lane].append(number)
                heapq.heappush(heap, (held + int(lengths[number]), lane))
            chains.sort(key=lambda chain: -sum(int(lengths[i]) for i in chain))
            order = [i for chain in chains for i in chain]
            self.size = np.array([sum(int(lengths[i]) for i in chain) for chain in chains], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.target = np.concatenate([documents[i] for i in order]) if order else np.empty(0, np.int32)
        self.document = np.repeat(np.array(order, np.int64), lengths[order]) if order else np.empty(0, np.int64)
        self.first = np.zeros(len(self.target), bool)
        self.first[(np.cumsum(lengths[order]) - lengths[order])[lengths[order] > 0]] = True
        self.source = np.empty_like(self.target)
        self.source[1:] = self.target[:-1]
        self.source[self.first] = begin

    def windows(self):
        """For each window: the places of every step, one array per step, over the lanes still running."""
        for begin in range(0, int(self.size.max(initial=0)), WINDOW):
            steps = []
            for t in range(begin, begin + WINDOW):
                running = int(np.searchsorted(-self.size, -t, "left"))
                if not running:
                    break
                steps.append(self.start[:running] + t)
            yield steps


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place; numbers so far below zero that their power has no finite value give 0."""
    np.negative(x, out=x)
    with np.errstate(over="ignore"):
        np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


#: Numbers up to this one can be raised to powers of e, and those of its negative summed, in single precision.
_SAFE = 80.0


def _powers(logits: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray | float]:
    """In place: ``logits`` less a shift per row, as powers of e, and the shift, which numbers within a safe ``reach`` need not have."""
    top = 0.0
    if reach > _SAFE:
        top = logits.max(axis=1)
        logits -= top[:, None]
    return np.exp(logits, out=logits), top


def _row_sums(x: np.ndarray) -> np.ndarray:
    return x @ np.ones(x.shape[1], x.dtype)


def _outputs(model: dict) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Weights of classes and of tokens with the bias as the last row, each with the largest size its logits can have (per class)."""
    both = [np.concatenate((model[f"{name}_w"], model[f"{name}_b"][None])) for name in ("class", "word")]
    # states lie between -1 and 1
    reach = [np.abs(weights).sum(axis=0) for weights in both]
    return both[0], float(reach[0].max()), both[1], np.maximum.reduceat(reach[1], model["starts"][:-1])


def _step(model: dict, state: np.ndarray, source: np.ndarray, keep: list | None) -> np.ndarray:
    hidden = state.shape[1]
    read = model["read"].take(source, axis=0).reshape(len(state), 3, hidden)
    # one block per gate, so that what follows runs over whole arrays
    turned = np.matmul(state, model["turn"].reshape(hidden, 3, hidden).transpose(1, 0, 2))
    gates, inner = turned[:2], turned[2]
    gates += read.transpose(1, 0, 2)[:2]
    update, reset = _sigmoid(gates)
    inner += model["turn_bias"]
    new = reset * inner
    new += read[:, 2]
    np.tanh(new, out=new)
    fall = state - new
    out = fall * update
    out += new
    if keep is not None:
        keep.append((state, source, update, reset, inner, new, fall))
    return out


def _by_class(starts: np.ndarray, target: np.ndarray):
    """Rows in the order of their targets' classes, the class of each, and (class, begin, end) for each class that occurs."""
    classes = np.repeat(np.arange(len(starts) - 1, dtype=np.int16), np.diff(starts)).take(target)
    order = np.argsort(classes, kind="stable")
    classes = classes[order]
    edges = np.searchsorted(classes, np.arange(len(starts), dtype=np.int16)).tolist()
    groups = [(c, edges[c], edges[c + 1]) for c in range(len(starts) - 1) if edges[c + 1] > edges[c]]
    return order, classes, groups


def _with_one(states: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Rows of ``states`` in an order, with a column of ones behind."""
    out = np.ones((len(order), states.shape[1] + 1), states.dtype)
    out[:, :-1] = states[order]
    return out


#: So many rows of logits are worked on at a time, few enough for the cache.
_ROWS = 2048


def _found(starts: np.ndarray, outputs: tuple, states: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The natural log-probability of each target after its state."""
    class_w, class_reach, word_w, word_reach = outputs
    order, classes, groups = _by_class(starts, target)
    states, target = _with_one(states, order), target[order]
    found = np.empty(len(target), np.result_type(states, class_w))
    for a in range(0, len(target), _ROWS):
        logits = states[a : a + _ROWS] @ class_w
        own = logits[np.arange(len(logits)), classes[a : a + _ROWS]]
        powers, top = _powers(logits, class_reach)
        found[a : a + _ROWS] = own - np.log(_row_sums(powers)) - top
    for c, begin, end in groups:
        words = word_w[:, starts[c] : starts[c + 1]]
        for a in range(begin, end, 4 * _ROWS):
            rows = slice(a, min(a + 4 * _ROWS, end))
            logits = states[rows] @ words
            own = logits[np.arange(len(logits)), target[rows] - starts[c]]
            powers, top = _powers(logits, word_reach[c])
            found[rows] += own - np.log(_row_sums(powers)) - top
    back = np.empty_like(found)
    back[order] = found
    return back


def log_likelihoods(model: dict, documents: list[np.ndarray], lanes: int = 512, together: int = 32_768) -> np.ndarray:
    """The natural log-probability of each whole document; tokens of several windows are looked up ``together``."""
    run = Lanes(documents, lanes, len(model["word_b"]))
    total = np.zeros(len(documents))
    state = np.zeros((len(run.size), model["turn"].shape[0]), np.float32)
    outputs = _outputs(model)
    places, states, held = [], [], 0

    def add():
        at = np.concatenate(places)
        found = _found(model["starts"], outputs, np.concatenate(states), run.target[at])
        total[:] += np.bincount(run.document[at], weights=found, minlength=len(documents))

    for steps in run.windows():
        for at in steps:
            now = state[: len(at)]
            now[run.first[at]] = 0
            state[: len(at)] = _step(model, now, run.source[at], None)
            states.append(state[: len(at)].copy())
            places.append(at)
            held += len(at)
        if held >= together:
            add()
            places, states, held = [], [], 0
    if places:
        add()
    return total


def _gap(logits: np.ndarray, target: np.ndarray, reach: float, scale: float) -> np.ndarray:
    """In place: probabilities minus the one-hot target, scaled."""
    powers = _powers(logits, reach)[0]
    powers *= (scale / _row_sums(powers))[:, None]
    powers[np.arange(len(target)), target] -= scale
    return powers


#: Tokens before this one are so frequent that a product with their places is cheaper than sorting them.
_OFTEN = 8
#: So many rows of each token are added side by side, the rest of them one after the other.
_LAYERS = 32


def _add_rows(out: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """``out[rows] += values``, where rows repeat."""
    often = min(_OFTEN, len(out))
    out[:often] += (rows == np.arange(often)[:, None]).astype(values.dtype) @ values
    order = np.argsort(rows.astype(np.uint16 if len(out) < 1 << 16 else np.int32), kind="stable")
    order = order[np.searchsorted(rows[order], often) :]
    rows = rows[order]
    heads = np.flatnonzero(np.concatenate(([True], rows[1:] != rows[:-1]))[: len(rows)])
    times = np.diff(np.append(heads, len(rows)))
    by_times = np.argsort(-times, kind="stable")
    heads, times = heads[by_times], times[by_times]
    sums = values.take(order[heads], axis=0)
    for layer in range(1, min(_LAYERS, int(times.max(initial=0)))):
        more = int(np.searchsorted(-times, -layer, "left"))
        sums[:more] += values.take(order[heads[:more] + layer], axis=0)
    out[rows[heads]] += sums
    late = [np.arange(h + _LAYERS, h + t) for h, t in zip(heads.tolist(), times[times > _LAYERS].tolist(), strict=False)]
    if late:
        sums = np.add.reduceat(values.take(order[np.concatenate(late)], axis=0), np.cumsum([0, *map(len, late)])[:-1], axis=0)
        out[rows[heads[: len(late)]]] += sums


def _gradients(model: dict, kept: list, places: list, run: Lanes, states: list) -> dict[str, np.ndarray]:
    """By truncated backpropagation through one window; what was kept of its steps is used up."""
    hidden, starts = model["turn"].shape[0], model["starts"]
    flat, outputs = np.concatenate(places), np.concatenate(states)
    class_w, class_reach, word_w, word_reach = _outputs(model)
    target = run.target[flat]
    order, classes, groups = _by_class(starts, target)
    outputs, target = _with_one(outputs, order), target[order]
    scale = np.float32(1 / len(target))
    class_grad, word_grad, sent = np.zeros_like(class_w), np.zeros_like(word_w), np.empty((len(target), hidden), class_w.dtype)
    for a in range(0, len(target), _ROWS):
        rows = slice(a, a + _ROWS)
        gap = _gap(outputs[rows] @ class_w, classes[rows], class_reach, scale)
        class_grad += outputs[rows].T @ gap
        sent[rows] = gap @ class_w[:-1].T
    for c, begin, end in groups:
        words, rows = slice(starts[c], starts[c + 1]), slice(begin, end)
        gap = _gap(outputs[rows] @ word_w[:, words], target[rows] - starts[c], word_reach[c], scale)
        word_grad[:, words] = outputs[rows].T @ gap
        sent[rows] += gap @ word_w[:-1, words].T
    back = np.empty_like(sent)
    back[order] = sent
    reads, edges = np.empty((len(flat), 3 * hidden), back.dtype), np.cumsum([0, *map(len, places)]).tolist()
    # gaps of the turned state: those of both gates, then that of the inner part
    turned, inward = np.empty((max(map(len, places)), 3 * hidden), back.dtype), np.ascontiguousarray(model["turn"].T)
    grad = {name: np.zeros_like(model[name]) for name in ("read", "turn", "turn_bias")}
    carried = np.zeros((0, hidden), back.dtype)
    for t in range(len(kept) - 1, -1, -1):
        state, _, update, reset, inner, new, fall = kept[t]
        out, read = back[edges[t] : edges[t + 1]], reads[edges[t] : edges[t + 1]]
        out[: len(carried)] += carried
        passed = out * update
        out -= passed
        fall *= passed
        np.subtract(1, update, out=update)
        np.multiply(fall, update, out=read[:, :hidden])
        new *= new
        np.subtract(1, new, out=new)
        out *= new
        inner_gap = out * reset
        inner *= inner_gap
        np.subtract(1, reset, out=reset)
        np.multiply(inner, reset, out=read[:, hidden : 2 * hidden])
        read[:, 2 * hidden :] = out
        gaps = turned[: len(state)]
        gaps[:, : 2 * hidden], gaps[:, 2 * hidden :] = read[:, : 2 * hidden], inner_gap
        grad["turn"] += state.T @ gaps
        grad["turn_bias"] += inner_gap.sum(axis=0)
        if t:
            carried = gaps @ inward
            carried += passed
            carried[run.first[places[t]]] = 0
    _add_rows(grad["read"], np.concatenate([step[1] for step in kept]), reads)
    return grad | {"class_w": class_grad[:-1], "class_b": class_grad[-1], "word_w": word_grad[:-1], "word_b": word_grad[-1]}


def _adam(weights: np.ndarray, first: np.ndarray, second: np.ndarray, grads: np.ndarray, number: int, pace: float) -> None:
    """One step of Adam in place, by pieces that stay in the cache; ``grads`` is used up."""
    for a in range(0, len(weights), 1 << 14):
        m, v, g = (x[a : a + (1 << 14)] for x in (first, second, grads))
        m *= 0.9
        m += 0.1 * g
        v *= 0.99
        g *= g
        g *= 0.01
        v += g
        np.sqrt(v, out=g)
        g *= 1 / math.sqrt(1 - 0.99**number)
        g += 1e-7
        np.divide(m, g, out=g)
        g *= pace / (1 - 0.9**number)
        weights[a : a + (1 << 14)] -= g


def train(model: dict, documents: list[np.ndarray], lanes: int = 64, rate: float = 0.01, last: float = 0.001) -> dict:
    """One pass over all tokens of the documents, in even lanes, with Adam; the learning rate falls from ``rate`` to ``last``."""
    run = Lanes(documents, lanes, len(model["word_b"]), cut=True)
    names = [name for name in model if name != "starts"]
    weights = np.concatenate([model[name].ravel() for name in names])
    edges = np.cumsum([0, *(model[name].size for name in names)])
    parts = zip(names, edges[:-1], edges[1:], strict=True)
    # the weights stay in one array, of which the model's are views
    model = model | {name: weights[a:b].reshape(model[name].shape) for name, a, b in parts}
    first, second, grads = (np.zeros_like(weights) for _ in range(3))
    state = np.zeros((len(run.size), model["turn"].shape[0]), np.float32)
    rounds = max(1, -(-int(run.size.max(initial=0)) // WINDOW))
    for number, steps in enumerate(run.windows(), 1):
        kept: list = []
        states = []
        for places in steps:
            now = state[: len(places)].copy()
            now[run.first[places]] = 0
            out = _step(model, now, run.source[places], kept)
            state[: len(places)] = out
            states.append(out)
        grad = _gradients(model, kept, steps, run, states)
        np.concatenate([grad[name].ravel() for name in names], out=grads)
        grads *= np.float32(min(1.0, 1.0 / max(math.sqrt(grads @ grads), 1e-9)))
        _adam(weights, first, second, grads, number, rate + (last - rate) * number / rounds)
    return model
