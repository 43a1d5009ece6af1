"""A small gated recurrent language model in numpy, with a class-factored output.

Words of the output list are in classes of ``CLASS`` words by frequency: the probability of
a word is that of its class times that of the word in its class. All other words fall into
tail classes by their last two bytes; within a tail class a word's probability is its share
of the class's smoothed corpus count, which the caller adds.

Input weights are folded into the embedding: one row per input, of three gates.
"""

from __future__ import annotations

import numpy as np

CLASS = 64
#: Documents that are run together, so that their states stay in a core's cache.
BLOCK = 1024
#: Rows whose logits are held at a time: products this small are done without packing.
ROWS = 512


class Net:
    """Parameters: input rows e, recurrent u, class weights c and cb, word weights w and wb."""

    NAMES = ("e", "u", "c", "cb", "w", "wb")

    def __init__(self, words: int, tails: int, hidden: int, seed: int = 5, vector: np.ndarray | None = None):
        self.lists = -(-max(words, 1) // CLASS)
        self.words, self.tails, self.hidden = words, tails, hidden
        self.start = self.lists * CLASS + tails  # the input before the first word
        random = np.random.default_rng(seed)
        draw = lambda *shape: random.normal(0, 0.1, shape).astype(np.float32)
        self.e, self.u = draw(self.start + 1, 3 * hidden), draw(hidden, 3 * hidden)
        self.c, self.cb = draw(hidden, self.lists + tails), np.zeros(self.lists + tails, np.float32)
        self.w, self.wb = draw(self.lists, hidden, CLASS), np.zeros((self.lists, CLASS), np.float32)
        # Places of the last list that hold no word.
        self.wb.reshape(-1)[words:] = -30
        if vector is not None:
            at = 0
            for name in self.NAMES:
                p = getattr(self, name)
                p[...] = vector[at : at + p.size].reshape(p.shape)
                at += p.size

    def vector(self) -> np.ndarray:
        return np.concatenate([getattr(self, n).ravel() for n in self.NAMES])

    def class_of(self, ids: np.ndarray) -> np.ndarray:
        """Class of an id; ids are words by frequency, then tails."""
        first = self.lists * CLASS
        return np.where(ids < first, ids // CLASS, ids - first + self.lists)

    def gates(self) -> tuple[np.ndarray, np.ndarray]:
        """Input rows and recurrent weights, by gate first: rows of their own are added several
        numbers at a time, parts of longer rows are not."""
        cut = lambda v: np.ascontiguousarray(v.reshape(len(v), 3, self.hidden).transpose(1, 0, 2))
        return cut(self.e), cut(self.u)

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural log of class and, for listed words, word in class."""
        classes = self.class_of(targets)
        softmax, out = Softmax(self.c, self.cb), np.empty(len(targets), states.dtype)
        for span in _spans(0, len(targets)):
            out[span] = softmax.chosen(states[span], classes[span])
        order, edges = self.by_list(classes)
        states, places = states.take(order, axis=0), targets[order] % CLASS
        within = np.empty(len(order), states.dtype)
        softmax = Softmax(self.w, self.wb)
        for k in np.flatnonzero(np.diff(edges)).tolist():
            for span in _spans(edges[k], edges[k + 1]):
                within[span] = softmax.chosen(states[span], places[span], k)
        out[order] += within
        return out

    def by_list(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of listed words by list, and where each list's rows begin and end."""
        order = np.argsort(classes.astype(np.int16) if self.lists + self.tails < 32768 else classes, kind="stable")
        edges = np.searchsorted(classes[order], np.arange(self.lists + 1))
        return order[: edges[-1]], edges


def _spans(begin: int, end: int) -> list[slice]:
    return [slice(at, min(at + ROWS, end)) for at in range(begin, end, ROWS)]


class Softmax:
    """A softmax by weights and bias, or several, each with a number of its own.

    The bias is a factor of the exponentials, so it is applied to sums, not to each logit.
    """

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias - bias.max(axis=-1, keepdims=True)
        # Whether no exponential or quotient can overflow, as states lie between -1 and 1.
        self.safe = bool((np.abs(weights).sum(axis=-2) <= 30).all() and (self.bias >= -50).all())
        self.factor = np.exp(self.bias) if self.safe else np.ones_like(self.bias)
        self.back = np.ascontiguousarray(np.swapaxes(weights * self.factor[..., None, :], -1, -2))
        # Memory that is used again: new pages take longer than the sums in them.
        self.room = np.empty((ROWS, weights.shape[-1]), weights.dtype)

    def _exponentials(self, states: np.ndarray, at: np.ndarray, k) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Exponentials, to be taken times the factor, their sums times the factor, the log
        loss at places, and these places in the exponentials laid end to end. Overwrites the
        exponentials it gave before."""
        p = np.matmul(states, self.weights[k], out=self.room[: len(at)])
        if not self.safe:
            p += self.bias[k]
            p -= p.max(axis=1, keepdims=True)
        places = at + np.arange(0, p.size, p.shape[1])
        found = p.reshape(-1).take(places)
        if self.safe:
            found += self.bias[k].take(at)
        np.exp(p, out=p)
        total = p @ self.factor[k]
        return p, total, np.log(total) - found, places

    def chosen(self, states: np.ndarray, at: np.ndarray, k=...) -> np.ndarray:
        """Log share of each row at a place."""
        return -self._exponentials(states, at, k)[2]

    def errors(self, states: np.ndarray, at: np.ndarray, k=...) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Summed log loss at places, and its gradients by states, weights and bias."""
        p, total, losses, places = self._exponentials(states, at, k)
        # The shares' division and the factor are applied on the narrow sides.
        p.reshape(-1)[places] -= total / self.factor[k].take(at)
        part = 1 / total
        d_states = p @ self.back[k]
        d_states *= part[:, None]
        d_weights = (states * part[:, None]).T @ p
        d_weights *= self.factor[k]
        return float(losses.sum()), d_states, d_weights, (part @ p) * self.factor[k]


def _step(x: np.ndarray, u: np.ndarray, h: np.ndarray, out: np.ndarray) -> np.ndarray:
    """One step for a batch into ``out``: input rows by gate x, state h. Leaves the gates in x
    and returns what the state gives to each."""
    from_state = np.matmul(h, u)
    both, n = x[:2], x[2]
    both += from_state[:2]
    # The logistic function, of half the input.
    both *= 0.5
    np.tanh(both, out=both)
    both *= 0.5
    both += 0.5
    n += both[1] * from_state[2]
    np.tanh(n, out=n)
    np.subtract(h, n, out=out)
    out *= both[0]
    out += n
    return from_state


class Trainer:
    """Truncated backpropagation with Adagrad over parallel streams of tokens."""

    def __init__(self, net: Net, rate: float = 0.05, window: int = 16, streams: int = 512):
        self.net, self.rate, self.window, self.streams = net, rate, window, streams
        self.squares = {n: np.full_like(getattr(net, n), 1e-3) for n in net.NAMES}

    def _move(self, name: str, gradient: np.ndarray, rows=slice(None)) -> None:
        room = gradient * gradient
        room += self.squares[name][rows]
        self.squares[name][rows] = room
        np.sqrt(room, out=room)
        np.divide(gradient, room, out=room)
        room *= self.rate
        getattr(self.net, name)[rows] -= room

    def learn(self, ids: np.ndarray, first: np.ndarray) -> float:
        """Learn from documents laid end to end; ``first`` marks each one's first token.

        The tokens are cut into equal streams. State is carried along a stream, from window
        to window, and set to zero where a document begins; errors flow back to the start
        of the window. Returns the summed log loss.
        """
        streams = max(1, min(self.streams, len(ids) // self.window))
        length = len(ids) // streams
        rest = len(ids) - streams * length
        inputs = np.concatenate([[self.net.start], ids[:-1]])
        inputs[first] = self.net.start
        cut = lambda v: v[: streams * length].reshape(streams, length).T
        i, t, f = cut(inputs), cut(ids), cut(first)
        h, loss = np.zeros((streams, self.net.hidden), self.net.u.dtype), 0.0
        for at in range(0, length, self.window):
            span = slice(at, at + self.window)
            h, part = self._window(i[span], t[span], f[span], h)
            loss += part
        if rest:
            tail = slice(len(ids) - rest, None)
            h, part = self._window(inputs[tail][:, None], ids[tail][:, None], first[tail][:, None], h[-1:])
            loss += part
        return loss

    def _window(self, inputs, targets, first, h):
        net, k = self.net, self.net.hidden
        steps, width = inputs.shape
        inputs, targets = np.ascontiguousarray(inputs), np.ascontiguousarray(targets)
        e, u = net.gates()
        states = np.empty((steps, width, k), u.dtype)
        kept = []
        for s in range(steps):
            if first[s].any():
                h = np.where(first[s][:, None], u.dtype.type(0), h)
            x = e.take(inputs[s], axis=1)
            kept.append((h, x, _step(x, u, h, states[s])[2]))
            h = states[s]
        flat, wanted = states.reshape(-1, k), targets.reshape(-1)
        scale = 1 / (self.window * self.streams)
        loss, d_flat = self._output(flat, wanted, scale)
        d_states = d_flat.reshape(steps, width, k)
        # By gate: the parts that go to the state, then the last gate's part that goes to the input.
        d = np.empty((4, steps, width, k), u.dtype)
        d_u = np.zeros((3, k, k), u.dtype)
        d_h = np.zeros((width, k), u.dtype)
        u_back = np.ascontiguousarray(u.transpose(0, 2, 1))
        for s in range(steps - 1, -1, -1):
            before, (z, r, n), a = kept[s]
            d_z, d_r, d_a, d_n = d[:, s]
            d_h += d_states[s]
            np.subtract(1, z, out=d_n)
            np.multiply(z, d_n, out=d_z)
            d_n *= d_h
            slope = n * n
            np.subtract(1, slope, out=slope)
            d_n *= slope
            np.subtract(before, n, out=n)
            d_z *= n
            d_z *= d_h
            d_h *= z
            np.multiply(d_n, r, out=d_a)
            a *= d_a
            np.subtract(1, r, out=r)
            np.multiply(a, r, out=d_r)
            d_u += np.matmul(before.T, d[:3, s])
            for back in np.matmul(d[:3, s], u_back):
                d_h += back
            if first[s].any():
                d_h = np.where(first[s][:, None], u.dtype.type(0), d_h)
        self._move("u", d_u.transpose(1, 0, 2).reshape(k, 3 * k))
        self._move_rows("e", inputs.reshape(-1), [d[i].reshape(-1, k) for i in (0, 1, 3)])
        return h, loss

    def _output(self, flat, wanted, scale):
        net, n = self.net, len(wanted)
        classes = net.class_of(wanted)
        softmax, loss, d_flat = Softmax(net.c, net.cb), 0.0, np.empty_like(flat)
        d_c, d_cb, d_w, d_wb = (np.zeros_like(getattr(net, name)) for name in ("c", "cb", "w", "wb"))
        for span in _spans(0, n):
            part, d_flat[span], d, d_bias = softmax.errors(flat[span], classes[span])
            loss += part
            d_c += d
            d_cb += d_bias
        softmax = Softmax(net.w, net.wb)
        order, edges = net.by_list(classes)
        ordered, places = flat.take(order, axis=0), wanted[order] % CLASS
        d_ordered = np.empty_like(ordered)
        for k in np.flatnonzero(np.diff(edges)).tolist():
            for span in _spans(edges[k], edges[k + 1]):
                part, d_ordered[span], d, d_bias = softmax.errors(ordered[span], places[span], k)
                loss += part
                d_w[k] += d
                d_wb[k] += d_bias
        d_flat[order] += d_ordered
        for d in (d_flat, d_c, d_cb, d_w, d_wb):
            d *= scale
        for name, d in (("c", d_c), ("cb", d_cb), ("w", d_w), ("wb", d_wb)):
            self._move(name, d)
        return loss, d_flat

    def _move_rows(self, name, ids, gradients):
        # Short integers are sorted by their digits.
        order = np.argsort(ids.astype(np.int16) if self.net.start < 32768 else ids, kind="stable")
        ids = ids[order]
        starts = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
        sums = [np.add.reduceat(g.take(order, axis=0), starts, axis=0) for g in gradients]
        self._move(name, np.concatenate(sums, axis=1), ids[starts])


def document_scores(net: Net, documents: list[np.ndarray], tail_cost: np.ndarray, batch: int = 16384) -> np.ndarray:
    """Natural log-likelihood of whole documents, state carried from first to last token.

    ``tail_cost`` holds, per tail class, the log of its summed counts, which is taken off.
    Longer documents come first, so the ones still running are the first rows of a batch.
    """
    lengths = np.array([len(d) for d in documents])
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    ends = np.cumsum(lengths)
    flat = np.concatenate([documents[i] for i in order]) if len(order) else np.zeros(0, np.int64)
    begins = ends - lengths
    totals = np.zeros(len(order))
    e, u = net.gates()
    # Room for one more step of all documents that run at a time.
    states = np.empty((batch + BLOCK, net.hidden), e.dtype)
    targets, rows, every, held = *np.empty((2, len(states)), np.int64), np.arange(len(order)), 0

    def settle():
        wanted = targets[:held]
        found = net.log_probabilities(states[:held], wanted).astype(float)
        tail = wanted >= net.lists * CLASS
        found[tail] -= tail_cost[wanted[tail] - net.lists * CLASS]
        np.add(totals, np.bincount(rows[:held], found, len(totals)), out=totals)

    # Documents of about the same length run together, few enough for a core's cache.
    for top in range(0, len(order), BLOCK):
        longest = lengths[top : top + BLOCK]
        running = np.searchsorted(-longest, -np.arange(longest[0]), side="left")
        h, last = np.zeros((len(longest), net.hidden), e.dtype), np.full(len(longest), net.start)
        at = begins[top : top + BLOCK].copy()
        for m in running.tolist():
            span = slice(held, held + m)
            _step(e.take(last[:m], axis=1), u, h[:m], states[span])
            h, last = states[span], flat.take(at[:m])
            targets[span], rows[span] = last, every[top : top + m]
            at += 1
            held += m
            if held >= batch:
                settle()
                h, held = h.copy(), 0
    if held:
        settle()
    out = np.empty(len(order))
    out[order] = totals
    return out
