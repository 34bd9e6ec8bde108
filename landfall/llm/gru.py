"""A gated recurrent language model with a class-factored softmax, in numpy.

Symbols are ``words`` frequent words in order of frequency, then one for all
other words and one for the end of a text, which is also what a text starts
from. Words are cut into classes of ``width`` by frequency; the last two
symbols are classes of their own. The probability of a symbol is that of its
class times that of the word within it.
"""

from __future__ import annotations

import numpy as np

HIDDEN = 16
_LARGEST = np.float32(4)  # of the output's weights; states lie within -1 and 1, so exponentials stay finite
_ROWS = 2048


class Gru:
    """Parameters by name, all float32; the biases start as the unigram model."""

    def __init__(self, counts: np.ndarray, width: int = 64, hidden: int = HIDDEN, seed: int = 11) -> None:
        """``counts`` of all symbols: the words, other words, ends."""
        self.words, self.width, self.hidden = len(counts) - 2, width, hidden
        self.word_classes = -(-self.words // width)
        self.classes = self.word_classes + 2
        random = np.random.default_rng(seed)

        def start(*shape: int) -> np.ndarray:
            return (random.standard_normal(shape) * 0.1).astype(np.float32)

        by_class = np.array([counts[c * width : min((c + 1) * width, self.words)].sum() for c in range(self.word_classes)] + [counts[-2], counts[-1]])
        share = (by_class + 0.5) / (by_class + 0.5).sum()
        self.p = {
            "inputs": start(len(counts), 3 * hidden), "turn": start(hidden, 3 * hidden), "gates": np.zeros(3 * hidden, np.float32),
            "to_class": start(hidden, self.classes), "class_bias": np.log(share).astype(np.float32),
            "to_word": start(self.word_classes * width, hidden), "word_bias": self._word_bias(counts[: self.words]),
        }

    def _word_bias(self, counts: np.ndarray) -> np.ndarray:
        """Log shares within each class; the places that fill up the last class have none."""
        bias = np.full(self.word_classes * self.width, -60, np.float32)
        bias[: self.words] = np.log(counts + 0.5)
        for c in range(self.word_classes):
            mine = slice(c * self.width, min((c + 1) * self.width, self.words))
            bias[mine] -= np.log((counts[mine] + 0.5).sum())
        return bias

    def class_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.words, symbols // self.width, self.word_classes + symbols - self.words)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """The table of inputs with the gates' biases, and the turn, gate by gate: each gate's values stand together."""
        n = self.hidden
        table = (self.p["inputs"] + self.p["gates"]).reshape(-1, 3, n).transpose(1, 0, 2)
        return np.ascontiguousarray(table), np.ascontiguousarray(self.p["turn"].reshape(n, 3, n).transpose(1, 0, 2))

    @staticmethod
    def read(
        seen: np.ndarray, h: np.ndarray, turn: np.ndarray, turned: np.ndarray, gates: np.ndarray, new: np.ndarray, after: np.ndarray
    ) -> None:
        """Into ``after`` the state after reading one symbol in each lane, given the symbols' rows of each gate's table.

        ``turned``, ``gates`` (reset, keep) and ``new`` are filled, too: the way back needs them.
        """
        np.matmul(h, turn, out=turned)
        np.add(seen[:2], turned[:2], out=gates)
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        np.add(gates, 1, out=gates)
        np.divide(1, gates, out=gates)
        np.multiply(gates[0], turned[2], out=new)
        np.add(seen[2], new, out=new)
        np.tanh(new, out=new)
        np.subtract(h, new, out=after)
        np.multiply(gates[1], after, out=after)
        np.add(new, after, out=after)

    def step(self, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, tuple]:
        """The state after reading one symbol in each lane, and what the way back needs."""
        (lanes, n), kind = h.shape, self.p["turn"].dtype.type
        table, turn = self.blocks()
        turned, gates, new, after = (np.empty((*k, lanes, n), kind) for k in ((3,), (2,), (), ()))
        self.read(table[:, symbols], h, turn, turned, gates, new, after)
        return after, (turned, gates, new)

    def log_probs(self, h: np.ndarray, targets: np.ndarray, grads: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probability of each target; with ``grads``, adds to them and returns the loss's slope in h."""
        p, kind = self.p, self.p["turn"].dtype.type
        kinds = self.class_of(targets)
        out, slope = np.empty(len(h), kind), None if grads is None else np.empty((len(h), self.hidden), kind)
        ones, back = np.ones(self.classes, kind), np.ascontiguousarray(p["to_class"].T)
        for at in range(0, len(h), _ROWS):  # few rows at a time stay in the processor's cache
            mine = slice(at, at + _ROWS)
            scores = h[mine] @ p["to_class"]
            scores += p["class_bias"]
            np.exp(scores, out=scores)
            total, rows = scores @ ones, np.arange(len(scores))
            out[mine] = np.log(scores[rows, kinds[mine]] / total)
            if grads is not None:
                # Shares less one at the target, all times the total; the narrow factors are divided by it.
                scores[rows, kinds[mine]] -= total
                share = 1 / total
                grads["to_class"] += (h[mine] * share[:, None]).T @ scores
                grads["class_bias"] += share @ scores
                np.multiply(scores @ back, share[:, None], out=slope[mine])
        # The words of a class stand together; some classes at a time.
        order = np.argsort(kinds.astype(np.int16), kind="stable")
        bounds = np.searchsorted(kinds[order], np.arange(self.word_classes + 1)).tolist()
        states, place = h[order[: bounds[-1]]], targets[order[: bounds[-1]]] % self.width
        table, bias = p["to_word"].reshape(self.word_classes, self.width, -1), p["word_bias"].reshape(self.word_classes, self.width)
        logs, slopes, ones, low = np.empty(bounds[-1], kind), np.empty((bounds[-1], self.hidden), kind), np.ones(self.width, kind), 0
        while low < self.word_classes:
            high = low + 1
            while high < self.word_classes and bounds[high + 1] - bounds[low] <= _ROWS:
                high += 1
            first, last = bounds[low], bounds[high]
            if first < last:
                within, used = np.empty((last - first, self.width), kind), []
                for c in range(low, high):
                    if bounds[c] < bounds[c + 1]:
                        part = within[bounds[c] - first : bounds[c + 1] - first]
                        np.matmul(states[bounds[c] : bounds[c + 1]], table[c].T, out=part)
                        part += bias[c]
                        used.append((c, part))
                np.exp(within, out=within)
                total, rows = within @ ones, np.arange(last - first)
                logs[first:last] = np.log(within[rows, place[first:last]] / total)
                if grads is not None:
                    within[rows, place[first:last]] -= total
                    share = 1 / total
                    scaled = states[first:last] * share[:, None]
                    for c, part in used:
                        mine = slice(bounds[c] - first, bounds[c + 1] - first)
                        grads["to_word"].reshape(table.shape)[c] += part.T @ scaled[mine]
                        grads["word_bias"].reshape(bias.shape)[c] += share[mine] @ part
                        np.matmul(part, table[c], out=slopes[bounds[c] : bounds[c + 1]])
                    slopes[first:last] *= share[:, None]
            low = high
        out[order[: bounds[-1]]] += logs
        if grads is not None:
            slope[order[: bounds[-1]]] += slopes
        return out, slope

    def train(self, stream: np.ndarray, lanes: int = 256, window: int = 32, rate: float = 0.04) -> None:
        """One pass over a stream of texts, each closed by the end symbol, by truncated backpropagation.

        The stream is cut into lanes of equal length, the last one filled up
        with ends that count for nothing; states are carried across windows and
        begin anew after an end.
        """
        end = self.words + 1
        if not len(stream):
            return
        lanes = max(1, min(lanes, len(stream) // window))
        length = -(-len(stream) // lanes)
        targets = np.append(stream, np.full(lanes * length - len(stream), end, stream.dtype)).reshape(lanes, length)
        real = (np.arange(lanes * length) < len(stream)).reshape(lanes, length)
        inputs = np.concatenate([np.full((lanes, 1), end, stream.dtype), targets[:, :-1]], axis=1)
        h = np.zeros((lanes, self.hidden), np.float32)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for turn, at in enumerate(range(0, length, window)):
            part = slice(at, at + window)
            counted = None if real[-1, part].all() and real[:, part].all() else real[:, part]
            grads, h = self._window(inputs[:, part], targets[:, part], h, counted)
            # Of the table of inputs only the rows that were read.
            read = np.flatnonzero(np.bincount(inputs[:, part].ravel(), minlength=len(self.p["inputs"])))
            for k, g in grads.items():
                at = read if k == "inputs" else slice(None)
                g = np.clip(g[at], -1, 1)
                m, v = first[k][at], second[k][at]
                change = g - m
                change *= 0.1
                m += change
                np.multiply(g, g, out=change)
                change -= v
                change *= 0.01
                v += change
                if k == "inputs":
                    first[k][at], second[k][at] = m, v
                np.divide(v, 1 - 0.99 ** (turn + 1), out=change)
                np.sqrt(change, out=change)
                change += 1e-6
                np.multiply(m, rate / (1 - 0.9 ** (turn + 1)), out=g)
                g /= change
                self.p[k][at] -= g
            for k in ("to_class", "to_word"):
                np.clip(self.p[k], -_LARGEST, _LARGEST, out=self.p[k])
            for k in ("class_bias", "word_bias"):
                np.minimum(self.p[k], _LARGEST, out=self.p[k])

    def _window(
        self, inputs: np.ndarray, targets: np.ndarray, h: np.ndarray, counted: np.ndarray | None = None
    ) -> tuple[dict, np.ndarray]:
        """Slopes of the loss over a window, and the state after it; ``counted`` marks the symbols that have a loss."""
        n, end, (lanes, steps), kind = self.hidden, self.words + 1, inputs.shape, self.p["turn"].dtype.type
        grads = {k: np.zeros_like(v) for k, v in self.p.items()}
        symbols = inputs.T.ravel()
        table, turn = self.blocks()
        seen = table.take(symbols, axis=1).reshape(3, steps, lanes, n)
        ends = [np.flatnonzero(e) for e in inputs.T == end]
        before, new, states = (np.empty((steps, lanes, n), kind) for _ in range(3))
        turned, gates = np.empty((3, steps, lanes, n), kind), np.empty((2, steps, lanes, n), kind)
        for t in range(steps):
            before[t] = h
            before[t, ends[t]] = 0
            self.read(seen[:, t], before[t], turn, turned[:, t], gates[:, t], new[t], states[t])
            h = states[t]
        (reset, keep), turned = gates, turned[2]
        wanted, flat = targets.T.ravel(), states.reshape(-1, n)
        if counted is None:
            _, slopes = self.log_probs(flat, wanted, grads)
        else:
            at = np.flatnonzero(counted.T.ravel())
            slopes = np.zeros_like(flat)
            if len(at):
                slopes[at] = self.log_probs(flat[at], wanted[at], grads)[1]
        slopes = slopes.reshape(steps, lanes, n)
        # What does not depend on later steps is taken for all of them at once.
        to_new, to_keep = (1 - keep) * (1 - new * new), (before - new) * keep * (1 - keep)
        to_reset = turned * reset * (1 - reset)
        d_seen, d_turned = (np.empty((steps, lanes, 3 * n), kind) for _ in range(2))
        back, turn = np.zeros((lanes, n), kind), np.ascontiguousarray(self.p["turn"].T)
        for t in reversed(range(steps)):
            d = np.add(slopes[t], back, out=slopes[t])
            mine = d_turned[t]
            d_new = np.multiply(d, to_new[t], out=d_seen[t, :, 2 * n :])
            np.multiply(d_new, to_reset[t], out=mine[:, :n])
            np.multiply(d, to_keep[t], out=mine[:, n : 2 * n])
            np.multiply(d_new, reset[t], out=mine[:, 2 * n :])
            np.matmul(mine, turn, out=back)
            d *= keep[t]
            back += d
            back[ends[t]] = 0
        d_seen[:, :, : 2 * n] = d_turned[:, :, : 2 * n]
        d_seen, d_turned = d_seen.reshape(-1, 3 * n), d_turned.reshape(-1, 3 * n)
        grads["turn"] += before.reshape(-1, n).T @ d_turned
        grads["gates"] += np.ones(len(d_seen), kind) @ d_seen
        order = np.argsort(symbols.astype(np.int16) if len(self.p["inputs"]) < 1 << 15 else symbols, kind="stable")
        ranked = symbols[order]
        starts = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        sizes, sorted_slopes = np.diff(starts, append=len(ranked)), d_seen[order]
        # Most symbols are read a few times only: those read equally often are summed side by side.
        for size in range(1, 6):
            first = starts[sizes == size]
            total = sorted_slopes[first]
            if size > 1:
                rest = sorted_slopes[first + 1]
                for i in range(2, size):
                    rest += sorted_slopes[first + i]
                total += rest
            grads["inputs"][ranked[first]] = total
        often = np.repeat(sizes > 5, sizes)
        if often.any():
            begins = np.cumsum(sizes[sizes > 5]) - sizes[sizes > 5]
            grads["inputs"][ranked[starts[sizes > 5]]] = np.add.reduceat(sorted_slopes[often], begins)
        # The loss is a mean over the lanes.
        for g in grads.values():
            g *= kind(1 / lanes)
        return grads, h

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Natural log-probability of each whole text; each closes with the end symbol.

        All texts advance together, the longest first, so that those still
        running are the first ones; states are carried to the end of the text.
        """
        order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        flat = np.concatenate([texts[i] for i in order])
        starts = np.cumsum(lengths) - lengths
        running = len(order) - np.searchsorted(lengths[::-1], np.arange(lengths[0] if len(lengths) else 0), side="right")
        sums = np.zeros(len(order))
        n_all, size, kind = len(order), self.hidden, np.float32
        h, read = np.zeros((n_all, size), kind), np.full(n_all, self.words + 1, flat.dtype)
        (table, turn), new = self.blocks(), np.empty((n_all, size), kind)
        turned, gates = np.empty(3 * n_all * size, kind), np.empty(2 * n_all * size, kind)
        states, wanted, owners, held = [], [], [], 0
        for t, n in enumerate(running.tolist()):
            after = np.empty((n, size), kind)
            self.read(
                table.take(read[:n], axis=1), h[:n], turn, turned[: 3 * n * size].reshape(3, n, size),
                gates[: 2 * n * size].reshape(2, n, size), new[:n], after,
            )
            h = after
            read = flat[starts[:n] + t]
            states.append(h)
            wanted.append(read)
            owners.append(n)
            held += n
            if held > 1 << 14 or t + 1 == len(running):
                logs, _ = self.log_probs(np.concatenate(states), np.concatenate(wanted))
                at = 0
                for n_then in owners:
                    sums[:n_then] += logs[at : at + n_then]
                    at += n_then
                states, wanted, owners, held = [], [], [], 0
        out = np.zeros(len(order))
        out[order] = sums
        return out

    def pack(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in sorted(self.p)])

    def unpack(self, flat: np.ndarray) -> None:
        at = 0
        for k in sorted(self.p):
            size = self.p[k].size
            self.p[k] = flat[at : at + size].reshape(self.p[k].shape).astype(np.float32)
            at += size
