"""A small gated recurrent network over word classes, in numpy.

The state predicts the class of the next token through a softmax; the class just
read moves the state. Training is by truncated backpropagation through time:
gradients stop at the border of a window of steps, states do not, they are
carried from window to window until a text ends.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np

STATE = 24
STEPS = 32
STREAMS = 64
EPOCHS = 3
RATE = 0.01
CLIP = 5.0
# Texts scored side by side, and steps whose softmax is taken at once.
SIDE_BY_SIDE = 512
AT_ONCE = 32
# Rows of logits that stay in a core's cache while they are worked on.
IN_CACHE = 1024
# Logits whose powers of e stay far inside what a 32-bit float holds; states are within 1.
SAFE = 40.0


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place of ``x``; beyond 30 on the other side nothing is left of the power anyway."""
    np.negative(x, out=x)
    np.minimum(x, 30, out=x)
    np.exp(x, out=x)
    x += 1
    return np.divide(1, x, out=x)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


class Space:
    """Memory by name that window after window uses again; new memory would be paged in each time."""

    def __init__(self, dtype=np.float32):
        self.dtype, self.held = dtype, {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        """A contiguous array of ``shape``, holding whatever it held before."""
        size = math.prod(shape)
        if name not in self.held or self.held[name].size < size:
            self.held[name] = np.empty(size, self.dtype)
        return self.held[name][:size].reshape(shape)


@dataclass
class Network:
    """X: what a class adds to the three gates; U: what the state adds; W, b: the output."""

    X: np.ndarray
    U: np.ndarray
    W: np.ndarray
    b: np.ndarray

    @classmethod
    def fresh(cls, shares: np.ndarray, state: int = STATE, seed: int = 7) -> Network:
        """Untrained: predicts the classes' own shares, whatever the state."""
        rng, n = np.random.default_rng(seed), len(shares)

        def small(*shape):
            return (rng.standard_normal(shape) * 0.1).astype(np.float32)

        return cls(small(n, 3 * state) * 3, small(state, 3 * state), small(state, n) * 0.1,
                   np.log(np.maximum(shares, 1e-9)).astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.X, self.U, self.W, self.b]

    def step(self, h: np.ndarray, read: np.ndarray):
        """The next state, and what its gradient needs."""
        size = h.shape[1]
        gate, own = self.X[read], h @ self.U
        zr = _sigmoid(gate[:, :2 * size] + own[:, :2 * size])
        z, r = zr[:, :size], zr[:, size:]
        new = r * own[:, 2 * size:]
        new += gate[:, 2 * size:]
        np.tanh(new, out=new)
        then = h - new
        then *= z
        then += new
        return then, (z, r, new, own[:, 2 * size:])

    def window(self, h: np.ndarray, tokens: np.ndarray, starts: np.ndarray, real: np.ndarray,
               space: Space | None = None):
        """Loss, gradients and last state of a window: tokens, starts, real are steps x streams."""
        steps, streams = tokens.shape
        size, space = h.shape[1], space or Space(h.dtype)
        before, z, r, new, own, left, by_z, by_r, d_states = (
            space(name, steps, streams, size) for name in (
                "before", "z", "r", "new", "own", "left", "by_z", "by_r", "d_states"))
        begun = starts.any(axis=1)
        for t in range(steps):
            if begun[t]:
                h = np.where(starts[t][:, None], np.float32(0), h)
            before[t] = h
            h, (z[t], r[t], new[t], own[t]) = self.step(h, tokens[t])
        flat = before.reshape(steps * streams, size)
        read, weight = tokens.ravel(), real.ravel()
        n = max(1, int(real.sum()))
        loss, d_w, d_b, d_flat = 0.0, 0, 0, d_states.reshape(flat.shape)
        for at in range(0, len(flat), IN_CACHE):
            here = slice(at, at + IN_CACHE)
            logs, out, sums = self._powers(flat[here], read[here], space)
            loss -= float(((logs - np.log(sums)) * weight[here]).sum()) / n
            out *= weight[here] / (sums * np.float32(n))
            out[read[here], np.arange(len(logs))] -= weight[here] / np.float32(n)
            d_w, d_b = d_w + flat[here].T @ out.T, d_b + out.sum(axis=1)
            np.matmul(out.T, self.W.T, out=d_flat[here])
        gates, owns = (space(name, steps, streams, 3 * size) for name in ("gates", "owns"))
        d_h = np.zeros_like(h)
        back = np.ascontiguousarray(self.U.T)
        # What a step's gradient is multiplied by, for all steps at once.
        np.subtract(1, z, out=left)
        np.subtract(before, new, out=by_z)
        by_z *= z
        by_z *= left
        np.subtract(1, r, out=by_r)
        by_r *= r
        by_r *= own
        np.multiply(new, new, out=new)
        np.subtract(1, new, out=new)
        new *= left
        for t in range(steps - 1, -1, -1):
            gate, own = gates[t], owns[t]
            d_new = gate[:, 2 * size:]
            np.multiply(d_h, new[t], out=d_new)
            np.multiply(d_h, by_z[t], out=gate[:, :size])
            np.multiply(d_new, by_r[t], out=gate[:, size:2 * size])
            own[:, :2 * size] = gate[:, :2 * size]
            np.multiply(d_new, r[t], out=own[:, 2 * size:])
            d_h *= z[t]
            d_h += own @ back
            d_h += d_states[t]
            if begun[t]:
                d_h[starts[t]] = 0
        d_u = flat.T @ owns.reshape(steps * streams, -1)
        # Each class gathers the gradients of the steps that read it.
        order = np.argsort(read.astype(np.min_scalar_type(len(self.X))), kind="stable")
        times = np.bincount(read, minlength=len(self.X))
        ends, d_x = np.append(0, np.cumsum(times)).tolist(), np.zeros_like(self.X)
        by_class = np.take(gates.reshape(len(read), -1), order, axis=0, mode="clip",
                           out=space("by_class", len(read), 3 * size))
        ones = np.ones(times.max(), h.dtype)
        for k in np.flatnonzero(times).tolist():
            np.matmul(ones[:times[k]], by_class[ends[k]:ends[k + 1]], out=d_x[k])
        return loss, [d_x, d_u, d_w, d_b], h

    def _powers(self, states: np.ndarray, read: np.ndarray, space: Space):
        """The classes' logits: of those read, as powers of e by class, the powers' sums.

        Weights that might give a power too large or small have the largest logit made 0 first.
        """
        out = np.matmul(self.W.T, states.T, out=space("powers", len(self.b), len(states)))
        out += self.b[:, None]
        if float((np.abs(self.b) + np.abs(self.W).sum(axis=0)).max()) > SAFE:
            out -= out.max(axis=0)
        logs = out[read, np.arange(len(read))]
        np.exp(out, out=out)
        return logs, out, out.sum(axis=0)

    def train(self, texts: list[np.ndarray], epochs: int = EPOCHS, steps: int = STEPS,
              streams: int = STREAMS, rate: float = RATE) -> list[float]:
        """Adam over all texts, ``epochs`` times; the mean losses."""
        adam, rng = Adam(self, rate), np.random.default_rng(11)
        means = []
        for epoch in range(epochs):
            adam.rate = rate * (1 - 0.9 * epoch / epochs)
            means.append(adam.learn(texts, rng, steps, streams))
        return means

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """Sum of natural log probabilities of each text's classes, over its whole length.

        Texts are read side by side in windows; the states go on from one window
        to the next.
        """
        total = np.zeros(len(texts))
        order, space = sorted(range(len(texts)), key=lambda i: -len(texts[i])), Space()
        for at in range(0, len(order), SIDE_BY_SIDE):
            some = order[at:at + SIDE_BY_SIDE]
            total[some] = self._side_by_side([texts[i] for i in some], space)
        return total

    def _side_by_side(self, texts: list[np.ndarray], space: Space) -> np.ndarray:
        """Of texts in falling order of length."""
        sizes = np.array([len(t) for t in texts])
        sums = np.zeros(len(texts))
        h = np.zeros((len(texts), self.U.shape[0]), np.float32)
        for at in range(0, int(sizes[0]) if len(sizes) else 0, AT_ONCE):
            going = int((sizes > at).sum())
            tokens = np.zeros((AT_ONCE, going), np.int64)
            for i in range(going):
                part = texts[i][at:at + AT_ONCE]
                tokens[:len(part), i] = part
            steps = min(AT_ONCE, int(sizes[0]) - at)
            states, h = space("states", steps, going, h.shape[1]), h[:going]
            for t in range(steps):
                states[t] = h
                h, _ = self.step(h, tokens[t])
            states, read = states.reshape(steps * going, -1), tokens[:steps].ravel()
            logs = np.empty(len(states), np.float32)
            for a in range(0, len(states), IN_CACHE):
                here = slice(a, a + IN_CACHE)
                own, _, sums_here = self._powers(states[here], read[here], space)
                logs[here] = own - np.log(sums_here)
            there = (sizes[:going] - at)[None, :] > np.arange(steps)[:, None]
            sums[:going] += (logs.reshape(steps, going) * there).sum(axis=0)
        return sums


class Adam:
    """What training a network keeps between windows."""

    def __init__(self, net: Network, rate: float = RATE):
        self.net, self.rate, self.turn = net, rate, 0
        self.moments = [[np.zeros_like(p) for p in net.parts()] for _ in "ab"]
        self.space = Space(net.U.dtype)

    def learn(self, texts: list[np.ndarray], rng: np.random.Generator, steps: int = STEPS,
              streams: int = STREAMS) -> float:
        """One pass over whole texts, ``streams`` rows of them read side by side; the mean loss.

        A row that has ended leaves the window, so a text much longer than the
        others goes on alone.
        """
        rows: list[list[np.ndarray]] = [[] for _ in range(streams)]
        sizes = [(0, i) for i in range(streams)]
        for text in sorted(texts, key=len, reverse=True):  # evens the rows out
            size, least = sizes[0]
            rows[least].append(text)
            heapq.heapreplace(sizes, (size + len(text), least))
        lines, begins = [], []
        for size, i in sorted(sizes, reverse=True):
            if size:
                row = [rows[i][k] for k in rng.permutation(len(rows[i]))]
                begin = np.zeros(size, bool)
                begin[np.cumsum([0, *map(len, row[:-1])])] = True
                lines.append(np.concatenate(row))
                begins.append(begin)
        lengths = np.array([len(line) for line in lines])
        h, losses = np.zeros((len(lines), self.net.U.shape[0]), np.float32), []
        for at in range(0, int(lengths.max(initial=0)), steps):
            going = int((lengths > at).sum())
            tokens = np.zeros((steps, going), np.int64)
            starts = np.zeros((steps, going), bool)
            for i in range(going):
                part = lines[i][at:at + steps]
                tokens[:len(part), i] = part
                starts[:len(part), i] = begins[i][at:at + steps]
            real = (at + np.arange(steps)[:, None] < lengths[None, :going]).astype(np.float32)
            loss, grads, h = self.net.window(h[:going], tokens, starts, real, self.space)
            losses.append(loss)
            self._move(grads)
        return float(np.mean(losses)) if losses else 0.0

    def _move(self, grads: list[np.ndarray]):
        self.turn += 1
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        for p, g, m, v in zip(self.net.parts(), grads, *self.moments):
            g = g * min(1.0, CLIP / max(norm, 1e-9))
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (self.rate * (m / (1 - 0.9 ** self.turn))
                  / (np.sqrt(v / (1 - 0.99 ** self.turn)) + 1e-6)).astype(np.float32)
