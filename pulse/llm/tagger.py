"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Sequences all have one length; shorter texts are padded with character 0, which is tagged outside.
Characters are small whole numbers, so the input weights are a table with a row per character.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Characters: ASCII as itself, all others one. Units of each direction.
CHARACTERS, UNITS = 129, 16


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _run(x: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, list]:
    """Hidden states (T, B, H) of an LSTM over inputs (T, B, 4H), and what its gradient needs."""
    steps, batch, units = x.shape[0], x.shape[1], w.shape[0]
    h, c = np.zeros((batch, units), x.dtype), np.zeros((batch, units), x.dtype)
    states, kept = np.empty((steps, batch, units), x.dtype), []
    for t in range(steps):
        z = x[t] + h @ w
        gates, g = _sigmoid(z[:, :3 * units]), np.tanh(z[:, 3 * units:])
        i, f, o = gates[:, :units], gates[:, units:2 * units], gates[:, 2 * units:]
        before, c = c, f * c + i * g
        tc = np.tanh(c)
        kept.append((h, i, f, o, g, before, tc))
        h = o * tc
        states[t] = h
    return states, kept


def _run_back(d: np.ndarray, kept: list, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of inputs and recurrent weights from those of the hidden states."""
    units = w.shape[0]
    dx, dw = np.empty((*d.shape[:2], 4 * units), d.dtype), np.zeros_like(w)
    dh, dc = np.zeros_like(d[0]), np.zeros_like(d[0])
    for t in range(len(kept) - 1, -1, -1):
        h, i, f, o, g, before, tc = kept[t]
        dh = dh + d[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.hstack([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)])
        dx[t] = dz
        dw += h.T @ dz
        dh, dc = dz @ w.T, dc * f
    return dx, dw


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class Tagger:
    """Weights by name; ``tags`` counts the tags, tag 0 is outside."""

    tags: int
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    @classmethod
    def new(cls, tags: int, seed: int = 0) -> Tagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, scale=0.1: (rng.standard_normal(shape) * scale).astype(np.float32)
        w = {}
        for way in ("f", "b"):
            w[f"in_{way}"] = draw(CHARACTERS, 4 * UNITS)
            w[f"in_{way}"][:, UNITS:2 * UNITS] += 1  # it starts out remembering
            w[f"again_{way}"] = draw(UNITS, 4 * UNITS, scale=UNITS ** -0.5)
        w["out"], w["bias"] = draw(2 * UNITS, tags), np.zeros(tags, np.float32)
        w["move"], w["start"] = np.zeros((tags, tags), np.float32), np.zeros(tags, np.float32)
        return cls(tags, w)

    def _emissions(self, x: np.ndarray) -> tuple[np.ndarray, tuple]:
        w, x = self.weights, x.T
        forth, kept_f = _run(w["in_f"][x], w["again_f"])
        back, kept_b = _run(w["in_b"][x[::-1]], w["again_b"])
        h = np.concatenate([forth, back[::-1]], axis=2)
        return h @ w["out"] + w["bias"], (x, h, kept_f, kept_b)

    def _chances(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log sums over all paths up to and from each place, and of whole paths, for emissions (T, B, K)."""
        w = self.weights
        up, down = np.empty_like(e), np.zeros_like(e)
        up[0] = e[0] + w["start"]
        for t in range(1, len(e)):
            up[t] = e[t] + _log_sum(up[t - 1][:, :, None] + w["move"], 1)
        for t in range(len(e) - 2, -1, -1):
            down[t] = _log_sum(w["move"] + (e[t + 1] + down[t + 1])[:, None, :], 2)
        total = _log_sum(up[-1], 1)
        return up, down, total, np.exp(up + down - total[:, None])

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean negative log likelihood of tags ``y`` (B, T) for characters ``x`` (B, T), and its gradients."""
        w, batch = self.weights, len(x)
        e, (xt, h, kept_f, kept_b) = self._emissions(x)
        up, down, total, chance = self._chances(e)
        yt = y.T
        at, of = np.indices(yt.shape)
        path = e[at, of, yt].sum(axis=0) + w["start"][yt[0]] + w["move"][yt[:-1], yt[1:]].sum(axis=0)
        de = chance.copy()
        de[at, of, yt] -= 1
        de /= batch
        g = {"start": de[0].sum(axis=0)}
        pairs = np.zeros((self.tags, self.tags), np.float64)
        for t in range(1, len(e)):
            p = up[t - 1][:, :, None] + w["move"] + (e[t] + down[t])[:, None, :] - total[:, None, None]
            pairs += np.exp(p).sum(axis=0)
        np.subtract.at(pairs, (yt[:-1].ravel(), yt[1:].ravel()), 1)
        g["move"] = (pairs / batch).astype(np.float32)
        flat = de.reshape(-1, self.tags)
        g["out"], g["bias"] = h.reshape(len(flat), -1).T @ flat, flat.sum(axis=0)
        dh = de @ w["out"].T
        for way, d, kept, xs in (("f", dh[:, :, :UNITS], kept_f, xt), ("b", dh[::-1, :, UNITS:], kept_b, xt[::-1])):
            dx, g[f"again_{way}"] = _run_back(d, kept, w[f"again_{way}"])
            table = np.zeros_like(w[f"in_{way}"])
            order = np.argsort(xs, axis=None, kind="stable")
            chars, first = np.unique(xs.ravel()[order], return_index=True)
            table[chars] = np.add.reduceat(dx.reshape(-1, dx.shape[2])[order], first, axis=0)
            g[f"in_{way}"] = table
        return float((total - path).mean()), g

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.01, seed: int = 0) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        rng, losses, step = np.random.default_rng(seed), [], 0
        m, v = ({k: np.zeros_like(a) for k, a in self.weights.items()} for _ in range(2))
        for epoch in range(epochs):
            order, loss = rng.permutation(len(x)), 0.0
            slow = rate * (1 - epoch / epochs) + rate * 0.05
            for k in range(0, len(x), batch):
                part = order[k:k + batch]
                one, g = self.gradients(x[part], y[part])
                loss += one * len(part)
                step += 1
                size = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                for name, a in g.items():
                    a = a * min(1.0, 5.0 / max(size, 1e-9))
                    m[name] = 0.9 * m[name] + 0.1 * a
                    v[name] = 0.999 * v[name] + 0.001 * a * a
                    self.weights[name] = (self.weights[name] - slow * (m[name] / (1 - 0.9 ** step)) / (np.sqrt(v[name] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
            losses.append(loss / len(x))
        return losses

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest tags (B, T), and the chance of each of them by all paths."""
        w = self.weights
        e, _ = self._emissions(x)
        best, back = e[0] + w["start"], np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            step = best[:, :, None] + w["move"]
            back[t] = step.argmax(axis=1)
            best = step.max(axis=1) + e[t]
        tags = np.empty(e.shape[:2], np.int64)
        tags[-1] = best.argmax(axis=1)
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(e.shape[1]), tags[t]]
        chance = self._chances(e)[3]
        at, of = np.indices(tags.shape)
        return tags.T, chance[at, of, tags].T
