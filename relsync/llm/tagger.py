"""A character-level bidirectional LSTM with CRF transitions, in numpy.

Characters are one-hot inputs (ASCII, anything else, padding). Both directions read a window;
their states give each character a score for every tag, and the CRF adds scores for tags that
follow each other. Training follows the gradient of the tag sequences' log-likelihood.
"""

from __future__ import annotations

import numpy as np

#: Input symbols: ASCII, any other character, padding.
OTHER, PAD, SYMBOLS = 128, 129, 130
_NEVER = -30.0


def encode(windows: list[str], length: int) -> np.ndarray:
    out = np.full((len(windows), length), PAD, dtype=np.int64)
    for i, w in enumerate(windows):
        codes = np.frombuffer(w.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        out[i, : len(codes)] = np.where(codes < 128, codes, OTHER)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """``kinds`` kinds of spans; tags are 0 (outside), 2k + 1 (begins kind k), 2k + 2 (inside)."""

    def __init__(self, kinds: int, hidden: int = 16, seed: int = 3):
        random = np.random.default_rng(seed)
        t, h = 2 * kinds + 1, hidden
        self.hidden, self.tags = h, t
        gates = lambda n: random.normal(0, 0.1, (n, 4 * h)).astype(np.float32)
        self.p = {"xf": gates(SYMBOLS), "uf": gates(h), "xb": gates(SYMBOLS), "ub": gates(h)}
        for x in ("xf", "xb"):
            self.p[x][:, h:2 * h] += 1  # remember at first
        self.p["out"] = random.normal(0, 0.1, (2 * h, t)).astype(np.float32)
        self.p["bias"] = np.zeros(t, dtype=np.float32)
        self.p["trans"], self.p["start"], self.p["end"] = np.zeros((t, t), np.float32), np.zeros(t, np.float32), np.zeros(t, np.float32)
        # inside k follows begin k and inside k only. At a window's start a span may go on
        self.allowed = np.ones((t, t), dtype=bool)
        for k in range(kinds):
            self.allowed[:, 2 * k + 2] = False
            self.allowed[[2 * k + 1, 2 * k + 2], 2 * k + 2] = True

    def _run(self, x, u, keep):
        """States of one direction over (window, step, gate) inputs, and what a gradient needs."""
        n, steps, h = x.shape[0], x.shape[1], self.hidden
        state, cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        out, kept = np.empty((n, steps, h), np.float32), []
        for s in range(steps):
            z = x[:, s] + state @ u
            gate = _sigmoid(z[:, :3 * h])
            new = np.tanh(z[:, 3 * h:])
            before = cell
            cell = gate[:, h:2 * h] * cell + gate[:, :h] * new
            tanh = np.tanh(cell)
            if keep:
                kept.append((gate, new, before, tanh, state))
            state = gate[:, 2 * h:] * tanh
            out[:, s] = state
        return out, kept

    def _back(self, d_out, u, kept):
        """Gradients of the inputs and of ``u`` from those of the states."""
        n, steps, h = d_out.shape
        d_x, d_u = np.empty((n, steps, 4 * h), np.float32), np.zeros_like(u)
        d_state, d_cell = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for s in range(steps - 1, -1, -1):
            gate, new, before, tanh, state = kept[s]
            i, f, o = gate[:, :h], gate[:, h:2 * h], gate[:, 2 * h:]
            d = d_out[:, s] + d_state
            d_cell = d_cell + d * o * (1 - tanh * tanh)
            z = np.concatenate((d_cell * new * i * (1 - i), d_cell * before * f * (1 - f), d * tanh * o * (1 - o), d_cell * i * (1 - new * new)), axis=1)
            d_x[:, s] = z
            d_u += state.T @ z
            d_state = z @ u.T
            d_cell = d_cell * f
        return d_x, d_u

    def _scores(self, ids, keep=False):
        f, kept_f = self._run(self.p["xf"][ids], self.p["uf"], keep)
        b, kept_b = self._run(self.p["xb"][ids[:, ::-1]], self.p["ub"], keep)
        both = np.concatenate((f, b[:, ::-1]), axis=2)
        return both @ self.p["out"] + self.p["bias"], (both, kept_f, kept_b)

    def _chain(self, scores):
        """Scaled forward-backward: tag probabilities, and per step what pairs need."""
        n, steps, _ = scores.shape
        move = np.exp(np.where(self.allowed, self.p["trans"], _NEVER))
        e = np.exp(scores - scores.max(axis=2, keepdims=True))
        a = np.empty_like(scores)
        a[:, 0] = np.exp(self.p["start"]) * e[:, 0]
        a[:, 0] /= a[:, 0].sum(axis=1, keepdims=True)
        for s in range(1, steps):
            v = (a[:, s - 1] @ move) * e[:, s]
            a[:, s] = v / v.sum(axis=1, keepdims=True)
        b = np.empty_like(scores)
        b[:, -1] = np.exp(self.p["end"])
        for s in range(steps - 2, -1, -1):
            v = (e[:, s + 1] * b[:, s + 1]) @ move.T
            b[:, s] = v / v.sum(axis=1, keepdims=True)
        p = a * b
        return p / p.sum(axis=2, keepdims=True), (move, e, a, b)

    def gradient(self, ids: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Gradient of the mean negative log-likelihood of ``tags`` per window."""
        n, steps = ids.shape
        scores, (both, kept_f, kept_b) = self._scores(ids, keep=True)
        p, (move, e, a, b) = self._chain(scores)
        rows, cols = np.arange(n)[:, None], np.arange(steps)[None]
        d_scores = p.copy()
        d_scores[rows, cols, tags] -= 1
        d_scores /= n
        g = {"start": d_scores[:, 0].sum(axis=0), "end": d_scores[:, -1].sum(axis=0)}
        pair = np.zeros_like(self.p["trans"])
        for s in range(1, steps):
            right = e[:, s] * b[:, s]
            left = a[:, s - 1] / np.maximum((a[:, s - 1] @ move * right).sum(axis=1, keepdims=True), 1e-30)
            pair += (left.T @ right) * move
        np.add.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), -1)
        g["trans"] = np.where(self.allowed, pair / n, 0)
        h, flat = self.hidden, d_scores.reshape(-1, self.tags)
        g["out"], g["bias"] = both.reshape(-1, 2 * h).T @ flat, flat.sum(axis=0)
        d_both = d_scores @ self.p["out"].T
        d_f, g["uf"] = self._back(d_both[:, :, :h], self.p["uf"], kept_f)
        d_b, g["ub"] = self._back(d_both[:, ::-1, h:], self.p["ub"], kept_b)
        for name, d, of in (("xf", d_f, ids), ("xb", d_b, ids[:, ::-1])):
            order = np.argsort(of.ravel(), kind="stable")
            symbol, first = np.unique(of.ravel()[order], return_index=True)
            g[name] = np.zeros_like(self.p[name])
            g[name][symbol] = np.add.reduceat(d.reshape(-1, 4 * h)[order], first, axis=0)
        return g

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> float:
        """Mean negative log-likelihood per window, in double precision."""
        scores = self._scores(ids)[0].astype(np.float64)
        trans = np.where(self.allowed, self.p["trans"], _NEVER).astype(np.float64)
        a = self.p["start"] + scores[:, 0]
        rows = np.arange(len(ids))
        gold = a[rows, tags[:, 0]].copy()
        for s in range(1, ids.shape[1]):
            m = a[:, :, None] + trans
            top = m.max(axis=1)
            a = top + np.log(np.exp(m - top[:, None]).sum(axis=1)) + scores[:, s]
            gold += trans[tags[:, s - 1], tags[:, s]] + scores[rows, s, tags[:, s]]
        a = a + self.p["end"]
        gold += self.p["end"][tags[:, -1]]
        top = a.max(axis=1)
        return float((top + np.log(np.exp(a - top[:, None]).sum(axis=1)) - gold).mean())

    def train(self, ids: np.ndarray, tags: np.ndarray, *, epochs: int = 12, batch: int = 64, rate: float = 0.02, seed: int = 4) -> None:
        """Adam on shuffled batches, the rate falling to a tenth."""
        random, t = np.random.default_rng(seed), 0
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        total = max(1, epochs * -(-len(ids) // batch))
        for _ in range(epochs):
            order = random.permutation(len(ids))
            for i in range(0, len(ids), batch):
                some = order[i:i + batch]
                g = self.gradient(ids[some], tags[some])
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                t += 1
                now = rate * (1 - 0.9 * t / total)
                for k, v in g.items():
                    v = v * min(1.0, 5.0 / max(norm, 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * v
                    second[k] = 0.999 * second[k] + 0.001 * v * v
                    self.p[k] -= (now * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)).astype(np.float32)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best tag sequences (Viterbi) and the tags' probabilities."""
        n, steps = ids.shape
        scores, _ = self._scores(ids)
        trans = np.where(self.allowed, self.p["trans"], _NEVER)
        best = self.p["start"] + scores[:, 0]
        came = np.zeros((n, steps, self.tags), dtype=np.int8)
        for s in range(1, steps):
            m = best[:, :, None] + trans
            came[:, s] = m.argmax(axis=1)
            best = m.max(axis=1) + scores[:, s]
        tags = np.empty((n, steps), dtype=np.int64)
        tags[:, -1] = (best + self.p["end"]).argmax(axis=1)
        for s in range(steps - 1, 0, -1):
            tags[:, s - 1] = came[np.arange(n), s, tags[:, s]]
        return tags, self._chain(scores)[0]
