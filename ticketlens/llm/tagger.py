"""Character-level bidirectional LSTM with a CRF over its tag scores, in numpy.

Batches of equal-length windows of symbol numbers go through one LSTM in each
direction; a linear layer gives tag scores, and a linear-chain CRF with learnt
transitions gives the likelihood (training) and the best path and marginals
(decoding).  All arrays are float32 but the CRF's sums.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (np.tanh(0.5 * x) + 1)


@dataclass
class Tagger:
    """Parameters: per direction (symbol table, recurrent matrix), output layer, transitions."""

    hidden: int
    params: dict[str, np.ndarray]

    @classmethod
    def new(cls, symbols: int, tags: int, hidden: int, seed: int) -> Tagger:
        rs = np.random.RandomState(seed)
        p = {}
        for d in ("f", "b"):
            p[f"in_{d}"] = rs.normal(0, 0.3, (symbols, 4 * hidden)).astype(np.float32)
            p[f"in_{d}"][:, hidden : 2 * hidden] += 1  # forget gates begin open
            p[f"rec_{d}"] = rs.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden)).astype(np.float32)
        p["out"] = rs.normal(0, 1 / np.sqrt(2 * hidden), (2 * hidden, tags)).astype(np.float32)
        p["bias"] = np.zeros(tags, dtype=np.float32)
        p["trans"] = np.zeros((tags, tags), dtype=np.float32)
        p["first"] = np.zeros(tags, dtype=np.float32)
        return cls(hidden, p)

    def _lstm(self, x: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """Hidden states (time, batch, hidden) of symbols (time, batch); and what the way back needs."""
        n = self.hidden
        table, rec = self.params[f"in_{d}"], self.params[f"rec_{d}"]
        h = np.zeros((x.shape[1], n), dtype=np.float32)
        c = np.zeros_like(h)
        out = np.zeros((len(x), x.shape[1], n), dtype=np.float32)
        saved = []
        for t in range(len(x)):
            z = table[x[t]] + h @ rec
            s = _sigmoid(z[:, : 3 * n])
            g = np.tanh(z[:, 3 * n :])
            i, f, o = s[:, :n], s[:, n : 2 * n], s[:, 2 * n :]
            c_new = f * c + i * g
            th = np.tanh(c_new)
            if keep:
                saved.append((h, c, i, f, o, g, th))
            h, c = o * th, c_new
            out[t] = h
        return out, saved

    def _lstm_back(self, x: np.ndarray, d: str, saved: list, dout: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        n = self.hidden
        rec = self.params[f"rec_{d}"]
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        d_in, d_rec = np.zeros_like(self.params[f"in_{d}"]), np.zeros_like(rec)
        every = np.zeros((len(x), x.shape[1], 4 * n), dtype=dout.dtype)
        for t in range(len(x) - 1, -1, -1):
            h, c, i, f, o, g, th = saved[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - th * th)
            dz = np.concatenate([dc * g * i * (1 - i), dc * c * f * (1 - f), dh * th * o * (1 - o), dc * i * (1 - g * g)], axis=1)
            every[t] = dz
            d_rec += h.T @ dz
            dh, dc = dz @ rec.T, dc * f
        order = np.argsort(x, axis=None, kind="stable")
        used, first = np.unique(x.ravel()[order], return_index=True)
        d_in[used] = np.add.reduceat(every.reshape(-1, 4 * n)[order], first, axis=0)
        grad[f"in_{d}"], grad[f"rec_{d}"] = d_in, d_rec

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Tag scores (batch, time, tags) of symbols (batch, time)."""
        xt = x.T
        fwd, _ = self._lstm(xt, "f", False)
        bwd, _ = self._lstm(xt[::-1], "b", False)
        states = np.concatenate([fwd, bwd[::-1]], axis=2)
        return (states @ self.params["out"] + self.params["bias"]).transpose(1, 0, 2)

    def _marginals(self, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(tag marginals, expected transitions, log partition) of scores (batch, time, tags)."""
        trans, first = self.params["trans"].astype(np.float64), self.params["first"].astype(np.float64)
        e = e.astype(np.float64)
        n, steps, k = e.shape
        alpha, beta = np.zeros((steps, n, k)), np.zeros((steps, n, k))
        top = np.exp(trans - trans.max())
        alpha[0] = first + e[:, 0]
        for t in range(1, steps):
            m = alpha[t - 1].max(axis=1, keepdims=True)
            alpha[t] = np.log(np.exp(alpha[t - 1] - m) @ top) + m + trans.max() + e[:, t]
        for t in range(steps - 2, -1, -1):
            y = beta[t + 1] + e[:, t + 1]
            m = y.max(axis=1, keepdims=True)
            beta[t] = np.log(np.exp(y - m) @ top.T) + m + trans.max()
        m = alpha[-1].max(axis=1, keepdims=True)
        log_z = (np.log(np.exp(alpha[-1] - m).sum(axis=1, keepdims=True)) + m)[:, 0]
        gamma = np.exp(alpha + beta - log_z[None, :, None]).transpose(1, 0, 2)
        pair = np.zeros((k, k))
        for t in range(1, steps):
            right = beta[t] + e[:, t]
            a, b = alpha[t - 1].max(axis=1, keepdims=True), right.max(axis=1, keepdims=True)
            scale = np.exp(a + b - log_z[:, None] + trans.max())
            pair += (np.exp(alpha[t - 1] - a) * scale).T @ np.exp(right - b) * top
        return gamma, pair, log_z

    def gradient(self, x: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """(mean negative log-likelihood per symbol, its gradient) of one batch."""
        xt = x.T
        fwd, sf = self._lstm(xt, "f", True)
        bwd, sb = self._lstm(xt[::-1], "b", True)
        states = np.concatenate([fwd, bwd[::-1]], axis=2)
        e = (states @ self.params["out"] + self.params["bias"]).transpose(1, 0, 2)
        gamma, pair, log_z = self._marginals(e)
        n, steps, k = e.shape
        gold = np.eye(k)[tags]
        moves = np.zeros((k, k))
        np.add.at(moves, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        path = (e * gold).sum() + (moves * self.params["trans"]).sum() + self.params["first"][tags[:, 0]].sum()
        loss = float(log_z.sum() - path) / (n * steps)
        de = ((gamma - gold) / (n * steps)).transpose(1, 0, 2).astype(np.float32)
        grad = {
            "trans": ((pair - moves) / (n * steps)).astype(np.float32),
            "first": ((gamma[:, 0] - gold[:, 0]).sum(axis=0) / (n * steps)).astype(np.float32),
            "bias": de.sum(axis=(0, 1)),
            "out": np.tensordot(states, de, axes=([0, 1], [0, 1])),
        }
        dstates = de @ self.params["out"].T
        self._lstm_back(xt, "f", sf, dstates[:, :, : self.hidden], grad)
        self._lstm_back(xt[::-1], "b", sb, dstates[::-1, :, self.hidden :], grad)
        return loss, grad

    def train(self, x: np.ndarray, tags: np.ndarray, steps: int, batch: int, rate: float, seed: int) -> float:
        """Adam over random batches; the mean loss of the last tenth of the steps."""
        rs = np.random.RandomState(seed)
        m = {k: np.zeros_like(v) for k, v in self.params.items()}
        v = {k: np.zeros_like(p) for k, p in self.params.items()}
        losses = []
        for t in range(1, steps + 1):
            at = rs.randint(0, len(x), batch)
            loss, grad = self.gradient(x[at], tags[at])
            losses.append(loss)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            now = rate * min(1.0, 2 * (1 - t / (steps + 1))) * min(1.0, 1 / max(norm, 1e-9))
            for name, g in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                v[name] = 0.999 * v[name] + 0.001 * g * g
                self.params[name] -= now * (m[name] / (1 - 0.9**t)) / (np.sqrt(v[name] / (1 - 0.999**t)) + 1e-8)
        return float(np.mean(losses[-max(1, steps // 10) :]))

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best tags, their marginals), both (batch, time)."""
        e = self.scores(x)
        gamma, _, _ = self._marginals(e)
        n, steps, k = e.shape
        trans = self.params["trans"]
        best = self.params["first"] + e[:, 0]
        back = np.zeros((steps, n, k), dtype=np.int8)
        for t in range(1, steps):
            step = best[:, :, None] + trans[None]
            back[t] = step.argmax(axis=1)
            best = step.max(axis=1) + e[:, t]
        tags = np.zeros((n, steps), dtype=np.int64)
        tags[:, -1] = best.argmax(axis=1)
        for t in range(steps - 1, 0, -1):
            tags[:, t - 1] = back[t][np.arange(n), tags[:, t]]
        return tags, np.take_along_axis(gamma, tags[:, :, None], axis=2)[:, :, 0]
