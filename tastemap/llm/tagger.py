"""Character-level bidirectional LSTM with CRF transitions, in numpy."""

from __future__ import annotations

import numpy as np


def _sig(x):
    return 1.0 / (1.0 + np.exp(-x))


def _lse(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


class Tagger:
    """Tags of fixed-length windows of character codes; ``allowed`` (k, k) masks tag transitions."""

    def __init__(self, n_codes: int, n_tags: int, allowed: np.ndarray, width: int = 8, hidden: int = 12, seed: int = 7):
        r = np.random.default_rng(seed)
        g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        z = lambda *s: np.zeros(s, np.float32)
        self.h = hidden
        self.mask = np.where(allowed, 0, -1e4).astype(np.float32)
        self.p = {"E": g(n_codes, width) * 3, "Wo": g(2 * hidden, n_tags), "bo": z(n_tags), "T": z(n_tags, n_tags)}
        for d in "fb":
            self.p |= {f"Wx{d}": g(width, 4 * hidden), f"Wh{d}": g(hidden, 4 * hidden), f"b{d}": z(4 * hidden)}
            self.p[f"b{d}"][hidden:2 * hidden] = 1.0

    def _lstm(self, x, d: str, keep: bool):
        n, length, _ = x.shape
        h = self.h
        xw = x @ self.p["Wx" + d] + self.p["b" + d]
        hs, cs, gates = np.zeros((length + 1, n, h), np.float32), np.zeros((length + 1, n, h), np.float32), []
        for t in range(length):
            z = xw[:, t] + hs[t] @ self.p["Wh" + d]
            s = _sig(z[:, :3 * h])
            g = np.tanh(z[:, 3 * h:])
            cs[t + 1] = s[:, h:2 * h] * cs[t] + s[:, :h] * g
            tc = np.tanh(cs[t + 1])
            hs[t + 1] = s[:, 2 * h:] * tc
            if keep:
                gates.append((s, g, tc))
        return hs, cs, gates

    def _lstm_back(self, x, d, hs, cs, gates, dout, grad):
        n, length, _ = x.shape
        h = self.h
        dz = np.zeros((n, length, 4 * h), np.float32)
        dh, dc = np.zeros((n, h), np.float32), np.zeros((n, h), np.float32)
        for t in range(length - 1, -1, -1):
            s, g, tc = gates[t]
            i, f, o = s[:, :h], s[:, h:2 * h], s[:, 2 * h:]
            dh = dh + dout[:, t]
            dc = dc + dh * o * (1 - tc * tc)
            dz[:, t] = np.concatenate([dc * g * i * (1 - i), dc * cs[t] * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], 1)
            dc = dc * f
            dh = dz[:, t] @ self.p["Wh" + d].T
        grad["Wx" + d] = np.einsum("nte,ntz->ez", x, dz)
        grad["Wh" + d] = np.einsum("tnh,ntz->hz", hs[:-1], dz)
        grad["b" + d] = dz.sum((0, 1))
        return dz @ self.p["Wx" + d].T

    def _emit(self, codes, keep=False):
        x = self.p["E"][codes]
        f = self._lstm(x, "f", keep)
        b = self._lstm(x[:, ::-1], "b", keep)
        both = np.concatenate([f[0][1:].transpose(1, 0, 2), b[0][1:][::-1].transpose(1, 0, 2)], 2)
        return x, f, b, both, both @ self.p["Wo"] + self.p["bo"]

    def _chains(self, u):
        tr = self.p["T"] + self.mask
        n, length, k = u.shape
        a, b = np.empty_like(u), np.zeros_like(u)
        a[:, 0] = u[:, 0]
        for t in range(1, length):
            a[:, t] = u[:, t] + _lse(a[:, t - 1][:, :, None] + tr, 1)
        for t in range(length - 2, -1, -1):
            b[:, t] = _lse(tr + (u[:, t + 1] + b[:, t + 1])[:, None, :], 2)
        return tr, a, b, _lse(a[:, -1], 1)

    def step(self, codes, tags):
        """Loss and gradients of a batch."""
        x, f, b, both, u = self._emit(codes, True)
        tr, al, be, z = self._chains(u)
        n, length, k = u.shape
        marg = np.exp(al + be - z[:, None, None])
        hot = np.eye(k, dtype=np.float32)[tags]
        du = (marg - hot) / n
        dt = np.zeros((k, k), np.float32)
        for t in range(1, length):
            dt += np.exp(al[:, t - 1][:, :, None] + tr + (u[:, t] + be[:, t])[:, None, :] - z[:, None, None]).sum(0)
        pair = np.zeros((k, k), np.float32)
        np.add.at(pair, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        gold = np.take_along_axis(u, tags[:, :, None], 2).sum() + (tr * pair).sum()
        grad = {"T": (dt - pair) / n, "Wo": np.einsum("nth,ntk->hk", both, du), "bo": du.sum((0, 1))}
        dboth = du @ self.p["Wo"].T
        h = self.h
        dx = self._lstm_back(x, "f", *f, dboth[:, :, :h], grad)
        dx = dx + self._lstm_back(x[:, ::-1], "b", *b, dboth[:, ::-1, h:], grad)[:, ::-1]
        grad["E"] = np.zeros_like(self.p["E"])
        np.add.at(grad["E"], codes, dx)
        return float((z.sum() - gold) / n), grad

    def fit(self, codes, tags, steps: int, batch: int = 32, rate: float = 0.03, seed: int = 11):
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.p.items()}
        step, total = 0, steps
        while step < total:
            order = r.permutation(len(codes))
            for i in range(0, min(len(order), (total - step) * batch), batch):
                _, grad = self.step(codes[order[i:i + batch]], tags[order[i:i + batch]])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                step += 1
                lr = rate * (1 - step / (total + 1)) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
                for k, g in grad.items():
                    g = g * min(1.0, 5.0 / (norm + 1e-9))
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v2[k] = 0.999 * v2[k] + 0.001 * g * g
                    self.p[k] -= (lr * m[k] / (np.sqrt(v2[k]) + 1e-8)).astype(np.float32)
        return self

    def decode(self, codes):
        """(best tag path, its tags' marginal probabilities) of each window."""
        u = self._emit(codes)[4]
        tr, al, be, z = self._chains(u)
        n, length, k = u.shape
        back = np.empty((n, length, k), np.int8)
        score = u[:, 0]
        for t in range(1, length):
            s = score[:, :, None] + tr
            back[:, t] = s.argmax(1)
            score = u[:, t] + s.max(1)
        path = np.empty((n, length), np.int64)
        path[:, -1] = score.argmax(1)
        rows = np.arange(n)
        for t in range(length - 1, 0, -1):
            path[:, t - 1] = back[rows, t, path[:, t]]
        marg = np.exp(al + be - z[:, None, None])
        return path, np.take_along_axis(marg, path[:, :, None], 2)[:, :, 0]
