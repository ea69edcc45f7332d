"""Gated recurrent language model with a class-factored softmax, in numpy.

Token ids below ``FREQ`` are frequent words: id // CLASS_WORDS is the word's
class and the rest its slot. Ids from ``FREQ`` on are the rare classes, whose words
get a fixed share outside this model. The class softmax is over both kinds.
"""

from __future__ import annotations

import numpy as np

CLASSES, CLASS_WORDS, RARE = 16, 64, 48
FREQ = CLASSES * CLASS_WORDS
START = FREQ + RARE  # input before the first token
WIDTH, HIDDEN = 16, 24
STREAMS, WINDOW, UPDATES = 128, 32, 256  # as many streams as leave about UPDATES updates a pass, at most STREAMS
SCORE_WINDOW = 64  # steps of a window of a scoring at most
AHEAD = 1 << 14  # tokens of such a window, about
ENOUGH = 1 << 15  # tokens whose states wait for the softmax of a scoring
AT_ONCE = 4096  # tokens of a softmax held at once, so that they stay in the cache
SAFE = 80.0  # scores within this bound need no shift before exp


def new(counts: np.ndarray, rare_mass: np.ndarray, seed: int = 5) -> dict:
    """Parameters that reproduce the unigram shares of ``counts`` (FREQ) and ``rare_mass`` (RARE) before training."""
    r = np.random.default_rng(seed)
    g = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    grouped = counts.reshape(CLASSES, CLASS_WORDS).astype(float)
    mass = np.append(grouped.sum(1), rare_mass) + 0.5
    word = np.where(grouped > 0, np.log(np.maximum(grouped, 1)), -20.0)
    return {"E": g(START + 1, WIDTH), "Wx": g(WIDTH, 3 * HIDDEN), "bx": np.zeros(3 * HIDDEN, np.float32), "Wh": g(HIDDEN, 3 * HIDDEN),
            "Wc": np.zeros((HIDDEN, CLASSES + RARE), np.float32), "bc": np.log(mass / mass.sum()).astype(np.float32),
            "Ww": np.zeros((CLASSES, HIDDEN, CLASS_WORDS), np.float32),
            "bw": (word - np.log(np.exp(word).sum(1, keepdims=True))).astype(np.float32)}


def pack(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)]).astype(np.float32)


def unpack(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _cell(h, xz, wh, hz=None, gates=None, cand=None):
    """New state (hidden, columns) after one step; the hidden products, gates and candidate are left in the given arrays.

    ``xz`` and ``wh`` come from :func:`_halved`: a gate is 1 / (1 + exp(-x)) = (1 + tanh(x / 2)) / 2."""
    hz = np.matmul(wh, h, out=hz)
    s = np.add(hz[:2 * HIDDEN], xz[:2 * HIDDEN], out=gates)
    np.tanh(s, out=s)
    s *= 0.5
    s += 0.5
    n = np.multiply(s[:HIDDEN], hz[2 * HIDDEN:], out=cand)
    n += xz[2 * HIDDEN:]
    np.tanh(n, out=n)
    new = h - n
    new *= s[HIDDEN:]
    new += n
    return new


def _halved(weight):
    """Weights of gates and candidate, turned (a row for a gate), those of the gates halved."""
    out = weight.T.copy()
    out[:2 * HIDDEN] *= 0.5
    return out


def _join(weight, bias):
    """Weights with their bias as a last row, for inputs that end in a one."""
    return np.concatenate([weight, bias[..., None, :]], -2)


def _embed(p):
    """The inputs of all ids, a one after each."""
    return np.concatenate([p["E"], np.ones((START + 1, 1), np.float32)], 1)


def _turned(x):
    return np.swapaxes(x, -1, -2)


def _small(weight) -> bool:
    """Whether no score of a state (each part within -1 and 1, and a one) can leave the range of ``exp``."""
    return bool(np.abs(weight).sum(-2).max() < SAFE)


def _softmax(x, at, small):
    """Turns the scores ``x`` (a column for a token, the last axis but one) into exponentials in place.

    Returns their sums and the log probability at the places ``at`` (one for each column). Scores that are not ``small`` are moved by their largest.
    """
    if not small:
        x -= x.max(-2, keepdims=True)
    got = x[at]
    np.exp(x, out=x)
    total = x.sum(-2)
    return total, got - np.log(total)


def _by_class(cls):
    """The frequent tokens sorted by class: their places, and (class, first, end) of each class that occurs."""
    order = np.argsort(cls.astype(np.int16), kind="stable")
    bound = np.searchsorted(cls[order], np.arange(CLASSES + 1))
    return order[:bound[-1]], [(c, bound[c], bound[c + 1]) for c in range(CLASSES) if bound[c] < bound[c + 1]]


def _update(p, m, v, step, ids, target, fresh, h, rate):
    """One truncated-backpropagation update over a (streams, window) block; returns the state after it."""
    n, length = ids.shape
    # time first, then features, then streams: a step's gates lie together and its products need no other order
    ids, target, fresh = ids.T, target.T, fresh.T
    xin = _embed(p)[ids]
    xz = _halved(_join(p["Wx"], p["bx"])) @ _turned(xin)
    anew = fresh.any(1)
    room = lambda k: np.empty((length, k, n), xz.dtype)
    prev, hs, hz, gates, cand = room(HIDDEN), room(HIDDEN + 1), room(3 * HIDDEN), room(2 * HIDDEN), room(HIDDEN)
    hs[:, HIDDEN] = 1
    h = h.T.astype(xz.dtype)
    to_hid = _halved(p["Wh"])
    for t in range(length):
        if anew[t]:
            h = np.where(fresh[t], xz.dtype.type(0), h)
        prev[t] = h
        hs[t, :HIDDEN] = h = _cell(h, xz[t], to_hid, hz[t], gates[t], cand[t])
    cls = np.where(target < FREQ, target // CLASS_WORDS, target - FREQ + CLASSES)
    total = target.size
    wc, ww = _join(p["Wc"], p["bc"]), _join(p["Ww"], p["bw"])
    at = (np.arange(length)[:, None], cls, np.arange(n))
    d = wc.T @ hs
    d *= np.reciprocal(_softmax(d, at, _small(wc))[0])[:, None]
    d[at] -= 1
    dwc = (hs @ _turned(d)).sum(0)
    grad = {"Wc": dwc[:HIDDEN], "bc": dwc[HIDDEN], "Ww": np.zeros_like(p["Ww"]), "bw": np.zeros_like(p["bw"])}
    dh_all = p["Wc"] @ d
    cls, goal, small = cls.ravel(), target.ravel(), _small(ww)
    order, parts = _by_class(cls)
    mine, slot, back = _turned(hs).reshape(-1, HIDDEN + 1)[order], goal[order] % CLASS_WORDS, np.zeros((total, HIDDEN), xz.dtype)
    found = np.empty((len(order), HIDDEN), xz.dtype)
    for c, i, j in parts:
        at = (slot[i:j], np.arange(j - i))
        e = ww[c].T @ mine[i:j].T
        e *= np.reciprocal(_softmax(e, at, small)[0])
        e[at] -= 1
        de = (e @ mine[i:j]).T
        grad["Ww"][c], grad["bw"][c] = de[:HIDDEN], de[HIDDEN]
        found[i:j] = e.T @ p["Ww"][c].T
    back[order] = found
    dh_all += _turned(back.reshape(length, n, HIDDEN))
    r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
    # a step's gradients are products with these, whatever the step after it gives
    to_cand = (1 - z) * (1 - cand * cand)
    to_r = hz[:, 2 * HIDDEN:] * r * (1 - r)
    to_z = (prev - cand) * z * (1 - z)
    dn, dhz = room(HIDDEN), room(3 * HIDDEN)
    dh = np.zeros((HIDDEN, n), xz.dtype)
    for t in range(length - 1, -1, -1):
        dh += dh_all[t]
        one, hid = np.multiply(dh, to_cand[t], out=dn[t]), dhz[t]
        np.multiply(one, to_r[t], out=hid[:HIDDEN])
        np.multiply(dh, to_z[t], out=hid[HIDDEN:2 * HIDDEN])
        np.multiply(one, r[t], out=hid[2 * HIDDEN:])
        dh *= z[t]
        dh += p["Wh"] @ hid
        if anew[t]:
            dh = np.where(fresh[t], xz.dtype.type(0), dh)
    grad["Wh"] = (prev @ _turned(dhz)).sum(0)
    dxz = dhz
    dxz[:, 2 * HIDDEN:] = dn
    dwx = (_turned(xin) @ _turned(dxz)).sum(0)
    grad["Wx"], grad["bx"] = dwx[:WIDTH], dwx[WIDTH]
    dx, ids = (p["Wx"] @ dxz).swapaxes(0, 1).reshape(WIDTH, -1), ids.ravel()
    grad["E"] = np.stack([np.bincount(ids, x, minlength=START + 1) for x in dx], 1).astype(xz.dtype)
    lr = float(rate * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step))
    for k, g in grad.items():
        g = g / total
        m[k] *= 0.9
        m[k] += 0.1 * g
        g *= g
        g *= 0.001
        v[k] *= 0.999
        v[k] += g
        move = np.sqrt(v[k])
        move += 1e-6
        np.divide(m[k], move, out=move)
        move *= lr
        p[k] = (p[k] - move).astype(np.float32)
    return h.T


def train(p: dict, ids: np.ndarray, first: np.ndarray, rate: float) -> dict:
    """``p`` after one pass over the tokens ``ids`` (``first`` marks a document's first), dealt to parallel streams."""
    p = dict(p)
    n = len(ids)
    streams = max(1, min(STREAMS, n // (UPDATES * WINDOW)))
    length = -(-n // streams)
    pad = streams * length - n
    goal = np.append(ids, ids[:pad]).reshape(streams, length)
    fresh = np.append(first, np.ones(pad, bool)).reshape(streams, length).copy()
    before = np.append([START], np.append(ids, ids[:pad])[:-1]).reshape(streams, length).copy()
    fresh[:, 0] = True
    before[fresh] = START
    m = {k: np.zeros_like(x) for k, x in p.items()}
    v = {k: np.zeros_like(x) for k, x in p.items()}
    h = np.zeros((streams, HIDDEN), np.float32)
    steps = -(-length // WINDOW)
    for i in range(steps):
        s = slice(i * WINDOW, (i + 1) * WINDOW)
        h = _update(p, m, v, i + 1, before[:, s], goal[:, s], fresh[:, s], h, rate * (1 - 0.9 * i / steps))
    return p


def _costs(p, states, goal):
    """Log probability of each token ``goal`` after its row of ``states`` (hidden and a one)."""
    wc, ww = _join(p["Wc"], p["bc"]), _join(p["Ww"], p["bw"])
    cls = np.where(goal < FREQ, goal // CLASS_WORDS, goal - FREQ + CLASSES)
    got, small = np.empty(len(goal), np.float32), _small(wc)
    for i in range(0, len(goal), AT_ONCE):
        at = cls[i:i + AT_ONCE]
        got[i:i + AT_ONCE] = _softmax(wc.T @ states[i:i + AT_ONCE].T, (at, np.arange(len(at))), small)[1]
    mine, parts = _by_class(cls)
    within, slot, small = states[mine], goal[mine] % CLASS_WORDS, _small(ww)
    found = np.empty(len(mine), np.float32)
    for c, first, end in parts:
        for i in range(first, end, AT_ONCE):
            j = min(end, i + AT_ONCE)
            found[i:j] = _softmax(ww[c].T @ within[i:j].T, (slot[i:j], np.arange(j - i)), small)[1]
    got[mine] += found
    return got


def log_likelihood(p: dict, ids: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Natural log probability of each document ids[bound[i]:bound[i+1]] (classes, and frequent words in their class).

    Documents run side by side, longest first, in windows whose last state is carried on. The states of a window wait
    until there are enough for the softmax, so that the windows of few long documents cost no more of it than others.
    """
    size = np.diff(bound)
    order = np.argsort(-size, kind="stable")
    embed, wx, wh = _embed(p), _halved(_join(p["Wx"], p["bx"])), _halved(p["Wh"])
    out = np.zeros(len(size))
    longest = size[order]
    h = np.zeros((HIDDEN, len(size)), np.float32)
    waiting, held, t0 = [], 0, 0

    def settle():
        states, goal, doc = (np.concatenate(x) for x in zip(*waiting))
        np.add(out, np.bincount(doc, _costs(p, states, goal).astype(float), minlength=len(out)), out=out)

    while t0 < size.max(initial=0):
        live = int(np.searchsorted(-longest, -t0, "left"))  # documents longer than t0
        rows = order[:live]
        width = int(min(max(1, min(SCORE_WINDOW, AHEAD // live)), longest[0] - t0))
        at = bound[rows] + t0 + np.arange(width)[:, None]  # time first
        valid = np.arange(width)[:, None] < size[rows] - t0
        at = np.where(valid, at, 0)
        goal = ids[at]
        before = ids[at - 1]
        if t0 == 0:
            before[0] = START
        h = np.ascontiguousarray(h[:, :live])
        xz = wx @ _turned(embed[before])
        hs = np.ones((width, HIDDEN + 1, live), np.float32)
        for t in range(width):
            hs[t, :HIDDEN] = h = _cell(h, xz[t], wh)
        real = np.flatnonzero(valid)
        waiting.append((_turned(hs).reshape(-1, HIDDEN + 1)[real], goal.ravel()[real], rows[real % live]))
        held += len(real)
        t0 += width
        if held >= ENOUGH:
            settle()
            waiting, held = [], 0
    if waiting:
        settle()
    return out
