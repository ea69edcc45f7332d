"""Periodic runs of words, found on a Re-Pair grammar.

A run is a stretch of words with smallest period q and length of at least
``max(LEAST, TIMES * q)`` that no neighbouring word extends keeping the period.

The word ids of a block of documents are compressed by rounds of Re-Pair: in each round the
repeated pairs that are locally most frequent become nonterminals, so a round shortens
the sequence by a share and there are few. What no rule covers is the top of the grammar, read as
balanced halves. Each nonterminal is looked at once, at its first place: a run that lies in its
expansion and crosses the boundary of its two parts repeats, on the side where it is longer,
the four words next to the boundary one period away. Those places come from the sorted
list of four-word windows, and the stretch around each is measured by binary search over
prefix hashes. The stretches are then moved to every place where the nonterminal was derived,
and stretches of one period that overlap by the period or more are merged. A run lies
whole in the lowest expansion that holds it, so it is found whole there; pieces of it found elsewhere
vanish in the merge. Multiples of a period give the same stretch and yield to the smallest.
Found runs are compared word by word at the end; should two unlike stretches share a hash, the block is
measured again without hashes.

Documents are never cut: a block is about 3 MB of text or one longer document, whose memory and
time grow with its length (n log n). No text moves between tasks.

Defined results: words are runs of bytes outside 0x20 and 0x09-0x0D, compared byte by byte; a null,
empty or blank text has 0 words and no run; a null id is carried; repeated rows are each answered;
only the named columns are read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import textkit as tk
from .frames import arrow_map, table

# fixed values of the definition of a run
LEAST, TIMES = 24, 3
GRAM = 4                 # words next to a boundary that the longer side of a run repeats: min over q of max(LEAST / 2 - q, q / 2)
SLOWEST = 64             # rounds go on while one shortens the sequence by at least this part
SLICE = 1 << 21          # candidate places looked at together
_U = np.uint64
_BASE = tk.powers(2)[1]


def _pairs_to_replace(sym: np.ndarray, glued: np.ndarray, names: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose pair with the next symbol becomes a nonterminal this round, and the pairs' keys.

    ``glued[i]`` says that i and i + 1 belong to one document. Of overlapping pairs the more frequent one
    wins (ties: the larger key); equal overlapping pairs (a a a) are taken alternately.
    """
    at = np.flatnonzero(glued)
    key = sym[at] * names + sym[at + 1]
    order = np.argsort(key)
    new = np.append(True, np.diff(key[order]) != 0)
    count = np.diff(np.append(np.flatnonzero(new), len(order)))
    often = np.empty(len(order), np.int64)
    often[order] = count[np.cumsum(new) - 1]
    # rank of (frequency, key) on the whole sequence; -1 where there is no repeated pair
    freq, name = np.full(len(sym) + 2, -1, np.int64), np.full(len(sym) + 2, -1, np.int64)
    many = often > 1
    freq[at[many] + 1], name[at[many] + 1] = often[many], key[many]
    f, k = freq[1:-1], name[1:-1]
    left = (f > freq[:-2]) | ((f == freq[:-2]) & (k > name[:-2]))
    right = (f > freq[2:]) | ((f == freq[2:]) & (k > name[2:]))
    tied_left, tied_right = k == name[:-2], k == name[2:]
    run = f > 0
    head = run & ~tied_left
    first = np.maximum.accumulate(np.where(head, np.arange(len(sym)), 0))
    even = (np.arange(len(sym)) - first) % 2 == 0
    chosen = run & (left | tied_left) & (right | tied_right) & even
    pick = np.flatnonzero(chosen)
    # a stretch of ties may touch a chosen neighbour: the left one of two adjacent picks stays
    while True:
        clash = np.flatnonzero(np.diff(pick) == 1) + 1
        if not len(clash):
            return pick, k[pick]
        pick = np.delete(pick, clash[np.append(True, np.diff(clash) > 1)])


def grammar(word: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nodes of the grammar over ``word`` (dense ids) of documents ``doc``.

    Returns ``start, middle, end`` of each node's first derivation (places in ``word``) and
    ``node, place`` of all derivations. A node's expansion is ``word[start:end]``, its parts meet at ``middle``.
    """
    sym, pos = word.astype(np.int64), np.arange(len(word))
    size = np.ones(len(word), np.int64)
    names = int(sym.max()) + 1 if len(sym) else 1
    nodes, uses, made = [], [], 0
    while len(sym) > 1:
        glued = np.append(doc[pos[:-1]] == doc[pos[1:]], False)
        if not glued.any():
            break
        pick, key = _pairs_to_replace(sym, glued, names)
        if not len(pick):
            break
        _, first, rule = np.unique(key, return_index=True, return_inverse=True)
        at = pos[pick]
        mid = pos[pick + 1]
        end = mid + size[pick + 1]
        nodes.append((at[first], mid[first], end[first]))
        uses.append((rule + made, at))
        made += len(first)
        before = len(sym)
        sym[pick] = names + rule
        size[pick] = end - at
        keep = np.ones(before, bool)
        keep[pick + 1] = False
        sym, pos, size = sym[keep], pos[keep], size[keep]
        # dense names again, so that a pair's key stays below 2^63
        left, sym = np.unique(sym, return_inverse=True)
        sym, names = sym.astype(np.int64), len(left)
        if before - len(sym) < before / SLOWEST:
            break
    # the top: balanced halves over each document's remaining symbols
    if len(pos):
        of = doc[pos]
        first = np.searchsorted(of, of)
        last = np.searchsorted(of, of, "right")
        place = np.arange(len(pos)) - first
        step = 1
        while True:
            here = np.flatnonzero((place % (2 * step) == 0) & (np.arange(len(pos)) + step < last))
            if not len(here):
                break
            upto = np.minimum(here + 2 * step, last[here])
            end = pos[upto - 1] + size[upto - 1]
            nodes.append((pos[here], pos[here + step], end))
            uses.append((made + np.arange(len(here)), pos[here]))
            made += len(here)
            step *= 2
    if not nodes:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return (*(np.concatenate(c) for c in zip(*nodes)), *(np.concatenate(c) for c in zip(*uses)))


class _Plain:
    """Equality of stretches word by word, for texts built so that their prefix hashes meet."""

    def __init__(self, word: np.ndarray):
        self.word = word

    def same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = self.word
        return np.fromiter((np.array_equal(w[a:a + m], w[b:b + m]) for a, b, m in zip(i, j, n)), bool, len(i))

    def extend(self, i: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """Length, at most ``most``, of the common stretch that starts (``back``: ends) at i and j."""
        low, high = np.zeros(len(i), np.int64), most.copy()
        while (open_ := low < high).any():
            mid = (low + high + 1) // 2
            ok = self.same(i - mid, j - mid, mid) if back else self.same(i, j, mid)
            low = np.where(open_ & ok, mid, low)
            high = np.where(open_ & ~ok, mid - 1, high)
        return low


class _Hashes(_Plain):
    """Equality of stretches of ``word`` by polynomial prefix sums."""

    def __init__(self, word: np.ndarray):
        code = tk.mix(word.astype(np.uint64) + _U(0x9E37))
        self.power = tk.powers(len(word) + 1)
        self.sum = np.zeros(len(word) + 1, np.uint64)
        np.cumsum(code * self.power[:len(word)], out=self.sum[1:])

    def same(self, i: np.ndarray, j: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether ``n`` words from ``i`` and from ``j`` (i < j) are equal."""
        return (self.sum[i + n] - self.sum[i]) * self.power[j - i] == self.sum[j + n] - self.sum[j]


def _boundary(start, middle, end, hashes, listed, order, rank, gram) -> tuple[np.ndarray, ...]:
    """(node, start, end, period) of the repetitions that cross a node's boundary, right side or left side the longer."""
    found = [(np.zeros(0, np.int64),) * 4]
    n = len(gram)
    for back in (False, True):
        here = middle - GRAM if back else middle
        room = np.minimum((end - start) // TIMES, ((middle - start if back else end - middle) * 2) // TIMES)
        node = np.flatnonzero((room > 0) & (end - start >= LEAST) & (here >= start) & (here + GRAM <= end))
        node = node[gram[here[node]] >= 0]
        at = rank[here[node]]
        # the places of one window lie together, by place: those within reach end where binary search says
        g = gram[here[node]]
        if back:
            lo = np.searchsorted(listed, g * (n + 1) + np.maximum(here[node] - room[node], 0))
            hi = at
        else:
            lo = at + 1
            hi = np.searchsorted(listed, g * (n + 1) + here[node] + room[node], "right")
        many = np.maximum(hi - lo, 0)
        cut = np.append(0, np.cumsum(many))
        a = 0
        while a < len(node):
            b = max(a + 1, int(np.searchsorted(cut, cut[a] + SLICE, "right")) - 1)
            m = many[a:b]
            x = np.repeat(node[a:b], m)
            to = order[np.repeat(lo[a:b], m) + np.arange(len(x)) - np.repeat(cut[a:b] - cut[a], m)]
            a = b
            q = np.abs(to - here[x])
            i, j = (middle[x] - q, middle[x]) if back else (middle[x], middle[x] + q)
            need = np.maximum(LEAST // 2 - q, (q + 1) // 2)
            fits = (i - need >= start[x]) if back else (j + need <= end[x])
            x, q, i, j, need = (v[fits] for v in (x, q, i, j, need))
            ok = hashes.same(i - need, j - need, need) if back else hashes.same(i, j, need)
            x, q, i, j = (v[ok] for v in (x, q, i, j))
            s = i - hashes.extend(i, j, i - start[x], True)
            e = j + hashes.extend(i, j, end[x] - j, False)
            long = e - s >= np.maximum(LEAST, TIMES * q)
            found.append((x[long], s[long], e[long], q[long]))
    return tuple(np.concatenate(c) for c in zip(*found))


def _groups(*cols) -> np.ndarray:
    """True at the first row of each group of equal rows (rows already ordered)."""
    new = np.ones(len(cols[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
    return new


def find_runs(word: np.ndarray, doc: np.ndarray, equality=_Hashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in ``word`` (dense ids), ordered by start, then period; none spans two documents."""
    none = tuple(np.zeros(0, np.int64) for _ in range(3))
    n = len(word)
    if n < LEAST:
        return none
    start, middle, end, node, place = grammar(word, doc)
    hashes = equality(word)
    gram = np.full(n, -1, np.int64)
    inside = np.flatnonzero(doc[:n - GRAM + 1] == doc[GRAM - 1:])
    if not len(inside):
        return none
    value = sum(hashes_of * tk.GRAM_CODE[t] for t, hashes_of in enumerate(tk.mix(word[inside + t].astype(np.uint64) + _U(1)) for t in range(GRAM)))
    # a window repeats only within its document, so the document is part of its name
    value = tk.mix(value + doc[inside].astype(np.uint64) * _BASE)
    gram[inside] = np.unique(value, return_inverse=True)[1]
    listed = np.sort(gram * (n + 1) + np.arange(n))
    order = listed % (n + 1)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    x, s, e, q = _boundary(start, middle, end, hashes, listed, order, rank, gram)
    if not len(x):
        return none
    # the smallest period of each stretch, then its copies at all derivations of the node
    by = np.lexsort((q, e, s, x))
    by = by[_groups(x[by], s[by], e[by])]
    x, s, e, q = x[by], s[by] - start[x[by]], e[by] - start[x[by]], q[by]
    uses = np.argsort(node, kind="stable")
    lo, hi = np.searchsorted(node[uses], x), np.searchsorted(node[uses], x, "right")
    many = hi - lo
    which = np.repeat(np.arange(len(x)), many)
    base = place[uses[np.repeat(lo, many) + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)]]
    s, e, q = s[which] + base, e[which] + base, q[which]
    # stretches of one period that share a period's length are parts of one run
    by = np.lexsort((e, s, q))
    s, e, q = s[by], e[by], q[by]
    lane = (np.cumsum(_groups(q)) - 1) * (2 * n + 2)
    reach = np.maximum.accumulate(e + lane)
    new = np.append(True, (s + lane)[1:] > reach[:-1] - q[1:])
    head = np.flatnonzero(new)
    s, q, e = s[head], q[head], np.maximum.reduceat(e, head)
    by = np.lexsort((q, e, s))
    by = by[_groups(s[by], e[by])]
    s, e, q = s[by], e[by], q[by]
    for a, b, p in zip(s.tolist(), e.tolist(), q.tolist()):
        if not np.array_equal(word[a:b - p], word[a + p:b]):
            return find_runs(word, doc, _Plain)
    by = np.lexsort((q, s))
    return s[by], e[by], q[by]


def rewritten(n: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a, p) per document of ``n`` words and id hash ``h``: from word a on, words repeat with period p; p = 0: as they are."""
    g = h // 10
    some = (h >= 0) & (h % 10 == 0) & (n > 0)
    a = np.where(some, g % np.maximum(n, 1), 0)
    return a, np.where(some, 1 + (n - a) // (3 + g % 8), 0)


def _of_block(data: np.ndarray, off: np.ndarray, h: np.ndarray) -> list[tuple]:
    """Digest columns of the documents of a block."""
    words = tk.Words(data, off)
    n, first = words.per_row, words.bound[:-1]
    a, p = rewritten(n, h)
    source = np.arange(len(words.start))
    for r in np.flatnonzero(p):
        i = np.arange(a[r], n[r])
        source[first[r] + i] = first[r] + a[r] + (i - a[r]) % p[r]
    ids = np.unique(words.hashes(), return_inverse=True)[1][source] if len(source) else source
    s, e, q = find_runs(ids, words.row)
    owner = words.row[s] if len(s) else s
    lo, hi = np.searchsorted(owner, np.arange(words.rows)), np.searchsorted(owner, np.arange(words.rows), "right")
    drop = np.zeros(len(source) + 1, np.int64)
    np.add.at(drop, s + q, 1)
    np.add.at(drop, e, -1)
    drop = np.cumsum(drop)[:-1] > 0
    out = []
    for r in range(words.rows):
        raw = data[off[r]:off[r + 1]].tobytes().split()
        f = int(first[r])
        if p[r] or hi[r] > lo[r]:
            part = slice(f, f + int(n[r]))
            raw = [raw[i - f] for i in source[part][~drop[part]].tolist()]
        best, listed = (None,) * 4, b""
        if hi[r] > lo[r]:
            rows = [(int(x) - f, int(y - x), int(z)) for x, y, z in zip(*(v[lo[r]:hi[r]] for v in (s, e, q)))]
            listed = "".join(f"{x},{y},{z}\n" for x, y, z in rows).encode()
            top = rows[0]
            for row in rows[1:]:  # by start, then period: only a greater exponent takes over
                if row[1] * top[2] > top[1] * row[2]:
                    top = row
            best = (*top, 1000 * top[1] // top[2])
        out.append((int(hi[r] - lo[r]), *best, hashlib.sha256(listed).hexdigest(), hashlib.sha256(b" ".join(raw)).hexdigest()))
    return out


COLUMNS = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def run_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rewrite: bool = False) -> DataFrame:
    """``id_col`` and the runs of each whole text: number, the one of the greatest exponent, digests of all
    runs and of the text without repetitions. ``rewrite`` first plants periods by the id's hash."""
    kinds = [pa.int64()] * 5 + [pa.string()] * 2
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batches):
        for batch in batches:
            data, off = tk.text_buffers(batch.column(1))
            h = batch.column(2).to_numpy(zero_copy_only=False)
            for i, j in tk.blocks(off):
                rows = _of_block(data[off[i]:off[j]], off[i:j + 1] - off[i], h[i:j])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *(pa.array(c, k) for c, k in zip(zip(*rows), kinds))],
                                                 names=[id_col, *names])

    h = F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(-1)) if rewrite else F.lit(-1)
    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string"), h.cast("long").alias("_h")), run,
                     f"`{id_col}` {kind}, {COLUMNS}")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_table(table(spark, sf_dir, "documents"), rewrite=True)
