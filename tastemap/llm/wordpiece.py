"""Greedy word-piece token counts by a linear longest-match automaton.

The vocabulary is split into pieces that begin a word and pieces that continue one
(for a byte-level vocabulary: pieces with and without the leading space mark).
Both live in one trie over bytes, the beginning pieces under the space byte and the
others under the root of continuations. Each node has a failure link, to the
node that is left over when the longest pieces of its string are cut off from the left, and
the number of pieces popped on that way, both computed once in breadth-first order. A word is then
read byte by byte: a missing edge follows the failure link and adds its popped count,
so the number of greedy longest-match pieces comes out in linear time without
building any piece. All distinct words of a block move through the
automaton together; transitions are found by binary search over sorted (node, byte) keys.

Words are runs of bytes outside 0x20 and 0x09-0x0D, case kept; each counts as if a
space stood before it. Every byte is in the vocabulary, so each word has a split.

Defined results: null, empty and blank texts have 0 words and 0 tokens; null ids are carried;
repeated rows are counted one by one; only the named columns are read. A vocabulary without some
byte (other than the space) raises an error.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import textkit as tk
from .bpe import byte_letters, default_tokenizer
from .frames import arrow_map, table


class Automaton:
    """Trie with failure links and popped counts over ``begin`` and ``inner`` pieces (bytes).

    Node 0 is the root of continuing pieces; beginning pieces hang below a node of
    their own, which is where every word starts.
    """

    def __init__(self, begin: set[bytes], inner: set[bytes]):
        if len({p for p in inner if len(p) == 1} - {b" "}) < 255:
            raise ValueError("every byte but the space must be a continuing piece")
        children: list[dict[int, int]] = [{}, {}]
        piece = [False, False]
        for root, pieces in ((0, inner), (1, begin)):
            for p in pieces:
                node = root
                for b in p:
                    nxt = children[node].get(b)
                    if nxt is None:
                        nxt = len(children)
                        children[node][b] = nxt
                        children.append({})
                        piece.append(False)
                    node = nxt
                piece[node] = len(p) > 0
        n = len(children)
        fail, pops = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        fail[1] = 0  # without any beginning piece a word is left to the continuing ones
        # breadth first: links of shorter strings are known when longer ones need them
        queue = [0, 1]
        for node in queue:
            for b, child in children[node].items():
                queue.append(child)
                if piece[child]:
                    fail[child], pops[child] = 0, 1
                    continue
                at, popped = int(fail[node]), int(pops[node])
                while at >= 0 and b not in children[at]:
                    popped += int(pops[at])
                    at = int(fail[at])
                if at >= 0:
                    fail[child], pops[child] = children[at][b], popped
        self.fail, self.pops = fail, pops
        key = np.array([(i << 8) | b for i, c in enumerate(children) for b in c], np.int64)
        to = np.array([v for c in children for v in c.values()], np.int64)
        order = np.argsort(key)
        self.key, self.to = key[order], to[order]
        # the two roots have dense tables, most words pass them
        self.dense = np.full((2, 256), -1, np.int64)
        for r in (0, 1):
            for b, v in children[r].items():
                self.dense[r, b] = v

    def _next(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        out = np.empty(len(node), np.int64)
        low = node < 2
        out[low] = self.dense[node[low], byte[low]]
        rest = ~low
        k = (node[rest] << 8) | byte[rest]
        at = np.searchsorted(self.key, k)
        at[at == len(self.key)] = 0
        out[rest] = np.where(self.key[at] == k, self.to[at], -1)
        return out

    def counts(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word data[start:end]."""
        size = end - start
        order = np.argsort(-size, kind="stable")
        start, size = start[order], size[order]
        node, total = np.ones(len(order), np.int64), np.zeros(len(order), np.int64)
        for t in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -t, "left"))
            byte = data[start[:live] + t].astype(np.int64)
            todo = np.arange(live)
            while len(todo):
                to = self._next(node[todo], byte[todo])
                hit = to >= 0
                node[todo[hit]] = to[hit]
                todo = todo[~hit]
                here = node[todo]
                total[todo] += self.pops[here]
                node[todo] = np.maximum(self.fail[here], 0)
        # what is still held is popped to the end
        todo = np.flatnonzero(node > 1)
        while len(todo):
            here = node[todo]
            total[todo] += self.pops[here]
            node[todo] = np.maximum(self.fail[here], 0)
            todo = todo[node[todo] > 1]
        out = np.empty(len(order), np.int64)
        out[order] = total
        return out


def pieces(tokenizer: bytes) -> tuple[set[bytes], set[bytes]]:
    """(beginning, continuing) pieces of a byte-level vocabulary; the space mark is dropped from the former."""
    back = {c: b for b, c in enumerate(byte_letters())}
    vocab = json.loads(tokenizer)["model"]["vocab"]
    begin, inner = set(), set()
    for token in vocab:
        raw = bytes(back[c] for c in token) if all(c in back for c in token) else b""
        if raw[:1] == b" ":
            begin.add(raw[1:])
        elif raw:
            inner.add(raw)
    return begin - {b""}, inner


@functools.lru_cache(2)
def _automaton(tokenizer: bytes) -> Automaton:
    return Automaton(*pieces(tokenizer))


def token_counts(docs: DataFrame, tokenizer: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_words`` and ``n_tokens`` of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)

    def run(batches):
        auto = _automaton(shared.value)
        for batch in batches:
            data, off = tk.text_buffers(batch.column(1))
            for i, j in tk.blocks(off):
                words = tk.Words(data[off[i]:off[j]], off[i:j + 1] - off[i])
                _, first, same = np.unique(words.hashes(), return_index=True, return_inverse=True)
                n = auto.counts(words.data, words.start[first], words.end[first])[same]
                total = np.bincount(words.row, n, minlength=j - i).astype(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(words.per_row), pa.array(total)],
                                                 names=[id_col, "n_words", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string")), run, f"`{id_col}` {kind}, n_words long, n_tokens long")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), default_tokenizer())
