"""Byte-level BPE encoding and decoding with batched numpy merge rounds.

The pre-tokens of a block of documents are numbered, and the distinct new ones
become one flat array of symbols. In each round the rank of every adjacent pair
is found by binary search over the sorted pair keys, each word takes its lowest
rank, and all places of that pair in the word (left to right, not overlapping)
are merged at once. Words without a known pair leave the array. Results are kept
in a bounded per-task store, so a word is merged once per refill of that store.

The tokenizer file (the JSON of the `tokenizers` library, its place is a
parameter) is read on the driver, about 1.5 MB, and broadcast. Strings of added
tokens inside a text become their own ids, as that library does by default.

Defined results: a null text counts as empty and has no ids; a null id list
decodes to the empty text; ids outside the vocabulary raise an error; repeated rows and ids are
independent rows; only the named columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import functools
import hashlib
import json
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F

from .frames import arrow_map, table

# fixed values: the pre-token pattern of the byte-level vocabularies
# (letters and digits are tried first and never given back: the same matches, found sooner)
PATTERN = r" ?\p{L}++| ?\p{N}++|'(?:s|t|re|ve|m|ll|d)| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"

BLOCK_CHARS = 1_000_000
STORE_WORDS = 200_000
_NONE = np.int64(1) << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = [], 0
    for b in range(256):
        out.append(chr(b) if b in keep else chr(256 + extra))
        extra += b not in keep
    return out


class Tokenizer:
    """Tables of one vocabulary and the words merged so far."""

    def __init__(self, blob: bytes):
        spec = json.loads(blob)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.first = np.array([vocab[c] for c in letters], np.int64)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order.astype(np.int64), made
        pieces = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        pieces |= {i: t.encode() for t, i in self.added.items()}
        table_ = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.known = np.array([i in pieces for i in range(len(table_))])
        self.piece_len = np.array([len(p) for p in table_], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(table_), np.uint8)
        self.words = regex.compile(PATTERN)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self._clear()

    def _clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.zeros(0, np.int64)
        self.at = np.zeros(1, np.int64)

    def pre_tokens(self, text: str) -> list[str]:
        if self.split is None or not any(t in text for t in self.added):
            return self.words.findall(text)
        out = []
        for piece in self.split.split(text):
            # a leading zero byte marks an added token: it is no part of any pre-token store key otherwise
            out += [("\0added", piece)] if piece in self.added else self.words.findall(piece)
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        k = (left << 32) | right
        at = np.searchsorted(self.key, k)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == k, self.rank[at], _NONE)

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, lengths) of the given words, in their order."""
        n = len(words)
        size = np.array([len(w) for w in words], np.int64)
        sym = self.first[np.frombuffer(b"".join(words), np.uint8)]
        word = np.repeat(np.arange(n), size)
        done_word, done_sym = [], []
        rank = np.full(len(sym), _NONE)
        if len(sym) > 1:
            near = np.flatnonzero(word[:-1] == word[1:])
            rank[near] = self._ranks(sym[near], sym[near + 1])
        while len(sym):
            start = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            low = np.minimum.reduceat(rank, start)
            count = np.diff(np.append(start, len(sym)))
            if (low == _NONE).any():
                over = np.repeat(low == _NONE, count)
                done_word.append(word[over])
                done_sym.append(sym[over])
                sym, word, rank = sym[~over], word[~over], rank[~over]
                count, low = count[low != _NONE], low[low != _NONE]
                if not len(sym):
                    break
            take = rank == np.repeat(low, count)
            # of places that overlap (a pair of equal symbols) every second one counts
            run = take & np.append(False, take[:-1])
            if run.any():
                index = np.arange(len(take))
                begun = np.maximum.accumulate(np.where(take & ~run, index, 0))
                take &= ((index - begun) & 1) == 0
            at = np.flatnonzero(take)
            sym[at] = self.made[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            stale = np.zeros(len(sym), bool)
            stale[at] = True
            sym, word, rank, stale = sym[keep], word[keep], rank[keep], stale[keep]
            stale[:-1] |= stale[1:]
            where = np.flatnonzero(stale)
            rank[where] = _NONE
            where = where[where < len(sym) - 1]
            where = where[word[where] == word[where + 1]]
            rank[where] = self._ranks(sym[where], sym[where + 1])
        if not done_word:
            return np.zeros(0, np.int64), np.zeros(n, np.int64)
        word, sym = np.concatenate(done_word), np.concatenate(done_sym)
        order = np.argsort(word, kind="stable")
        return sym[order], np.bincount(word, minlength=n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids per text)."""
        lists = [self.pre_tokens(t) for t in texts]
        per_text = np.array([len(x) for x in lists], np.int64)
        flat = np.empty(int(per_text.sum()), object)
        flat[:] = list(chain.from_iterable(lists))
        del lists
        code, distinct = pd.factorize(flat)
        if len(self.slot) > STORE_WORDS:
            self._clear()
        new = [w for w in distinct if w not in self.slot]
        if new:
            plain = [w for w in new if isinstance(w, str)]
            ids, size = self.merge([w.encode() for w in plain])
            special = [w for w in new if not isinstance(w, str)]
            ids = np.append(ids, np.array([self.added[w[1]] for w in special], np.int64))
            size = np.append(size, np.ones(len(special), np.int64))
            base = len(self.slot)
            self.slot.update((w, base + i) for i, w in enumerate(plain + special))
            self.ids = np.append(self.ids, ids)
            self.at = np.append(self.at, self.at[-1] + np.cumsum(size))
        slot = np.array([self.slot[w] for w in distinct], np.int64)[code] if len(distinct) else code
        size = self.at[slot + 1] - self.at[slot]
        ids = self.ids[spans(self.at[slot], size)]
        ends = np.append(0, np.cumsum(size))
        bound = np.append(0, np.cumsum(per_text))
        return ids, np.diff(ends[bound])

    def decode(self, ids: np.ndarray, per_text: np.ndarray) -> list[str]:
        if len(ids) and not ((ids >= 0) & (ids < len(self.known))).all() or not self.known[ids].all():
            raise ValueError("an id is not in the vocabulary")
        size = self.piece_len[ids]
        data = self.piece_bytes[spans(self.piece_at[ids], size)].tobytes()
        ends = np.append(0, np.cumsum(size))[np.append(0, np.cumsum(per_text))]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start..start+size-1 of every span, in a row."""
    return np.arange(int(size.sum())) + np.repeat(start - (np.cumsum(size) - size), size)


@functools.lru_cache(2)
def _tokenizer(blob: bytes) -> Tokenizer:
    return Tokenizer(blob)


def default_tokenizer() -> bytes:
    import public_tokenizers
    with open(public_tokenizers.path("byte_bpe_50k.json"), "rb") as f:
        return f.read()


def _parts(size: np.ndarray, most: int):
    """Row ranges whose sizes sum to about ``most``, one row at least."""
    total = np.append(0, np.cumsum(size))
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, "right")) - 1)
        yield i, j
        i = j


def encode(docs: DataFrame, tokenizer: bytes, carry: tuple[str, ...] | list[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """The columns ``carry``, ``ids`` (array<int>), ``n_tokens`` and ``ids_sha256`` (of the ids as
    little-endian unsigned 32-bit integers) of every whole text."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(tokenizer)

    def run(batches):
        tok = _tokenizer(shared.value)
        for batch in batches:
            texts = batch.column(len(carry)).fill_null("")
            size = np.array(pa.compute.utf8_length(texts), np.int64)
            for i, j in _parts(size, BLOCK_CHARS):
                ids, count = tok.encode(texts.slice(i, j - i).to_pylist())
                ids = ids.astype("<u4")
                end = np.append(0, np.cumsum(count))
                sha = [hashlib.sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(end[:-1], end[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in range(len(carry))]
                    + [pa.ListArray.from_arrays(pa.array(end.astype(np.int32)), pa.array(ids.astype(np.int32))),
                       pa.array(count), pa.array(sha)], names=[*carry, "ids", "n_tokens", "ids_sha256"])

    source = docs.select(*carry, F.col(text_col).cast("string").alias("_text"))
    empty = F.lit(None)
    schema = source.select(*carry, empty.cast("array<int>").alias("ids"), empty.cast("long").alias("n_tokens"),
                           empty.cast("string").alias("ids_sha256")).schema
    return arrow_map(source, run, schema)


def decode(encoded: DataFrame, tokenizer: bytes, ids_col: str = "ids", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """``encoded`` with the decoded ``text_col``, in place of ``ids_col`` or beside it."""
    shared = encoded.sparkSession.sparkContext.broadcast(tokenizer)
    rest = [c for c in encoded.columns if keep_ids or c != ids_col]
    schema = encoded.select(*rest, F.lit(None).cast("string").alias(text_col)).schema

    def run(batches):
        tok = _tokenizer(shared.value)
        for batch in batches:
            lists = batch.column(len(rest))
            size = np.array(pa.compute.list_value_length(lists).fill_null(0), np.int64)
            for i, j in _parts(size, BLOCK_CHARS):
                part = lists.slice(i, j - i)
                ids = np.asarray(part.flatten(), np.int64)
                texts = tok.decode(ids, size[i:j])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(i, j - i) for c in range(len(rest))] + [pa.array(texts, pa.string())],
                    names=[*rest, text_col])

    return arrow_map(encoded.select(*rest, F.col(ids_col).alias("_ids")), run, schema)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    tok = default_tokenizer()
    out = decode(encode(table(spark, sf_dir, "documents"), tok), tok)
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
