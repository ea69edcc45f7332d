"""Language identification by hierarchical discrimination.

A text is a vector of ``DIM`` hashed counts of its byte 1-, 2-, 3- and 4-grams (A-Z
lower-cased), square-rooted and scaled to length one. Languages whose mean
vectors are closest are merged into families until half as many families as
languages are left. A text first gets a family (one linear SVM per family against
the rest); then one-versus-one linear SVMs separate the languages of that
family by votes, ties by summed margins, then by name.

The SVMs are fitted in numpy on a bounded sample: the ``SAMPLE`` first documents by
(rank in their language, hash of the id), so the languages share it evenly
and it does not depend on partitioning. Prediction reads every whole text.

Defined results: a text that is null, empty or without any letter is ``und`` with score 0;
so is every text when nothing can be learned. Null ids are carried and take part in
learning as remainder 0; repeated rows are predicted one by one; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import textkit as tk
from .frames import arrow_map, crc_mod, table

DIM = 2048
NGRAMS = (1, 2, 3, 4)
SAMPLE = 1600
ROWS = 256
ROUNDS, PENALTY = 150, 1e-4
SHARPNESS = 6.0
_U = np.uint64
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True


def vectors(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(rows, DIM) unit vectors of the texts data[off[i]:off[i+1]]."""
    rows = len(off) - 1
    size = np.diff(off)
    row = np.repeat(np.arange(rows), size)
    left = np.repeat(off[1:], size) - np.arange(len(data))
    count = np.zeros(rows * DIM, np.int64)
    low = tk.LOWER[data].astype(np.uint32)
    packed = low + np.uint32(1)
    for n in range(1, max(NGRAMS) + 1):
        if n > 1:
            packed = packed[:-1] * np.uint32(0x01000193) ^ (low[n - 1:] * np.uint32(0x9E3779B1))
        if n in NGRAMS and len(packed):
            h = packed ^ (packed >> np.uint32(15))
            h *= np.uint32(0x2C1B3C6D)
            cell = row[:len(packed)] * DIM + (h >> np.uint32(21)).astype(np.int64)
            count += np.bincount(cell[left[:len(packed)] >= n], minlength=len(count))
    x = np.sqrt(count.reshape(rows, DIM).astype(np.float32))
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return x / np.maximum(norm, 1e-9)


assert DIM == 1 << 11  # the hash keeps 11 bits


def svm(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights (the last one is the bias) of an L2 linear SVM with squared hinge loss, by accelerated gradient."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], 1)
    share = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    w = v = np.zeros(x.shape[1], np.float32)
    rate = 1 / (4.0 + PENALTY)
    for t in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (x @ v))
        new = v - rate * (PENALTY * v - 2 * x.T @ (share * y * slack))
        v = new + t / (t + 3) * (new - w)
        w = new
    return w


def families_of(centres: np.ndarray) -> list[list[int]]:
    """Merge the closest groups (average cosine) until half as many groups as rows remain."""
    groups = [[i] for i in range(len(centres))]
    unit = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
    near = unit @ unit.T
    while len(groups) > max(1, (len(centres) + 1) // 2):
        best = max(((near[np.ix_(a, b)].mean(), -i, -j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j))
        i, j = -best[1], -best[2]
        groups[i] = sorted(groups[i] + groups.pop(j))
    return groups


def fit(x: np.ndarray, lang: list[str]) -> dict | None:
    """Hierarchical model of unit vectors and their languages."""
    names = sorted(set(lang))
    if not names:
        return None
    y = np.array([names.index(v) for v in lang])
    groups = families_of(np.stack([x[y == i].mean(0) for i in range(len(names))]))
    of = np.empty(len(names), int)
    for f, g in enumerate(groups):
        of[g] = f
    top = [svm(x, np.where(of[y] == f, 1.0, -1.0).astype(np.float32)) for f in range(len(groups))] if len(groups) > 1 else []
    pairs = {}
    for g in groups:
        for i, a in enumerate(g):
            for b in g[i + 1:]:
                keep = (y == a) | (y == b)
                pairs[a, b] = svm(x[keep], np.where(y[keep] == a, 1.0, -1.0).astype(np.float32))
    return {"names": names, "families": groups, "top": top, "pairs": pairs}


def predict_vectors(model: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(language number, score) of each vector."""
    margin = lambda w: x @ w[:-1] + w[-1]
    rows = np.arange(len(x))
    sure = np.full(len(x), np.inf)
    if model["top"]:
        m = np.stack([margin(w) for w in model["top"]], 1)
        fam = m.argmax(1)
        ranked = np.sort(m, 1)
        sure = (ranked[:, -1] - ranked[:, -2]) / 2
    else:
        fam = np.zeros(len(x), int)
    out = np.zeros(len(x), int)
    for f, g in enumerate(model["families"]):
        votes, total = np.zeros((len(x), len(g))), np.zeros((len(x), len(g)))
        least = np.full((len(x), len(g)), np.inf)
        for i in range(len(g)):
            for j in range(i + 1, len(g)):
                m = margin(model["pairs"][g[i], g[j]])
                for k, s in ((i, m), (j, -m)):
                    votes[:, k] += s > 0
                    total[:, k] += s
                    least[:, k] = np.minimum(least[:, k], s)
        # votes decide, margins break ties; equal margins go to the first name
        best = (votes + np.tanh(total) * 0.25).argmax(1)
        mine = fam == f
        out[mine] = np.array(g)[best[mine]]
        sure[mine] = np.minimum(sure, least[rows, best])[mine]
    return out, np.where(np.isinf(sure), 1.0, 1 / (1 + np.exp(-SHARPNESS * np.clip(sure, -50, 50))))


def _blocks(column):
    data, off = tk.text_buffers(column)
    for i, j in tk.blocks(off, max_rows=ROWS):
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> dict | None:
    """Model fitted on at most ``sample`` documents with a text and a language."""
    # documents are chosen by hashes of id and text: rows without an id take part, equal rows count once
    key = ["key", "text_key", "lang"]
    src = docs.filter(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"),
        F.xxhash64(F.lit(1), id_col, text_col).alias("text_key"))
    place = F.row_number().over(W.partitionBy("lang").orderBy("key", "text_key"))
    first = src.select(*key).distinct().select("*", place.alias("place")).filter(F.col("place") <= sample)
    chosen = first.orderBy("place", *key).limit(sample).select(*key)

    def run(batches):
        for batch in batches:
            for i, j, data, off in _blocks(batch.column(1)):
                x = vectors(data, off).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array([v.tobytes() for v in x], pa.binary())],
                    names=["key", "lang", "x"])

    # chosen has at most ``sample`` rows; repeated rows of a chosen one are dropped where they lie
    picked = src.join(F.broadcast(chosen), key, "left_semi").dropDuplicates(key).select("key", "text", "lang")
    got = arrow_map(picked, run, "key long, lang string, x binary").collect()
    got.sort(key=lambda r: (r["lang"], r["key"], bytes(r["x"])))
    if not got:
        return None
    x = np.stack([np.frombuffer(bytes(r["x"]), np.float16) for r in got]).astype(np.float32)
    return fit(x, [r["lang"] for r in got])


def predict(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in batches:
            for i, j, data, off in _blocks(batch.column(1)):
                n = j - i
                seen = np.append(0, np.cumsum(_LETTER[tk.LOWER[data]]))[off]
                letter = np.diff(seen) > 0
                for r in np.flatnonzero(~letter & (np.diff(off) > 0)):
                    letter[r] = any(map(str.isalpha, data[off[r]:off[r + 1]].tobytes().decode()))
                if m is None:
                    name, score = ["und"] * n, np.zeros(n)
                else:
                    lang, score = predict_vectors(m, vectors(data, off))
                    name = [m["names"][v] if ok else "und" for v, ok in zip(lang, letter)]
                    score = np.where(letter, score, 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(name, pa.string()), pa.array(score.astype(float))],
                                                 names=[id_col, "lang_pred", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return arrow_map(docs.select(F.col(id_col), F.col(text_col).cast("string")), run, f"`{id_col}` {kind}, lang_pred string, score double")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(crc_mod("doc_id", 3) != 1))
    return predict(docs, model).select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")
