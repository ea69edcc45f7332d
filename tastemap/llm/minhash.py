"""Near-duplicate documents by fast similarity sketching.

A document is the set of its distinct k-word shingles (A-Z lower-cased; a text
of fewer words is one shingle; a text without words, or null, is the empty set
and linked with nothing). Two documents are linked when the Jaccard similarity
of their full sets is at least ``percent`` / 100.

*Sketch.* ``T`` coordinates. In round i < T every shingle is thrown into a hashed
bin with the value (i, hash); a bin keeps its smallest value, so the first round
that reaches a bin fixes it. In rounds T to 2T-1 all shingles go to bin i - T,
so every coordinate of a non-empty set is filled. Rounds stop as soon as all bins
of a document are filled: about |set| + T log T steps instead of |set| x T.

*Banding.* ``B`` bands of ``R`` coordinates. At similarity 0.8 a pair is missed by
all 40 bands of 6 with probability (1 - 0.8^6)^40 = 5e-6. A few longer bands
of ``R_LONG`` gather very similar texts first.

*Links without all pairs.* Texts with equal sets form one class; only its
smallest id goes on. In each band bucket every member is compared with the
bucket's smallest and largest id (a star, linear in the bucket). The verified
links are contracted to components. What is left are pairs whose members share a
bucket but not a component. Of these, the members outside their bucket's largest
component are paired with all others that share one of the shingles that are rarest
among such documents (two sets at the threshold share one of the larger set's rarest
fifth and the smaller set's rarest ninth, early enough to leave room for the overlap) and whose sketches do not agree in
fewer coordinates than a pair at the threshold would by six standard deviations. Every
link is confirmed on the full sets. Texts of one form that are all just too unlike (each with
a ninth or more of its own shingles) have no common shingle in those ninths and never meet.

Defined results: rows with a null id are returned with a null component and
``kept`` true; rows sharing an id are one node of the graph; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from . import textkit as tk
from .frames import arrow_map, components, saved, table

T = 240
R, B = 6, 40
R_LONG, B_LONG = 12, 12
SHINGLE_WORDS = 5
PERCENT = 80
BIT_PLANES = 4
SET_KEY = ["id", "s1", "s2"]
_U = np.uint64
_ROUND = np.arange(1, 2 * T + 1, dtype=np.uint64) * tk.GRAM_CODE[1]


def sketches(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    """(rows, T) coordinates of each row's set; rows without elements stay at the maximum."""
    t, top = T, np.iinfo(np.uint64).max
    out = np.full(rows * t, top, np.uint64)
    filled = np.zeros(rows, bool)
    for i in range(2 * t):
        if i:
            open_ = ~filled[row]
            if not open_.all():
                row, value = row[open_], value[open_]
        if not len(row):
            break
        h = tk.mix(value + _ROUND[i])
        bin_ = ((h >> _U(32)) * _U(t) >> _U(32)).astype(np.int64) if i < t else np.full(len(row), i - t)
        np.minimum.at(out, row * t + bin_, (_U(i) << _U(32)) | (h & _U(0xFFFFFFFF)))
        filled |= (out.reshape(rows, t) != top).all(1)
    return out.reshape(rows, t)


def threshold_disagreements(percent: int, t: int = T, sigmas: float = 6.0) -> int:
    """Coordinates (``BIT_PLANES`` bits each) in which a pair at the threshold may differ, plus ``sigmas`` deviations."""
    p = (1 - percent / 100) * (1 - 0.5 ** BIT_PLANES)
    return int(np.ceil(t * p + sigmas * np.sqrt(t * p * (1 - p))))


def _bands(sk: np.ndarray, r: int, b: int, salt: int) -> np.ndarray:
    parts = sk[:, :r * b].reshape(len(sk), b, r)
    h = np.full((len(sk), b), _U(salt), np.uint64) + np.arange(b, dtype=np.uint64) * tk.GRAM_CODE[2]
    for j in range(r):
        h = tk.mix(h + parts[:, :, j] * tk.GRAM_CODE[3 + j])
    return h


def _planes(sk: np.ndarray) -> np.ndarray:
    low = tk.mix(sk.copy())
    out = []
    for p in range(BIT_PLANES):
        bits = np.packbits((low >> _U(p)).astype(np.uint8) & 1, axis=1)
        words = -(-bits.shape[1] // 8) * 8
        out.append(np.pad(bits, ((0, 0), (0, words - bits.shape[1]))).view(np.int64))
    return np.concatenate(out, 1)


PLANE_WORDS = -(-T // 64)


def _lists(a: np.ndarray) -> pa.ListArray:
    n, w = a.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * w), pa.array(np.ascontiguousarray(a).view(np.int64).ravel()))


def _sets_of(column, k: int):
    """(first row, rows, element rows, elements, bounds) of each block of a text column."""
    data, off = tk.text_buffers(column)
    for i, j in tk.blocks(off):
        words = tk.Words(tk.LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i])
        row, h = tk.shingles(words, words.hashes(), k)
        r, v, bound = tk.row_sets(row, h, j - i)
        yield i, j, r, v, bound


def _set_hash(v: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit hash of each set, in two halves."""
    m = len(bound) - 1
    some = np.flatnonzero(np.diff(bound))
    s1, s2 = np.zeros(m, np.uint64), np.zeros(m, np.uint64)
    if len(v):
        s1[some] = np.add.reduceat(tk.mix(v * tk.GRAM_CODE[40]), bound[:-1][some])
        s2[some] = np.add.reduceat(tk.mix(v * tk.GRAM_CODE[41]), bound[:-1][some])
    return s1.view(np.int64), s2.view(np.int64)


def sketch_table(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """One row a document: set size, 128-bit set hash, band keys and the sketch's low bits."""
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, r, v, bound in _sets_of(batch.column(1), k):
                m = j - i
                n = np.diff(bound)
                s1, s2 = _set_hash(v, bound)
                sk = sketches(r, v, m)
                keys = np.concatenate([_bands(sk, R, B, 1), _bands(sk, R_LONG, B_LONG, 2)], 1)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, m), pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2),
                     _lists(keys), _lists(_planes(sk))],
                    names=["id", "n", "s1", "s2", "keys", "planes"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(src, run, "id long, n long, s1 long, s2 long, keys array<long>, planes array<long>")


def set_table(docs: DataFrame, id_col: str, text_col: str, k: int, ids: DataFrame) -> DataFrame:
    """Full shingle sets (with their hash) of the documents in ``ids``, one row per input row."""
    def run(batches):
        for batch in batches:
            for i, j, _, v, bound in _sets_of(batch.column(1), k):
                s1, s2 = _set_hash(v, bound)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(s1), pa.array(s2),
                     pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(v.view(np.int64)))],
                    names=["id", "s1", "s2", "grams"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return arrow_map(src.join(ids, "id", "left_semi"), run, "id long, s1 long, s2 long, grams array<long>")


def _one_row_per_set(sets: DataFrame) -> DataFrame:
    """``sets`` with one row for each id and set; only ids with repeated rows are shuffled."""
    repeated = saved(sets.groupBy(*SET_KEY).agg(F.count("*").alias("rows")).filter("rows > 1").select("id").distinct(), "repeated")
    if repeated.isEmpty():
        return sets
    again = sets.join(repeated, "id", "left_semi").dropDuplicates(SET_KEY)
    return saved(sets.join(repeated, "id", "left_anti").unionByName(again), "sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    sa = sets.select(F.col("id").alias("a"), F.col("grams").alias("ga"))
    sb = sets.select(F.col("id").alias("b"), F.col("grams").alias("gb"))
    both = pairs.join(sa, "a").join(sb, "b")
    na, nb, common = F.size("ga"), F.size("gb"), F.size(F.array_intersect("ga", "gb"))
    return both.select("a", "b", na.alias("na"), nb.alias("nb"), common.alias("x")).filter(
        F.col("x") * 100 >= (F.col("na") + F.col("nb") - F.col("x")) * percent).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    k: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id``, ``kept``."""
    sk = saved(sketch_table(docs, id_col, text_col, k), "sketches")
    classes = saved(sk.filter("n > 0 and id is not null").groupBy("s1", "s2").agg(F.min("id").alias("rep")), "classes")
    reps = sk.join(classes.withColumnRenamed("rep", "id"), ["id", "s1", "s2"], "left_semi")
    rows = reps.select("id", F.posexplode("keys").alias("band", "key")).select(
        "id", "key", (F.col("band") < B).alias("short"))
    groups = rows.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    hits = saved(rows.join(groups, "key"), "buckets")

    stars = hits.select("id", F.explode(F.array("lo", "hi")).alias("hub")).filter("id <> hub").select(
        F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    sets = _one_row_per_set(saved(set_table(docs, id_col, text_col, k, hits.select("id").distinct()), "sets"))
    first = components(verified(stars, sets, percent))

    # members of a bucket that are outside its largest component, against the others
    short = hits.filter("short").select("key", "id").join(first, "id", "left").select(
        "key", "id", F.coalesce("c", "id").alias("c"))
    parts = short.groupBy("key", "c").agg(F.count("*").alias("m"))
    mixed = parts.groupBy("key").agg(F.max(F.struct("m", "c"))["c"].alias("main"), F.count("*").alias("parts"))
    open_ = short.join(mixed.filter("parts > 1").select("key", "main"), "key").groupBy("id", "c").agg(
        F.max(F.col("c") != F.col("main")).alias("outside"))
    low = reps.select(*SET_KEY, "n", "planes").dropDuplicates(SET_KEY)
    rare = _rarest(saved(open_.join(low, "id").join(sets, SET_KEY), "open"), percent)
    rest = saved(residual_pairs(rare, percent).distinct(), "residual")
    later = verified(rest, sets, percent)
    la, lb = (first.select(F.col("id").alias(v), F.col("c").alias("c" + v)) for v in "ab")
    later = later.join(la, "a", "left").join(lb, "b", "left").select(
        F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b"))
    second = components(later)

    seconds = second.select(F.col("id").alias("c1"), F.col("c").alias("c2"))
    label = classes.join(first.withColumnRenamed("id", "rep"), "rep", "left").select(
        "s1", "s2", F.coalesce("c", "rep").alias("c1")).join(seconds, "c1", "left").select(
        "s1", "s2", F.coalesce("c2", "c1").alias("component"))
    return sk.select("id", "n", "s1", "s2").join(label, ["s1", "s2"], "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        F.when(F.col("id").isNull(), F.lit(True)).otherwise(
            F.col("id") == F.coalesce("component", "id")).alias("kept"))


def residual_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of :func:`_rarest` rows in different components, one of them ``outside``, that may reach the threshold.

    The smaller set (ties: smaller id) needs a common shingle among its n - ceil(2 n percent / (100 + percent)) + 1
    rarest, for the overlap is that part of both sizes together at least; its other rows are left out before the join."""
    short = F.col("n") - F.ceil(F.col("n") * 2 * percent / (100 + percent)) + 1
    small = rare.filter(F.col("place") <= short)
    x, y = F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")
    differ = sum((F.bit_count(_any_differs(w)) for w in range(PLANE_WORDS)), F.lit(0))
    fits = ((F.col("x.g") == F.col("y.g")) & (F.col("x.c") != F.col("y.c"))
            & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") < F.col("y.id"))))
            & (F.col("x.n") * 100 >= F.col("y.n") * percent)
            # at their first common shingle no more than it and what follows can be shared
            & ((F.least(x, y) + 1) * (100 + percent) >= (F.col("x.n") + F.col("y.n")) * percent)
            & (differ <= threshold_disagreements(percent)))
    pair = lambda a, b: a.alias("x").join(b.alias("y"), fits).select(
        F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    return pair(small.filter("outside"), rare).unionByName(pair(small.filter("not outside"), rare.filter("outside")))


def _rarest(docs: DataFrame, percent: int) -> DataFrame:
    """``docs`` (one row per id and set, with full sets ``grams``) as one row (g, place) for each of its rarest shingles.

    Two sets at the threshold share a shingle among the n - ceil(n * threshold) + 1
    rarest of either, so pairs that share none of these need no comparison.
    """
    grams = docs.select(*SET_KEY, F.explode("grams").alias("g"))
    ranked = grams.join(grams.groupBy("g").agg(F.count("*").alias("df")), "g").withColumn(
        "place", F.row_number().over(W.partitionBy(*SET_KEY).orderBy("df", "g")))
    n = F.col("n")
    most = n - F.ceil(n * percent / 100) + 1
    return ranked.join(docs.drop("grams"), SET_KEY).filter(F.col("place") <= most).drop("df")


def _any_differs(w: int):
    out = None
    for p in range(BIT_PLANES):
        i = p * PLANE_WORDS + w
        d = F.col("x.planes")[i].bitwiseXOR(F.col("y.planes")[i])
        out = d if out is None else out.bitwiseOR(d)
    return out


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=4)
