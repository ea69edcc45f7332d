"""Near-duplicate vectors by an epsilon grid order join.

Vectors of one group (label and length) are compared by cosine. Unit vectors with cosine of at least
c lie within eps = sqrt(2 - 2c) of each other, and projections on orthonormal directions never move
them apart. So all vectors are sorted by their grid cells of width eps on the leading principal
directions (a global, range-partitioned sort), and the sorted sequence is cut into intervals of
at most ``CHUNK`` vectors that carry the box of their projections. The join of the sequence
with itself is recursive: pairs of long intervals (many partitions) are split into pairs of
shorter ones level by level, as joins of small box tables, and a pair goes no further when its boxes are
more than eps apart. Each pair of chunks that is left is a task's unit of work, where the
recursion goes on to ``LEAF`` vectors, which are multiplied.

Copies are compared once: equal vectors of a group are one class with a count. A chunk pair gives at
most one row per class: its number of links there and the smallest class its links reach
inside the pair. So a dense cluster gives rows, not pairs, and loses no link; the components of those
edges are found on the executors.

Similarities are products of the given numbers in double precision; within 1e-11 of the threshold they
are summed exactly, so the result does not depend on the layout.

Defined results: one row per input row. A null, empty or zero vector, one with a null or non-finite
component, or one with a null label has no links and is its own component. Vectors of different
lengths are never linked. Rows that share an id are rows of their own and count as other vectors; rows
without an id are linked and counted, but never name a component (one of only such rows has a
null ``component_id``), and they are not ``kept``. An empty table gives no rows; only the named columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from .frames import arrow_map, components, saved, ship, table

LEAST = 0.93             # fixed value: the wanted cosine
DIRECTIONS = 6           # leading principal directions that order the vectors
PCA_WIDTH = 256          # components the directions are fitted on; further ones only weaken the skipping
CHUNK, LEAF = 1024, 128  # vectors of an interval that is one unit of work, and of a product
PER_PARTITION = 1 << 16  # vectors of a partition of the sorted sequence
FAN = 8                  # partitions (or longer intervals) joined to one interval of the next level
SALTS = 32
_SLACK = 1e-7


def _vectors(rows: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(id, g, k1, k2, v): ``g`` the group or null where nothing can be linked, ``k1``/``k2`` the hash of group and vector."""
    v = F.col(vec_col).cast("array<double>")
    good = F.coalesce((F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists("v", lambda x: x != 0.0), F.lit(False))
    t = rows.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), v.alias("v"))
    t = t.withColumn("g", F.when(good & F.col("label").isNotNull(), F.concat_ws(":", F.size("v").cast("string"), "label")))
    return t.select("id", "g", F.xxhash64(F.lit(1), "g", "v").alias("k1"), F.xxhash64(F.lit(2), "g", "v").alias("k2"), "v")


def _classes(vectors: DataFrame) -> DataFrame:
    """One row per distinct vector of a group: number ``c``, ``copies``, smallest id, the vector."""
    t = vectors.filter("g is not null").groupBy("g", "k1", "k2").agg(
        F.count("*").alias("copies"), F.min("id").alias("least"), F.first("v").alias("v"))
    return saved(t.select(F.monotonically_increasing_id().alias("c"), "*"), "vector-classes")


def _projected(classes: DataFrame) -> DataFrame:
    """``classes`` with ``p``: unit vectors on the leading principal directions (fitted by MLlib on all classes)."""
    width = min(int(classes.agg(F.max(F.size("v"))).first()[0]), PCA_WIDTH)
    top = F.array_max(F.transform("v", F.abs))
    scaled = classes.withColumn("u", F.transform("v", lambda x: x / top))
    norm = F.sqrt(F.aggregate("u", F.lit(0.0), lambda a, x: a + x * x))
    padded = F.concat(F.slice("u", 1, width), F.array_repeat(F.lit(0.0), F.greatest(F.lit(width) - F.size("u"), F.lit(0))))
    unit = scaled.withColumn("x", array_to_vector(F.transform(padded, lambda x: x / norm)))
    model = PCA(k=min(DIRECTIONS, width), inputCol="x", outputCol="y").fit(unit)
    return model.transform(unit).select("c", "g", "copies", "v", vector_to_array("y").alias("p"))


def _chunks(classes: DataFrame, eps: float) -> DataFrame:
    """The vectors in epsilon grid order with their chunk (``part``, ``seq``)."""
    n = classes.count()
    parts = max(1, math.ceil(n / PER_PARTITION))
    cells = F.transform("p", lambda x: F.floor(x / eps).cast("int"))
    ordered = _projected(classes).withColumn("cells", cells).repartitionByRange(parts, "g", "cells", "c").sortWithinPartitions("g", "cells", "c")

    def number(batches):
        # a chunk is a stretch of one group in one partition's order
        last, seq, used = None, -1, 0
        for batch in batches:
            groups = batch.column(1).to_pylist()
            out = np.empty(len(groups), np.int64)
            for i, g in enumerate(groups):
                if g != last or used == CHUNK:
                    last, used, seq = g, 0, seq + 1
                out[i] = seq
                used += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*batch.schema.names, "seq"])

    ordered = ordered.select("c", "g", "copies", "v", "p", F.spark_partition_id().alias("part"))
    return saved(arrow_map(ordered, number, "c long, g string, copies long, v array<double>, p array<double>, part int, seq long"), "grid-order")


def _boxes(rows: DataFrame, keys: list[str], low, high) -> DataFrame:
    dims = range(DIRECTIONS)
    return rows.groupBy(*keys).agg(*[F.min(F.get(low, F.lit(d))).alias(f"l{d}") for d in dims], *[F.max(F.get(high, F.lit(d))).alias(f"h{d}") for d in dims]).select(
        *keys, F.array(*[f"l{d}" for d in dims]).alias("low"), F.array(*[f"h{d}" for d in dims]).alias("high"))


def _near(eps: float):
    """Whether two boxes are at most ``eps`` apart (a missing direction counts 0)."""
    gap = F.zip_with(F.zip_with("a.low", "b.high", lambda x, y: x - y), F.zip_with("b.low", "a.high", lambda x, y: x - y),
                     lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, x: s + F.coalesce(x * x, F.lit(0.0))) <= eps * eps + _SLACK


def _interval_pairs(sequence: DataFrame, eps: float) -> DataFrame:
    """Pairs (g, part, seq, part2, seq2) of chunks whose boxes are within reach, by recursion from the whole sequence of a group."""
    levels = [saved(_boxes(sequence, ["g", "part", "seq"], F.col("p"), F.col("p")).select("*", F.col("part").cast("long").alias("up")), "boxes")]
    while "node" not in levels[-1].columns or levels[-1].agg(F.max("node")).first()[0] > 0:
        below = levels[-1]
        node = _boxes(below.select("g", F.col("up").alias("node"), "low", "high"), ["g", "node"], F.col("low"), F.col("high"))
        levels.append(saved(node.select("*", F.floor(F.col("node") / FAN).cast("long").alias("up")), "boxes"))
    top = levels[-1]
    pairs = top.select("g", F.col("node").alias("na"), F.col("node").alias("nb"))
    for below in reversed(levels[:-1]):
        names = ["node"] if "node" in below.columns else ["part", "seq"]
        a, b = below.alias("a"), below.alias("b")
        place = lambda t: F.struct(*[F.col(f"{t}.{n}") for n in names])
        ups = pairs.alias("p").join(a, (F.col("p.g") == F.col("a.g")) & (F.col("p.na") == F.col("a.up"))).join(
            b, (F.col("p.g") == F.col("b.g")) & (F.col("p.nb") == F.col("b.up"))).filter((place("a") <= place("b")) & _near(eps))
        two = [F.col(f"{t}.{n}").alias(f"n{t}" if n == "node" else n + t) for t in "ab" for n in names]
        pairs = saved(ups.select(F.col("p.g").alias("g"), *two), "interval-pairs")
    return pairs.withColumnsRenamed({"parta": "part", "seqa": "seq", "partb": "part2", "seqb": "seq2"})


def _exact(x: np.ndarray, y: np.ndarray) -> float:
    dot, a, b = (math.fsum((p * q).tolist()) for p, q in ((x, y), (x, x), (y, y)))
    return dot / (math.sqrt(a) * math.sqrt(b))


class _Side:
    """Vectors of one chunk in sequence order, with the boxes that the recursion asks for."""

    def __init__(self, t: pa.Table, eps: float):
        t = t.sort_by("c")
        self.c = t["c"].to_numpy()
        self.copies = t["copies"].to_numpy()
        self.v = t["v"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
        p = t["p"].combine_chunks().flatten().to_numpy().reshape(len(t), -1)
        order = np.lexsort(np.floor(p / eps).T[::-1])
        self.c, self.copies, self.v, self.p = self.c[order], self.copies[order], self.v[order], p[order]
        # powers of two change no product's digits and keep squares in range
        scale = np.ldexp(1.0, -np.frexp(np.abs(self.v).max(axis=1))[1])
        self.v = self.v * scale[:, None]
        self.norm = np.sqrt(np.einsum("ij,ij->i", self.v, self.v))

    def box(self, i: int, j: int):
        return self.p[i:j].min(axis=0), self.p[i:j].max(axis=0)


def _halves(i: int, j: int) -> list[tuple[int, int]]:
    """The interval in two, cut at a multiple of ``LEAF`` from its start; a leaf is left whole."""
    if j - i <= LEAF:
        return [(i, j)]
    cut = i + LEAF * -(-(j - i) // (2 * LEAF))
    return [(i, cut), (cut, j)]


def _links(a: _Side, b: _Side, same: bool, least: float, eps: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (in a, in b) of all linked pairs; each pair once when both sides are one chunk."""
    found = [(np.zeros(0, np.int64),) * 2]
    todo = [(0, len(a.c), 0, len(b.c))]
    while todo:
        i, j, k, m = todo.pop()
        if same and (i, j) > (k, m):
            continue
        (l1, h1), (l2, h2) = a.box(i, j), b.box(k, m)
        gap = np.maximum(np.maximum(l1 - h2, l2 - h1), 0.0)
        if gap @ gap > eps * eps + _SLACK:
            continue
        if j - i <= LEAF and m - k <= LEAF:
            sim = (a.v[i:j] @ b.v[k:m].T) / (a.norm[i:j, None] * b.norm[None, k:m])
            for x, y in np.argwhere(np.abs(sim - least) < 1e-11):
                sim[x, y] = _exact(a.v[i + x], b.v[k + y])
            x, y = np.nonzero(sim >= least)
            if same and (i, j) == (k, m):
                x, y = x[x < y], y[x < y]
            found.append((x + i, y + k))
        else:
            todo += [(*s, *t) for s in _halves(i, j) for t in _halves(k, m)]
    return tuple(np.concatenate(c) for c in zip(*found))


def _roots(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest place each of ``n`` places reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        for side in (x, y):
            np.minimum.at(new, side, low)
            np.minimum.at(new, root[side], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _pair_work(least: float, eps: float):
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        same = left["same"][0].as_py() if len(left) else False
        empty = pa.table({"c": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(left) or not (same or len(right)):
            return empty
        a = _Side(left, eps)
        b = a if same else _Side(right, eps)
        x, y = _links(a, b, same, least, eps)
        shift = 0 if same else len(a.c)
        c = a.c if same else np.concatenate([a.c, b.c])
        copies = a.copies if same else np.concatenate([a.copies, b.copies])
        y = y + shift
        links = np.zeros(len(c), np.int64)
        np.add.at(links, x, copies[y])
        np.add.at(links, y, copies[x])
        # places in order of class number, so that the smallest place is the smallest class
        order = np.argsort(c)
        rank = np.empty(len(c), np.int64)
        rank[order] = np.arange(len(c))
        root = c[order][_roots(len(c), rank[x], rank[y])][rank]
        some = links > 0
        return pa.table({"c": c[some], "links": links[some], "root": root[some]})
    return work


def linked(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", least: float = LEAST) -> DataFrame:
    """``id_col``, ``n_links``, ``component_id`` and ``kept`` of every row."""
    eps = math.sqrt(2.0 - 2.0 * least)
    vectors = _vectors(rows, id_col, vec_col, label_col)
    classes = _classes(vectors)
    if classes.limit(2).count() < 2:
        label = classes.select("k1", "k2", (F.col("copies") - 1).alias("n"), "least")
    else:
        sequence = _chunks(classes, eps)
        pairs = _interval_pairs(sequence, eps)
        ship(rows.sparkSession)
        chunk = ["g", "part", "seq"]
        keys = chunk + ["part2", "seq2"]
        same = (F.col("part") == F.col("part2")) & (F.col("seq") == F.col("seq2"))
        vector = ["c", "copies", "v", "p"]
        left = pairs.withColumn("same", same).join(sequence, chunk).select(*keys, "same", *vector)
        right = pairs.filter(~same).join(sequence.withColumnsRenamed({"part": "part2", "seq": "seq2"}), ["g", "part2", "seq2"])
        right = right.select(*[F.col(c).alias(c) for c in keys + vector])  # columns of its own, apart from the left side's
        found = saved(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
            _pair_work(least, eps), "c long, links long, root long"), "vector-links")
        links = found.groupBy("c").agg(F.sum("links").alias("links"))
        comp = components(found.select(F.col("c").alias("a"), F.col("root").alias("b"))).select(F.col("id").alias("c"), F.col("c").alias("top"))
        named = classes.select("c", "k1", "k2", "copies", "least").join(links, "c", "left").join(comp, "c", "left").withColumn(
            "top", F.coalesce("top", "c"))
        named = saved(named, "vector-components")
        least_of = named.groupBy("top").agg(F.min("least").alias("first"))
        label = named.join(least_of, "top").select("k1", "k2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.col("first").alias("least"))
    name = rows.schema[id_col].dataType
    # a vector with many copies is one key: its rows are dealt to SALTS parts; at most SALTS ** 2 vectors are that frequent
    total = classes.agg(F.sum("copies")).first()[0] or 0
    often = classes.filter(F.col("copies") * SALTS ** 2 > total).select("k1", "k2", F.lit(True).alias("often"))
    salt = F.when(F.col("often"), (F.rand(1) * SALTS).cast("int")).otherwise(0).alias("salt")
    ids = vectors.filter("g is not null").select("id", "k1", "k2").join(F.broadcast(often), ["k1", "k2"], "left").select("id", "k1", "k2", salt)
    each = F.when(F.col("often"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = label.join(F.broadcast(often), ["k1", "k2"], "left").select("k1", "k2", "n", "least", F.explode(each).alias("salt"))
    alone = vectors.filter("g is null").select("id", F.lit(0).cast("long").alias("n"), F.col("id").alias("least"))
    out = ids.join(salted, ["k1", "k2", "salt"]).select("id", "n", "least").unionByName(alone)
    return out.select(F.col("id").cast(name).alias(id_col), F.col("n").alias("n_links"), F.col("least").cast(name).alias("component_id"),
                      F.coalesce(F.col("id") == F.col("least"), F.lit(False)).alias("kept"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
with recursive v as (
  select vec_id, label, embedding::double[] as e from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (select a.vec_id as a, b.vec_id as b from v a join v b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= {LEAST}),
walk as (select vec_id as id, vec_id as c from embeddings union select walk.id, links.b from walk join links on links.a = walk.c),
comp as (select id, min(c) as component_id from walk group by id),
n as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n.n, 0)::bigint as n_links, comp.component_id, vec_id = comp.component_id as kept
from embeddings join comp on comp.id = vec_id left join n on n.a = vec_id"""
