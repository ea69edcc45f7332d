"""Top-scoring items for many query vectors.

Scoring every user against every item is a product of two factor matrices; as rows it would be
|users| x |items|. Here both sides lie in blocks, one row a block, dealt to tasks by Spark; no
factor passes through the driver and nothing is broadcast.

* :func:`factor_topk`: item blocks are sorted by the length of their vectors, longest first. A task gets one
  query block, then item blocks in that order, and keeps the best ``k + extra`` items of each query. A
  block (and every later one) is skipped for a query when |query| x |longest item| cannot reach the
  query's last kept score (Cauchy-Schwarz), so the result stays exact. ``extra`` is a
  per-row column: the number of items the caller will drop afterwards (items a user has already
  seen). Queries lie in blocks by falling ``extra``, so that a heavy one does not widen the others,
  and a block has at most ``_KEPT`` kept items. Very large catalogues are cut into segments, one task each.
* :func:`unseen_topk`: the same without given pairs, which are packed to the task of their query block, so that a list
  keeps ``k`` items and nothing is left to drop.
* :func:`neighbor_topk`: items against themselves. Each pair of blocks is multiplied once, and the
  product gives the best items of both sides.

* :func:`pair_scores`: the scores of a given table of pairs.

Scores of lists are rounded to 9 decimals before ranking and ties go to the smaller item id, so the result does
not depend on the blocks.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tastemap.functions.exprs import SCORE_DECIMALS
from tastemap.session import scratch_path

# The scoring functions run in Python workers. They are shipped by value,
# so executors need numpy and pyarrow but not this package on their path
# (``--py-files`` is still the way to ship the rest of the library).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUT_SCHEMA = T.StructType([
    T.StructField("query_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("score", T.DoubleType()),
])
OUT_ARROW = pa.schema([("query_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])

BLOCK_BYTES = 4 << 20   # bytes of a block of vectors at most
QUERY_BLOCKS = 16       # blocks of a small query table at least, so that its work is shared
QUERY_ROWS = 1 << 16    # queries of a block at most
QUERY_BYTES = 32 << 20  # bytes of their vectors at most
SEGMENT = 1 << 18       # items one task goes through at most
MAX_PARTS = 4096        # partitions of a scoring pass at most
MAX_BLOCK_PARTS = 256   # partitions that write blocks at most
_CELLS = 1 << 22        # score cells (x 8 bytes) held at once by one task, as a square
_KEPT = 1 << 22         # kept (or seen) items of a query block
_SEEN = 1 << 16         # seen pairs of a packed row


def _norm(c: str):
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, x: s + x * x))


def _size(df: DataFrame) -> tuple[int, int]:
    """(rows, vector length); all vectors must have one length."""
    st = df.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("factor")).alias("r"), F.min(F.size("factor")).alias("r0")).first()
    if st["n"] and st["r0"] != st["r"]:
        raise ValueError(f"factors have lengths {st['r0']}..{st['r']}; all must be equal")
    return int(st["n"]), int(st["r"] or 0)


def _blocks(df: DataFrame, order: list, per: int, rank: int, n: int) -> tuple[DataFrame, int]:
    """``df (seg, id, keep, norm, factor)`` in the total order of ``seg`` and ``order`` as rows ``(block, seg, top, ids, keep, mat)``
    of at most ``per`` vectors of one segment, numbered from 0 in that order, and their number; ``n`` is the number of rows."""
    rows = df.repartitionByRange(max(1, min(MAX_BLOCK_PARTS, n // per)), "seg", *order).sortWithinPartitions("seg", *order).select(
        "id", "keep", "norm", "factor", F.spark_partition_id().alias("part"), "seg")
    schema = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("seg", pa.int32()), ("top", pa.float64()), ("ids", pa.binary()), ("keep", pa.binary()), ("mat", pa.binary())])

    def run(batches):
        ids, keep, norm, mats, part, seq, seg = [], [], [], [], None, 0, None

        def flush():
            i, k, m = np.concatenate(ids), np.concatenate(keep), np.concatenate(mats)
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int64()), pa.array([seg], pa.int32()), pa.array([max(norm)], pa.float64()),
                                               *(pa.array([x.tobytes()], pa.binary()) for x in (i, k, m))], schema=schema)
        for b in batches:
            if not b.num_rows:
                continue
            part = b.column(4)[0].as_py()
            i, k, n = (b.column(c).to_numpy(zero_copy_only=False) for c in range(3))
            v = b.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)
            segs = b.column(5).to_numpy()
            ends = np.append(np.flatnonzero(np.diff(segs) != 0) + 1, len(segs))
            a = 0
            while a < len(i):
                # a block's kept items are bounded too: its first row keeps the most where order goes by keep
                most = max([int(k[a]), *(int(x.max()) for x in keep)])
                room = max(1, min(per, _KEPT // max(most, 1))) - sum(map(len, ids))
                if ids and (room <= 0 or segs[a] != seg):
                    yield flush()
                    ids, keep, norm, mats, seq = [], [], [], [], seq + 1
                    continue
                seg = int(segs[a])
                e = min(int(ends[np.searchsorted(ends, a, "right")]), a + room)
                ids.append(i[a:e])
                keep.append(k[a:e])
                norm.append(float(n[a:e].max()))
                mats.append(v[a:e])
                a = e
        if ids:
            yield flush()

    path = scratch_path(df.sparkSession, "factor-blocks")
    rows.mapInArrow(run, "part int, seq long, seg int, top double, ids binary, keep binary, mat binary").write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    # numbers follow from the counts of the earlier partitions (one row a partition)
    counts = sorted((r["part"], r["n"]) for r in out.groupBy("part").agg(F.count("*").alias("n")).collect())
    start, starts = 0, []
    for part, n in counts:
        starts.append((part, start))
        start += n
    offset = out.sparkSession.createDataFrame(starts, "part int, start long")
    return out.join(F.broadcast(offset), "part").select((F.col("start") + F.col("seq")).alias("block"), "seg", "top", "ids", "keep", "mat"), start


def _cells_of(batches):
    for b in batches:
        for i in range(b.num_rows):
            yield [c[i] for c in b.columns]


def _ids(v) -> np.ndarray:
    return np.frombuffer(v.as_buffer(), np.int64)


def _mat(v, rank: int) -> np.ndarray:
    return np.frombuffer(v.as_buffer(), np.float64).reshape(-1, rank)


def _batch(q: np.ndarray, i: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(q), pa.array(i), pa.array(s)], schema=OUT_ARROW)


class _Kept:
    """The ``keep[i]`` best (score, item) of each row i, as arrays of one width; an empty place scores -inf."""

    def __init__(self, keep: np.ndarray):
        self.keep = keep
        width = int(keep.max()) if len(keep) else 0
        self.item = np.zeros((len(keep), width), np.int64)
        self.score = np.full((len(keep), width), -np.inf)
        self.least = np.where(keep > 0, -np.inf, np.inf)   # the last kept score of a full row

    def offer(self, at: np.ndarray, s: np.ndarray, ids: np.ndarray, turned: bool = False) -> None:
        """Meets scores ``s`` of rows ``at`` (the columns of ``s`` if ``turned``) with items ``ids``; -inf is no score."""
        low, most, n = self.least[at], int(self.keep[at].max()), len(ids)
        if 0 < most < n and np.isneginf(low).any():
            # maxima of groups of items: as many of them as a row keeps bound what it can keep
            groups = min(n, 8 * most)
            size = n // groups
            if turned:
                top = s[:groups * size].reshape(groups, size, -1).max(1)
                bound = np.partition(top, groups - most, axis=0)[groups - most]
            else:
                top = s[:, :groups * size].reshape(-1, groups, size).max(2)
                bound = np.partition(top, groups - most, axis=1)[:, groups - most]
            low = np.maximum(low, bound)
        # rounding moves a score by less than this
        finite = np.isfinite(low)
        low = low - np.where(finite, 2e-9 + 1e-12 * np.abs(np.where(finite, low, 0)), 0)
        if turned:
            c, r = np.nonzero(s >= low)
            by = np.argsort(r, kind="stable")
            r, c = r[by], c[by]
            v = s[c, r]
        else:
            r, c = np.nonzero(s >= low[:, None])
            v = s[r, c]
        real = ~np.isneginf(v)
        if real.any():
            self._merge(at, r[real], ids[c[real]], np.round(v[real], SCORE_DECIMALS))

    def _merge(self, at: np.ndarray, r: np.ndarray, item: np.ndarray, score: np.ndarray) -> None:
        first = np.flatnonzero(np.append(True, np.diff(r) != 0))
        spread = np.diff(np.append(first, len(r)))
        rows, width = at[r[first]], self.score.shape[1]
        line, place = np.repeat(np.arange(len(first)), spread), width + np.arange(len(r)) - np.repeat(first, spread)
        s, i = np.full((len(rows), width + int(spread.max())), -np.inf), np.zeros((len(rows), width + int(spread.max())), np.int64)
        s[:, :width], i[:, :width] = self.score[rows], self.item[rows]
        s[line, place], i[line, place] = score, item
        order = np.lexsort((i, -s), axis=-1)[:, :width]
        s, i, keep = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1), self.keep[rows]
        s[np.arange(width) >= keep[:, None]] = -np.inf
        self.score[rows], self.item[rows] = s, i
        self.least[rows] = np.where(keep > 0, s[np.arange(len(rows)), np.maximum(keep, 1) - 1], np.inf)

    def batch(self, ids: np.ndarray) -> pa.RecordBatch:
        r, c = np.nonzero(~np.isneginf(self.score))
        return _batch(ids[r], self.item[r, c], self.score[r, c])


def _tile() -> int:
    return max(1, math.isqrt(_CELLS))


class _Seen:
    """Pairs (row, item) that are no candidates, by item."""

    def __init__(self, rows: np.ndarray, items: np.ndarray):
        order = np.argsort(items, kind="stable")
        self.rows, items = rows[order], items[order]
        self.first = np.flatnonzero(np.append(True, np.diff(items) != 0)) if len(items) else np.zeros(0, np.int64)
        self.items, self.end = items[self.first], np.append(self.first[1:], len(items))

    def cells(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, column), by column, of the seen cells of a block with the items ``ids``."""
        if not len(self.items):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        p = np.minimum(np.searchsorted(self.items, ids), len(self.items) - 1)
        col = np.flatnonzero(self.items[p] == ids)
        n = self.end[p[col]] - self.first[p[col]]
        start = np.repeat(self.first[p[col]] - np.cumsum(n) + n, n)
        return self.rows[start + np.arange(int(n.sum()))], np.repeat(col, n)


class _Lists:
    """Best items of the queries of one block."""

    def __init__(self, ids: np.ndarray, keep: np.ndarray, mat: np.ndarray, seen: _Seen | None = None):
        self.ids, self.mat, self.seen = ids, mat, seen
        self.norm = np.sqrt(np.einsum("ij,ij->i", mat, mat))
        self.kept = _Kept(keep)

    def add(self, ids: np.ndarray, mat: np.ndarray, top: float) -> bool:
        """Meets a block of items; False if neither it nor any shorter one can change a list."""
        open_ = np.flatnonzero(self.norm * top * (1 + 1e-9) + 1e-8 >= self.kept.least)
        if not len(open_):
            return False
        step = _tile()
        row, col = (np.zeros(0, np.int64),) * 2 if self.seen is None else self.seen.cells(ids)
        place = np.full(len(self.ids), -1)
        place[open_] = np.arange(len(open_))
        row, col = place[row][place[row] >= 0], col[place[row] >= 0]
        for b in range(0, len(ids), step):
            x, y = np.searchsorted(col, [b, b + step])
            for a in range(0, len(open_), step):
                at = open_[a:a + step]
                s = self.mat[at] @ mat[b:b + step].T
                mine = (row[x:y] >= a) & (row[x:y] < a + step)
                s[row[x:y][mine] - a, col[x:y][mine] - b] = -np.inf
                self.kept.offer(at, s, ids[b:b + step])
        return True

    def batch(self) -> pa.RecordBatch:
        return self.kept.batch(self.ids)


def factor_topk(queries: DataFrame, items: DataFrame, k: int, extra: str | None = None,
                max_block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each row of ``queries (query_id, factor[, extra])``, the best
    ``k + extra`` rows of ``items (item_id, factor)`` by dot product.

    Output ``(query_id, item_id, score)``, unranked; at most ``k + extra`` rows per query
    and segment of the catalogue. Combine with :func:`top_k`."""
    return _topk(queries, items, None, k, extra, max_block_bytes)


def unseen_topk(queries: DataFrame, items: DataFrame, seen: DataFrame, k: int, extra: str,
                max_block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """:func:`factor_topk` without the pairs ``seen (query_id, item_id)``: at most ``k`` rows per query and segment. The
    pairs go, packed, to the task of their query block; ``extra`` is their number by query and bounds the pairs of a block."""
    return _topk(queries, items, seen, k, extra, max_block_bytes)


def _packed_seen(seen: DataFrame, query_blocks: DataFrame) -> DataFrame:
    """``seen (query_id, id, seg)`` as rows ``(q, seg, rows, items)`` of at most ``_SEEN`` pairs of one query block and segment."""
    def places(batches):
        for block, ids in _cells_of(batches):
            i = _ids(ids)
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(np.full(len(i), block.as_py())), pa.array(np.arange(len(i)))], names=["query_id", "q", "row"])

    def run(batches):
        on, rows, items = None, [], []

        def flush():
            r, i = np.concatenate(rows), np.concatenate(items)
            return pa.RecordBatch.from_arrays([pa.array([on[0]], pa.int64()), pa.array([on[1]], pa.int32()), pa.array([r.tobytes()], pa.binary()), pa.array([i.tobytes()], pa.binary())], names=["q", "seg", "rows", "items"])
        for b in batches:
            at, seg, r, i = (c.to_numpy(zero_copy_only=False) for c in b.columns)
            cuts = np.flatnonzero((np.diff(at) != 0) | (np.diff(seg) != 0)) + 1
            for a, e in zip(np.append(0, cuts), np.append(cuts, len(at))):
                if a == e:
                    continue
                if rows and ((at[a], seg[a]) != on or sum(map(len, rows)) + e - a > _SEEN):
                    yield flush()
                    rows, items = [], []
                on = int(at[a]), int(seg[a])
                rows.append(r[a:e])
                items.append(i[a:e])
        if rows:
            yield flush()

    where = query_blocks.select("block", "ids").mapInArrow(places, "query_id long, q long, row long")
    pairs = seen.select(F.col("query_id").cast("bigint").alias("query_id"), "id", "seg").filter("query_id is not null").distinct().join(where, "query_id")
    return pairs.select("q", "seg", "row", "id").sortWithinPartitions("q", "seg").mapInArrow(run, "q long, seg int, rows binary, items binary")


def _topk(queries: DataFrame, items: DataFrame, seen: DataFrame | None, k: int, extra: str | None, max_block_bytes: int) -> DataFrame:
    spark = queries.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("keep"), F.col("factor").cast("array<double>"))
    more = F.coalesce(F.col(extra).cast("bigint"), F.lit(0)) if extra else F.lit(0)
    q = queries.select(F.col("query_id").cast("bigint").alias("id"), (more + k).cast("bigint").alias("keep"), F.col("factor").cast("array<double>"))
    # written once: counting and scoring do not run the lineage twice
    q, items = q.checkpoint(eager=True), items.checkpoint(eager=True)
    (n_items, rank), n_q = _size(items), q.count()
    if not n_items or not n_q or not rank:
        return spark.createDataFrame([], OUT_SCHEMA)
    per = max(1, max_block_bytes // (8 * rank))
    # every query block meets all items: few, large ones move them less often
    each = max(1, min(QUERY_ROWS, QUERY_BYTES // (8 * rank), math.ceil(n_q / QUERY_BLOCKS)))
    segments = math.ceil(n_items / SEGMENT)
    segment = F.pmod(F.xxhash64(F.col("id")), F.lit(segments)).cast("int").alias("seg")
    item_blocks, _ = _blocks(items.select("*", segment, _norm("factor").alias("norm")), [F.col("norm").desc(), "id"], per, rank, n_items)
    query_blocks, n_blocks = _blocks(q.withColumns({"norm": F.lit(0.0), "seg": F.lit(0)}), [F.col("keep").desc(), "id"], each, rank, n_q)
    every = F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("seg")
    mine = query_blocks.select(every, F.col("block").alias("q"), F.lit(-2).cast("long").alias("order"), "top", "ids", "keep", "mat")
    theirs = item_blocks.select("seg", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("q"),
                                F.col("block").alias("order"), "top", "ids", F.lit(None).cast("binary").alias("keep"), "mat")
    both = mine.unionByName(theirs)
    if seen is not None:
        near = seen.select("query_id", F.col("item_id").cast("bigint").alias("id")).join(items.select("id"), "id", "left_semi").select("query_id", "id", segment)
        both = both.unionByName(_packed_seen(near, query_blocks).select("seg", "q", F.lit(-1).cast("long").alias("order"), F.lit(0.0).alias("top"),
                                                                        F.col("items").alias("ids"), F.col("rows").alias("keep"), F.lit(None).cast("binary").alias("mat")))
    without = seen is not None

    def run(batches):
        lists, head, rows, gone, on = None, None, [], [], False
        for order, top, ids, keep, mat in _cells_of(batches):
            kind = order.as_py()
            if kind == -2:
                if lists:
                    yield lists.batch()
                lists, rows, gone, on = None, [], [], True
                head = _ids(ids), _ids(keep), _mat(mat, rank)
            elif kind == -1:
                rows.append(_ids(keep))
                gone.append(_ids(ids))
            elif on:
                if lists is None:
                    seen_ = _Seen(np.concatenate(rows), np.concatenate(gone)) if rows else None
                    lists = _Lists(head[0], np.minimum(head[1], k) if without else head[1], head[2], seen_)
                    rows, gone = [], []
                on = lists.add(_ids(ids), _mat(mat, rank), top.as_py())
        if lists:
            yield lists.batch()

    parts = min(n_blocks * segments, MAX_PARTS)
    both = both.withColumn("group", F.col("q") * segments + F.col("seg"))
    both = both.repartitionById(parts, F.pmod("group", F.lit(parts)).cast("int")).sortWithinPartitions("group", "order")
    return both.select("order", "top", "ids", "keep", "mat").mapInArrow(run, OUT_SCHEMA)


def pair_scores(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs (user_id, item_id, ...)`` with their ``prediction``: the dot product of ``users (user_id, factor)`` and
    ``items (item_id, factor)``; a join, pairs without factors drop out.

    For tables with many pairs of a user: no pair carries a factor through a shuffle. Users and items are dealt by a hash into
    groups; a task gets the factors of one group of users, then those of its groups of items, each followed by its pairs."""
    u = users.select(F.col("user_id").cast("bigint").alias("id"), F.col("factor").cast("array<double>")).filter("id is not null").checkpoint(eager=True)
    v = items.select(F.col("item_id").cast("bigint").alias("id"), F.col("factor").cast("array<double>")).filter("id is not null").checkpoint(eager=True)
    (n_u, rank), (n_v, rank_v) = _size(u), _size(v)
    out = T.StructType([*pairs.schema.fields, T.StructField("prediction", T.DoubleType())])
    if not n_u or not n_v or not rank:
        return pairs.limit(0).withColumn("prediction", F.lit(None).cast("double"))
    if rank != rank_v:
        raise ValueError(f"factors have lengths {rank} and {rank_v}; all must be equal")
    # factors of a group of users are held by a task, items come in small groups; every side moves as often as the other has deals
    deals_u = max(math.ceil(8 * rank * n_u / QUERY_BYTES), min(32, math.ceil(n_u / 1024)))
    deals_v = max(math.ceil(8 * rank * n_v / (2 * QUERY_BYTES)), min(4, math.ceil(n_v / 1024)))
    small = max(1, math.ceil(8 * rank * n_v / (deals_v * BLOCK_BYTES)))

    def dealt(c, n):
        return F.pmod(F.xxhash64(F.col(c).cast("bigint")), F.lit(n)).cast("int")
    # one sort key: group, then the users (block 0) or a block of items, factors before pairs
    wide = 2 * (small + 1)

    def key(block, kind):
        return ((F.col("du") * deals_v + F.col("dv")).cast("long") * wide + block * 2 + F.lit(kind)).alias("key")
    block = F.pmod(F.xxhash64(F.col("id"), F.lit(1)), F.lit(small)) + 1
    none = F.lit(None).cast(T.StructType(pairs.schema.fields)).alias("row")
    mine = u.select(dealt("id", deals_u).alias("du"), F.explode(F.sequence(F.lit(0), F.lit(deals_v - 1))).alias("dv"), "id", "factor").select(key(F.lit(0), 0), "id", "factor", none)
    theirs = v.select(F.explode(F.sequence(F.lit(0), F.lit(deals_u - 1))).alias("du"), dealt("id", deals_v).alias("dv"), "id", "factor").select(key(block, 0), "id", "factor", none)
    p = pairs.filter("user_id is not null and item_id is not null").select(
        dealt("user_id", deals_u).alias("du"), dealt("item_id", deals_v).alias("dv"), F.col("item_id").cast("bigint").alias("id"),
        F.lit(None).cast("array<double>").alias("factor"), F.struct(*[F.col(f"`{c}`") for c in pairs.columns]).alias("row")).select(key(block, 1), F.lit(None).cast("bigint").alias("id"), "factor", "row")
    parts = min(deals_u * deals_v, MAX_PARTS)
    both = mine.unionByName(theirs).unionByName(p)
    both = both.repartitionById(parts, F.pmod(F.floor(F.col("key") / wide), F.lit(parts)).cast("int")).sortWithinPartitions("key")
    at_user, at_item = pairs.columns.index("user_id"), pairs.columns.index("item_id")
    names = out.names

    def table(held):
        ids, m = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
        order = np.argsort(ids, kind="stable")
        return ids[order], m[order]

    def met(ids, want):
        """(position in ``want``, position in ``ids``) of equal ids; repeated ids meet as in a join."""
        low, n = np.searchsorted(ids, want), np.searchsorted(ids, want, "right") - np.searchsorted(ids, want)
        at = np.repeat(np.arange(len(want)), n)
        return at, np.repeat(low - np.cumsum(n) + n, n) + np.arange(len(at))

    def run(batches):
        group, block, users_, items_ = None, None, [], []
        ut = vt = None
        for b in batches:
            keys = b.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(keys) != 0) + 1
            for a, e in zip(np.append(0, cuts), np.append(cuts, len(keys))):
                if a == e:
                    continue
                part, (g, k_) = b.slice(a, e - a), divmod(int(keys[a]), wide)
                if g != group:
                    group, block, users_, ut = g, None, [], None
                if k_ // 2 != block:
                    block, items_, vt = k_ // 2, [], None
                if not k_ % 2:
                    ids = part.column(1).to_numpy()
                    m = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, rank)
                    (items_ if block else users_).append((ids, m))
                    continue
                if not users_ or not items_:
                    continue
                ut, vt = ut or table(users_), vt or table(items_)
                row = part.column(3).flatten()
                at, x = met(ut[0], row[at_user].to_numpy(zero_copy_only=False).astype(np.int64))
                sub, y = met(vt[0], row[at_item].to_numpy(zero_copy_only=False).astype(np.int64)[at])
                take, score = pa.array(at[sub]), np.einsum("ij,ij->i", ut[1][x[sub]], vt[1][y])
                yield pa.RecordBatch.from_arrays([*(c.take(take) for c in row), pa.array(score)], names=names)

    return both.mapInArrow(run, out)


def block_pairs(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """Every unordered pair of blocks once, as rows ``(pair, side, ids, mat)``: side 0 of the pair (a, b), a <= b, is a."""
    n = F.lit(n_blocks).cast("long")
    left = blocks.select(F.explode(F.sequence(F.col("block"), n - 1)).alias("other"), "block", "ids", "mat").select(
        (F.col("block") * n + F.col("other")).alias("pair"), F.lit(0).alias("side"), (F.col("block") == F.col("other")).alias("same"), "ids", "mat")
    right = blocks.filter("block > 0").select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("block") - 1)).alias("other"), "block", "ids", "mat").select(
        (F.col("other") * n + F.col("block")).alias("pair"), F.lit(1).alias("side"), F.lit(False).alias("same"), "ids", "mat")
    return left.unionByName(right)


def neighbor_topk(items: DataFrame, n: int, max_block_bytes: int = QUERY_BYTES) -> DataFrame:
    """For each row of ``items (item_id, factor)`` the best ``n`` other items of every block, as ``(query_id, item_id, score)``.
    Combine with :func:`top_k`."""
    spark = items.sparkSession
    items = items.select(F.col("item_id").cast("bigint").alias("id"), F.lit(n).cast("bigint").alias("keep"), F.col("factor").cast("array<double>")).checkpoint(eager=True)
    n_items, rank = _size(items)
    if not n_items or not rank or n <= 0:
        return spark.createDataFrame([], OUT_SCHEMA)
    # a row leaves each pair of blocks with n items: few, large blocks, but enough pairs for several tasks
    per = max(1, min(QUERY_ROWS, max_block_bytes // (8 * rank), max(1, _KEPT // n), max(256, math.ceil(n_items / 8))))
    blocks, n_blocks = _blocks(items.withColumns({"norm": F.lit(0.0), "seg": F.lit(0)}), ["id"], per, rank, n_items)

    def run(batches):
        x = xi = None
        for side, same, ids, mat in _cells_of(batches):
            if side.as_py() == 0:
                x, xi = _mat(mat, rank), _ids(ids)
                if not same.as_py():
                    continue
            y, yi = _mat(mat, rank), _ids(ids)
            step, both = _tile(), not same.as_py()
            left, right = _Kept(np.full(len(xi), n)), _Kept(np.full(len(yi) if both else 0, n))
            for a in range(0, len(xi), step):
                for b in range(0, len(yi), step):
                    s, i, j = x[a:a + step] @ y[b:b + step].T, xi[a:a + step], yi[b:b + step]
                    # blocks lie in the order of ids: few tiles share any
                    if i[0] <= j[-1] and j[0] <= i[-1]:
                        s[i[:, None] == j[None, :]] = -np.inf
                    left.offer(np.arange(a, a + len(i)), s, j)
                    if both:
                        right.offer(np.arange(b, b + len(j)), s, i, turned=True)
            yield left.batch(xi)
            if both:
                yield right.batch(yi)

    parts = min(n_blocks * (n_blocks + 1) // 2, MAX_PARTS)
    rows = block_pairs(blocks, n_blocks)
    rows = rows.repartitionById(parts, F.pmod(F.xxhash64("pair"), F.lit(parts)).cast("int")).sortWithinPartitions("pair", "side")
    return rows.select("side", "same", "ids", "mat").mapInArrow(run, OUT_SCHEMA)
