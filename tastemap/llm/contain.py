"""Benchmark decontamination by size-partitioned MinHash containment search.

Items and documents are sets of k-word shingles (A-Z lower-cased; a text of fewer
words is one shingle; without words, or null, the set is empty and matches nothing).
A document leaks an item when it holds at least ``percent`` of the item's
shingles. Comparing an item of 30 shingles with a document of 3,000 by plain MinHash
is hopeless, so both sides are brought to one size: items are partitioned by set
size (powers of two), and for each partition with sizes up to u the documents are
cut into windows of 2u shingles that advance by u. A run of an item's shingles
then lies in one window of about its own size. Item and window are
sketched into 4u hashed bins that keep their smallest value; a window is the
minimum of two neighbouring tiles, so each shingle is hashed once a partition.
A window and an item that agree in any filled bin are candidates: of an item's shingles in the
window each agrees with probability 0.79 or more, so with 8 or more of them the item is missed
with probability below 1e-5. Partitions up to ``WHOLE`` shingles keep a sketch of all their
shingles, that is, they miss nothing. Every candidate is confirmed on the full shingle sets.

The item index is sent to the tasks in blocks of about ``BLOCK_GRAMS`` shingles
(8 MB each), whatever the number of items; the documents are scanned once a block and are
never shuffled.

Defined results: one row per leak, ``(doc_id, item_id, n_item, n_common)``; a null
id is carried as null; repeated rows leak separately; only the named columns are read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import textkit as tk
from .frames import arrow_map, saved, table

K = 5
PERCENT = 80
BLOCK_GRAMS = 1_000_000
_U = np.uint64
_MASK_BITS = 22
WHOLE = 8
BINS = 4  # per shingle of a partition's largest item


def _grams(column, k: int):
    """(first row, rows, row of each shingle, 52-bit shingle) of the blocks of a text column."""
    data, off = tk.text_buffers(column)
    for i, j in tk.blocks(off):
        words = tk.Words(tk.LOWER[data[off[i]:off[j]]], off[i:j + 1] - off[i])
        row, h = tk.shingles(words, words.hashes(), k)
        yield i, j, row, h >> _U(64 - tk.SET_BITS)


def item_sets(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for i, j, row, g in _grams(batch.column(1), k):
                _, v, bound = tk.row_sets(row, g << _U(64 - tk.SET_BITS), j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i),
                     pa.ListArray.from_arrays(pa.array(bound.astype(np.int32)), pa.array(v.view(np.int64)))],
                    names=["item_id", "grams"])

    src = items.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return arrow_map(src, run, "item_id long, grams array<long>").filter(F.size("grams") > 0)


class Index:
    """Sketches of a block of items, by size partition."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        size = np.array([len(s) for s in sets])
        level = np.ceil(np.log2(size)).astype(int)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), size)
        self.parts = []
        for lv in np.unique(level):
            u = 1 << int(lv)
            mine = level[owner] == lv
            h = _bin_hash(flat[mine], int(lv))
            item = owner[mine]
            if u > WHOLE:
                place = item * (BINS * u) + _bin(h, BINS * u)
                order = np.lexsort((h, place))
                place, h = place[order], h[order]
                first = np.append(True, place[1:] != place[:-1])
                h, item = h[first], place[first] // (BINS * u)
            order = np.argsort(h, kind="stable")
            h, item = h[order], item[order]
            mask = np.zeros(1 << _MASK_BITS, bool)
            mask[h & _U((1 << _MASK_BITS) - 1)] = True
            self.parts.append((int(lv), u, h, item, mask))

    def candidates(self, row: np.ndarray, gram: np.ndarray, rows: int) -> np.ndarray:
        """Distinct (row, item) pairs with a window that agrees with the item in a bin."""
        found = [np.zeros((0, 2), np.int64)]
        count = np.bincount(row, minlength=rows)
        place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        for lv, u, keys, item, mask in self.parts:
            h = _bin_hash(gram, lv)
            if u <= WHOLE:
                some = mask[h & _U((1 << _MASK_BITS) - 1)]
                found.append(_matches(keys, item, row[some], h[some]))
                continue
            tiles = -(-count // u)
            at = np.cumsum(tiles) - tiles
            t = BINS * u
            sketch = np.full(int(tiles.sum()) * t, np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(sketch, (at[row] + place // u) * t + _bin(h, t), h)
            sketch = sketch.reshape(-1, t)
            of = np.repeat(np.arange(rows), tiles)
            window = sketch.copy()
            joined = np.flatnonzero(of[:-1] == of[1:])
            window[joined] = np.minimum(sketch[joined], sketch[joined + 1])
            tile, bin_ = np.nonzero(mask[window & _U((1 << _MASK_BITS) - 1)])
            found.append(_matches(keys, item, of[tile], window[tile, bin_]))
        return np.unique(np.concatenate(found), axis=0)


def _matches(keys: np.ndarray, item: np.ndarray, row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(row, item) of every value that is among the sorted ``keys``."""
    lo, hi = np.searchsorted(keys, value), np.searchsorted(keys, value, "right")
    n = hi - lo
    hit = np.arange(int(n.sum())) + np.repeat(lo - (np.cumsum(n) - n), n)
    return np.stack([np.repeat(row, n), item[hit]], 1)


def _bin_hash(gram: np.ndarray, level: int) -> np.ndarray:
    return tk.mix(gram + tk.GRAM_CODE[50 + level % 12])


def _bin(h: np.ndarray, t: int) -> np.ndarray:
    return ((h >> _U(32)) * _U(t) >> _U(32)).astype(np.int64)


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text", k: int = K, percent: int = PERCENT) -> DataFrame:
    """One row per leaked item of a document: ``id_col``, ``item_col``, ``n_item``, ``n_common``."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, `{item_col}` long, n_item long, n_common long"
    sets = saved(item_sets(items, item_col, item_text_col, k), "items")
    total = sets.agg(F.sum(F.size("grams"))).first()[0] or 0
    if not total:
        return docs.select(F.col(id_col), F.lit(0).cast("long").alias(item_col), F.lit(0).cast("long").alias("n_item"),
                           F.lit(0).cast("long").alias("n_common")).filter("false")
    n_blocks = -(-int(total) // BLOCK_GRAMS)
    src = docs.select(F.col(id_col), F.col(text_col).cast("string"))
    parts = []
    for b in range(n_blocks):
        rows = sets.filter(F.pmod(F.xxhash64("grams"), F.lit(n_blocks)) == b).collect()
        if rows:
            shared = spark.sparkContext.broadcast(([r[0] for r in rows], [np.array(r[1], np.int64).view(np.uint64) for r in rows]))
            parts.append(arrow_map(src, _search(shared, k, percent, [id_col, item_col, "n_item", "n_common"]), schema))
    return reduce(DataFrame.unionAll, parts)


def _search(shared, k: int, percent: int, names: list[str]):
    def run(batches):
        ids, sets = shared.value
        index = Index(sets)
        for batch in batches:
            doc_ids = batch.column(0)
            for i, j, row, gram in _grams(batch.column(1), k):
                bound = np.searchsorted(row, np.arange(j - i + 1))
                at, item, n_item, common = [], [], [], []
                last, mine = -1, None
                for r, x in index.candidates(row, gram, j - i).tolist():
                    if r != last:
                        last, mine = r, np.sort(gram[bound[r]:bound[r + 1]])
                    s = sets[x]
                    p = np.searchsorted(mine, s)
                    p[p == len(mine)] = 0
                    n = int((mine[p] == s).sum())
                    if n * 100 >= percent * len(s):
                        at.append(i + r), item.append(ids[x]), n_item.append(len(s)), common.append(n)
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.take(pa.array(at, pa.int64())), pa.array(item, pa.int64()), pa.array(n_item, pa.int64()),
                     pa.array(common, pa.int64())], names=names)
    return run


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _shingle_sql(name: str, key: str, source: str) -> str:
    return f"""
{name}_w as (select row_number() over () as r, {key}, regexp_extract_all(translate(coalesce(text, ''), '{_UP}', '{_LOW}'), '[^\\x20\\x09-\\x0D]+') as w from {source}),
{name} as (select distinct r, {key}, array_to_string(w[i:i + {K - 1}], ' ') as g
  from (select r, {key}, w, unnest(range(1, greatest(len(w) - {K - 1}, 1) + 1)) as i from {name}_w where len(w) > 0))"""


OP7_SQL = f"""
with {_shingle_sql("d", "doc_id", "documents")}, {_shingle_sql("b", "item_id", "benchmark")},
size as (select r, count(*) as n_item from b group by r)
select doc_id, item_id, n_item, count(*) as n_common
from b join size using (r) join d using (g)
group by b.r, d.r, doc_id, item_id, n_item
having count(*) * 100 >= {PERCENT} * n_item"""
