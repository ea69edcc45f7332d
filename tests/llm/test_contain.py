import random

import numpy as np
import pytest

import duck
import messy
from conftest import SF_SMALL
from tastemap.llm import contain

ITEM_SCHEMA = "item_id long, text string"


def brute(spark, docs, items):
    arrow = lambda df, *c: df.select(*c).toArrow()
    got = contain.leaks(docs, items).collect()
    duck.same(got, duck.rows(contain.OP7_SQL, documents=arrow(docs, "doc_id", "text"), benchmark=arrow(items, "item_id", "text")))
    return got


@pytest.mark.parametrize("block", [contain.BLOCK_GRAMS, 300])
def test_items_of_all_sizes_in_long_documents(spark, monkeypatch, block):
    """Whole and four-fifths items, scattered or in one piece, in documents a hundred times their size."""
    monkeypatch.setattr(contain, "BLOCK_GRAMS", block)
    r = random.Random(4)
    word = lambda: r.choice("abcdefgh") + str(r.randrange(500))
    items = [[word() for _ in range(n)] for n in (5, 6, 7, 9, 12, 16, 17, 30, 33, 60, 64, 70, 130) for _ in range(4)]
    rows = []
    for i in range(150):
        w = [word() for _ in range(r.randrange(10, 4000))]
        for item in r.sample(items, 2):
            piece = list(item)
            if r.random() < 0.5:  # change words at the end: containment around the threshold
                for j in range(r.randrange(0, 1 + len(piece) // 4)):
                    piece[-1 - j] = word()
            at = r.randrange(len(w))
            w[at:at] = piece
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = brute(spark, docs, spark.createDataFrame([(i, " ".join(x).upper()) for i, x in enumerate(items)], ITEM_SCHEMA))
    assert len(got) > 200


def test_given_tables(spark):
    brute(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))


def test_awkward_rows(spark):
    items = [(1, messy.TEXTS[0][1]), (1, messy.TEXTS[0][1]), (2, "one two"), (None, "one two"), (3, None), (4, ""), (5, " \n"),
             (6, " ".join(messy.LONG.split()[500:540])), (7, "never seen in any of the documents above")]
    got = brute(spark, messy.docs(spark), spark.createDataFrame(items, ITEM_SCHEMA))
    assert {(r.doc_id, r.item_id) for r in got} >= {(1, 1), (2, 1), (6, 2), (6, None), (None, 2), (7, 6)}


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c d e f")], ITEM_SCHEMA)
    assert contain.leaks(messy.docs(spark, []), items).count() == 0
    none = contain.leaks(messy.docs(spark), items.limit(0))
    assert none.count() == 0 and none.columns == contain.leaks(messy.docs(spark), items).columns


def test_recall_of_candidates_before_verification():
    """Items lying anywhere in documents, a fifth of their shingles replaced: the search alone misses almost none."""
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 52, n, dtype=np.uint64)) for n in rng.integers(12, 130, 300)]
    index = contain.Index(sets)
    row, gram = [], []
    for i, s in enumerate(sets):
        part = np.where(rng.random(len(s)) < 0.8, s, rng.integers(0, 1 << 52, len(s), dtype=np.uint64))
        doc = rng.integers(0, 1 << 52, 2000, dtype=np.uint64)
        at = rng.integers(0, 2000 - len(s))
        doc[at:at + len(s)] = part
        row.append(np.full(2000, i)), gram.append(doc)
    found = {tuple(x) for x in index.candidates(np.concatenate(row), np.concatenate(gram), len(sets)).tolist()}
    assert sum((i, i) in found for i in range(len(sets))) >= 299
