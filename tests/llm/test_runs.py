import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

import messy
from conftest import SF_SMALL
from tastemap.llm import runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """All runs by the definition: every maximal stretch of every period, smallest period of equal stretches."""
    n, seen = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(24, 3 * q):
                seen.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, q, e) for (s, e), q in seen.items())


def plain(doc_id, text):
    w = WORD.findall(text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute(w)
    best = min(found, key=lambda r: (-Fraction(r[2] - r[0], r[1]), r[0], r[1]), default=None)
    gone = {i for s, q, e in found for i in range(s + q, e)}
    listed = "".join(f"{s},{e - s},{q}\n" for s, q, e in found)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    top = (None,) * 4 if best is None else (best[0], best[2] - best[0], best[1], 1000 * (best[2] - best[0]) // best[1])
    return (doc_id, len(found), *top, sha(listed), sha(kept))


def found(words, doc=None):
    ids = np.unique(words, return_inverse=True)[1]
    s, e, q = runs.find_runs(ids, np.zeros(len(ids), np.int64) if doc is None else np.asarray(doc))
    return sorted(zip(s.tolist(), q.tolist(), e.tolist()))


@pytest.mark.parametrize("seed", range(60))
def test_random_repetitions(seed):
    r = random.Random(seed)
    w = []
    while len(w) < r.choice([30, 200, 900]):
        base = [r.randrange(r.choice([1, 2, 3, 50])) for _ in range(r.randrange(1, 30))]
        w += base * r.choice([1, 1, 2, 3, 5, 9]) + base[:r.randrange(len(base))]
        if r.random() < 0.3:
            w += w[-r.randrange(1, len(w) + 1):]
    assert found(w) == brute(w)


def test_nested_and_touching_runs():
    inner = [1, 2] * 14 + [3]
    for w in (inner * 5, [7] * 24, [7] * 23, [1] * 40 + [2] * 40, ([1] * 30 + [2]) * 4, [0, 1, 2, 3, 4, 5, 6, 7] * 3,
              [0, 1, 2, 3, 4, 5, 6, 7] * 3 + [0], list(range(9)) * 2 + list(range(8)), (inner * 3 + [9]) * 3):
        assert found(w) == brute(w)


def test_fibonacci_and_thue_morse_words():
    a, b = [0], [0, 1]
    while len(b) < 1500:
        a, b = b, b + a
    assert found(b) == brute(b)
    assert found([bin(i).count("1") % 2 for i in range(1 << 13)]) == []
    assert runs.find_runs(np.array(b), np.zeros(len(b), int), runs._Plain)[0].tolist() == [s for s, _, _ in brute(b)]


def test_runs_stay_in_their_document():
    w, doc = [5] * 20 + [5] * 20 + [5] * 30, [0] * 20 + [1] * 20 + [2] * 30
    assert found(w, doc) == [(40, 1, 70)]


def test_long_periodic_text_is_fast():
    w = list(range(7)) * 20000
    assert found(w) == [(0, 7, 140000)]
    assert found([3] * 200000) == [(0, 1, 200000)]


def test_table_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect() if len(r["text"] or "") < 20000]
    r = random.Random(3)
    rows += [(10_000 + i, " ".join(r.choice(["alpha", "beta", "é"]) for _ in range(r.randrange(0, 90)))) for i in range(300)]
    rows += [(20_000 + i, "\t".join(["one", "two", "three"][:1 + i % 3] * (10 + i % 7)) + "\x0b end") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = runs.run_table(docs, rewrite=True).collect()
    want = [plain(*x) for x in rows]
    assert sum(1 for x in want if x[1]) > 30
    assert sorted(map(tuple, got)) == sorted(want)


def test_awkward_rows(spark):
    docs = messy.docs(spark).unionByName(messy.docs(spark, [(2**40 + 7, "a b " * 40, "en", "a"), (-5, "z " * 25, None, None)]))
    got = runs.run_table(docs, rewrite=True)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    short = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") < 6000]
    want = [plain(*x) for x in short]
    have = [tuple(r) for r in got.collect() if r["doc_id"] != 7]
    assert sorted(have, key=str) == sorted(want, key=str)
    assert runs.run_table(docs.filter("false")).collect() == []
    assert {r["n_runs"] for r in runs.run_table(docs.filter("doc_id = -5")).collect()} == {1}
