import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import messy
from conftest import SF_SMALL
from tastemap.llm import minhash, textkit as tk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k, percent=80):
    """id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, text in rows:
        w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def check(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df, k=k).collect()}
    assert got == brute(rows, k)


def test_sketch_fills_and_estimates():
    rng = np.random.default_rng(3)
    for shared, own in ((800, 200), (40, 10), (4, 1), (1, 0)):
        a = rng.integers(0, 1 << 52, shared + own, dtype=np.uint64)
        b = np.append(a[:shared], rng.integers(0, 1 << 52, own, dtype=np.uint64))
        row = np.repeat([0, 1], shared + own)
        sk = minhash.sketches(row, np.append(a, b), 3)
        assert (sk[:2] != np.iinfo(np.uint64).max).all() and (sk[2] == np.iinfo(np.uint64).max).all()
        assert abs((sk[0] == sk[1]).mean() - shared / (shared + 2 * own)) < 0.2


def test_words_and_shingles_match_plain_python():
    texts = [t or "" for _, t, _, _ in messy.TEXTS]
    import pyarrow as pa
    data, off = tk.text_buffers(pa.array(texts))
    words = tk.Words(data, off)
    for i, t in enumerate(texts):
        mine = [data[s:e].tobytes().decode() for s, e in zip(words.start[words.row == i], words.end[words.row == i])]
        assert mine == WORD.findall(t)


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_near_copies(spark, seed):
    """Copies of copies with few changes: links in a chain, far ends unlike, many on the edge of the threshold."""
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + str(r.randrange(3000))
    rows, n = [], 0
    for _ in range(6):
        base = [word() for _ in range(r.choice([6, 30, 120]))]
        versions = [base]
        for _ in range(35):
            v = list(r.choice(versions if r.random() < 0.5 else [base]))
            for _ in range(r.randrange(0, 5)):
                v[r.randrange(len(v))] = word()
            versions.append(v)
        for v in versions:
            rows.append((n * 7 % 1009, " ".join(v)))
            n += 1
    check(spark, rows, 4)


def chains(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefgh") + str(r.randrange(3000))
    rows, n = [], 0
    for _ in range(4):
        base = [word() for _ in range(r.choice([30, 120]))]
        versions = [base]
        for _ in range(35):
            v = list(r.choice(versions))
            for _ in range(r.randrange(1, 5)):
                v[r.randrange(len(v))] = word()
            versions.append(v)
        rows += [((n + i) * 7 % 1009, " ".join(v)) for i, v in enumerate(versions)]
        n += len(versions)
    return rows


def test_rarest_shingles_of_repeated_rows(spark):
    """A row given three times has the same rarest shingles and places as one given once."""
    docs = spark.createDataFrame(chains(3), "id long, text string")

    def rare(d):
        sets = minhash._one_row_per_set(minhash.set_table(d, "id", "text", 4, d.select("id").distinct()))
        rows = minhash._rarest(sets.withColumn("n", F.size("grams")), 80).select("id", "g", "place").collect()
        return sorted(map(tuple, rows))
    assert rare(docs) == rare(docs.union(docs).union(docs))


def test_chains_with_every_row_given_twice(spark):
    rows = chains(4)
    check(spark, rows + rows, 4)


def forms(n, words=110, own=16):
    """Texts of one form with own words in the middle: every pair just below the threshold."""
    return [(i, " ".join([f"f{j}" for j in range(words // 2)] + [f"o{i}x{j}" for j in range(own - 4)] + [f"f{j}" for j in range(words // 2, words)]))
            for i in range(n)]


def test_forms_just_below_the_threshold_do_not_meet(spark):
    rows = forms(60) + [(1000 + i, t + " end") for i, t in forms(20)]
    check(spark, rows, 4)
    docs = spark.createDataFrame(forms(1200), "id long, text string")
    sets = minhash.set_table(docs, "id", "text", 4, docs.select("id")).withColumn("n", F.size("grams"))
    sk = minhash.sketch_table(docs, "id", "text", 4).select("id", "planes")
    rare = minhash._rarest(sets.join(sk, "id").withColumn("c", F.col("id")).withColumn("outside", F.lit(True)), 80).checkpoint()
    small = rare.filter(F.col("place") <= F.col("n") - F.ceil(F.col("n") * 160 / 180) + 1)
    assert rare.join(rare.select("g"), "g").count() > 1_000_000 and small.join(rare.select("g"), "g").count() < 100_000
    assert minhash.residual_pairs(rare, 80).count() == 0


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_residual_pairs_lose_no_link(spark, percent):
    """Every linked pair of different components with one side outside is among the pairs, without any banding before."""
    rows = list(dict(chains(5)).items())
    docs = spark.createDataFrame(rows, "id long, text string")
    sets = minhash.set_table(docs, "id", "text", 4, docs.select("id")).withColumn("n", F.size("grams"))
    sk = minhash.sketch_table(docs, "id", "text", 4).select("id", "planes")
    rare = minhash._rarest(sets.join(sk, "id").withColumn("c", F.col("id") % 50).withColumn("outside", F.col("id") % 3 == 0), percent)
    got = {tuple(x) for x in minhash.residual_pairs(rare, percent).distinct().collect()}
    full = {r.id: set(r.grams) for r in sets.collect()}
    want = {(a, b) for a in full for b in full if a < b and (a % 50 != b % 50) and (a % 3 == 0 or b % 3 == 0)
            and 100 * len(full[a] & full[b]) >= percent * len(full[a] | full[b])}
    assert len(want) > 5 and want <= got


def test_small_table_against_all_pairs(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    check(spark, rows, 4)


def test_awkward_rows(spark):
    got = minhash.near_duplicates(messy.docs(spark)).collect()
    assert len(got) == len(messy.TEXTS)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    by = {r.doc_id: r for r in got}
    assert by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[3].component_id == 3
    assert by[6].n_shingles == 1 and by[7].n_shingles > 10000


def test_empty_table(spark):
    assert minhash.near_duplicates(messy.docs(spark, [])).count() == 0
