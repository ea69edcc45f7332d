import math
import random

import numpy as np
import pyarrow as pa
import pytest

import duck
from conftest import SF_SMALL
from tastemap.llm import embjoin

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, least=embjoin.LEAST):
    """Links of all pairs and components by walking them."""
    def ok(e, lab):
        return lab is not None and e is not None and len(e) > 0 and all(x is not None and math.isfinite(x) for x in e) and any(e)
    n = len(rows)
    vec = [np.array(e, np.float32).astype(float) if ok(e, lab) else None for _, e, lab in rows]
    near = [[] for _ in rows]
    for i in range(n):
        for j in range(i + 1, n):
            a, b = vec[i], vec[j]
            if a is None or b is None or len(a) != len(b) or rows[i][2] != rows[j][2]:
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= least:
                near[i].append(j)
                near[j].append(i)
    out, done = [None] * n, set()
    for i in range(n):
        if i in done:
            continue
        group, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        done |= group
        first = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(near[j]), first, rows[j][0] is not None and rows[j][0] == first)
    return sorted(out, key=str)


def check(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr("*", "1 as c", "'x' as g", "2 as copies", "3 as part", "4 as links", "5 as n")
    got = embjoin.linked(df)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def clusters(seed, n=500, dims=12, labels=3):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims))
    rows = []
    for i in range(n):
        v = centres[r.integers(12)] + r.normal(size=dims) * r.choice([0.02, 0.2, 0.35])
        rows.append((i, [float(x) for x in v.astype(np.float32)], int(r.integers(labels))))
    return rows


@pytest.mark.parametrize("chunk, leaf, part", [(1024, 128, 1 << 16), (16, 4, 40), (7, 3, 20)])
def test_links_and_components(spark, monkeypatch, chunk, leaf, part):
    for name, value in (("CHUNK", chunk), ("LEAF", leaf), ("PER_PARTITION", part), ("FAN", 2)):
        monkeypatch.setattr(embjoin, name, value)
    check(spark, clusters(chunk))


def test_awkward_rows(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [float("nan"), 1.0], 0), (6, [float("inf"), 1.0], 0),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], None), (9, [1.0, 0.0], 0), (9, [1.0, 0.0], 0), (9, [0.0, 1.0], 0), (10, [2.0, 0.0], 0),
            (10, [1e-30, 0.0], 1), (11, [3e30, 1e29], 1), (None, [0.0, 2.0], 0), (None, [1.0, 1.0, 1.0], 5), (None, [1.0, 1.0, 1.0], 5),
            (None, None, None), (12, [1.0, 0.0, 0.0], 0), (13, [-1.0, 0.0], 0), (-4, [0.0, -1.0], 0), (-5, [0.0, -0.5], 0), (2**40, [0.0, -0.5], 0)]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, rows[8:9])
    assert embjoin.linked(spark.createDataFrame([], SCHEMA)).collect() == []


def test_many_copies_and_a_chain(spark):
    v = [1.0, 2.0, 3.0]
    step = math.acos(embjoin.LEAST) * 0.98
    rows = [(i, v, 1) for i in range(300)]
    rows += [(1000 - i, [math.cos(step * i), math.sin(step * i)], 2) for i in range(7)]
    check(spark, rows)


def test_ties_at_the_threshold_do_not_depend_on_the_layout(spark, monkeypatch):
    a = np.array([[3.0, 4.0], [4.0, 3.0], [1.0, 0.0], [0.6, 0.8]])
    least = embjoin._exact(a[0], a[1])
    rows = [(i, [float(x) for x in v], 0) for i, v in enumerate(a)]
    got = {r["vec_id"]: r["n_links"] for r in embjoin.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), least=least).collect()}
    monkeypatch.setattr(embjoin, "CHUNK", 1)
    again = {r["vec_id"]: r["n_links"] for r in embjoin.linked(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), least=least).collect()}
    assert got == again == {0: 2, 1: 2, 2: 0, 3: 2}


def test_distant_intervals_are_skipped(spark, monkeypatch):
    r = random.Random(2)
    rows = []
    for k in range(16):
        t = k * 0.39
        rows += [(k * 40 + i, [math.cos(t + r.random() * 0.01), math.sin(t + r.random() * 0.01)], 1) for i in range(40)]
    for name, value in (("CHUNK", 40), ("PER_PARTITION", 80), ("FAN", 2)):
        monkeypatch.setattr(embjoin, name, value)
    counted = []
    real = embjoin._interval_pairs
    monkeypatch.setattr(embjoin, "_interval_pairs", lambda *a: counted.append(real(*a)) or counted[-1])
    check(spark, rows)
    n = counted[0].count()
    chunks = counted[0].select("part", "seq").distinct().count()
    assert n < chunks * (chunks + 1) // 4


def test_query_matches_duckdb(spark):
    t = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toArrow()
    duck.same(embjoin.op13(spark, SF_SMALL).collect(), duck.rows(embjoin.OP13_SQL, embeddings=t))


def test_roots():
    x, y = np.array([0, 3, 4, 7]), np.array([1, 4, 5, 6])
    assert embjoin._roots(8, x, y).tolist() == [0, 0, 2, 3, 3, 3, 6, 6]
    assert pa.array(embjoin._roots(3, x[:0], y[:0])).to_pylist() == [0, 1, 2]
