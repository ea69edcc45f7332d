"""Blocked top-K scoring against brute force, including the multi-block path."""

import numpy as np
import pandas as pd
import pytest

from tastemap.operators import recommend as REC
from tastemap.operators.popular import popular_unseen


def _factors(spark, n, r, seed, col="item_id"):
    rng = np.random.default_rng(seed)
    m = np.round(rng.normal(size=(n, r)), 3)
    rows = [(int(i), [float(x) for x in m[i]]) for i in range(n)]
    return spark.createDataFrame(rows, f"{col} bigint, factor array<double>"), m


def _brute(U, V, k, seen=None, self_ex=False):
    out = {}
    for u in range(U.shape[0]):
        s = np.round(V @ U[u], 9)
        cand = [(-s[i], i) for i in range(V.shape[0])
                if not (seen and i in seen.get(u, set())) and not (self_ex and i == u)]
        cand.sort()
        out[u] = [i for _, i in cand[:k]]
    return out


@pytest.mark.parametrize("block_bytes", [64 << 20, 2048])
def test_factor_recommend_matches_brute_force(spark, block_bytes, monkeypatch):
    from tastemap.operators import scoring
    vf, V = _factors(spark, 120, 4, 1)
    uf, U = _factors(spark, 30, 4, 2, col="user_id")
    seen = {u: {(u * 7 + j) % 120 for j in range(u % 6)} for u in range(30)}
    seen_df = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint")
    orig = scoring.factor_topk
    monkeypatch.setattr(REC, "factor_topk",
                        lambda q, it, k, extra=None: orig(q, it, k, extra=extra, max_block_bytes=block_bytes))
    got = REC.factor_recommend(uf, vf, seen_df, 5).toPandas()
    want = _brute(U, V, 5, seen)
    for u in range(30):
        g = got[got.user_id == u].sort_values("rank").item_id.tolist()
        assert g == want[u], u


def test_item_neighbors_excludes_self(spark):
    vf, V = _factors(spark, 60, 3, 3)
    nb = REC.item_neighbors(vf, 7).toPandas()
    want = _brute(V, V, 7, self_ex=True)
    for i in range(60):
        g = nb[nb.item_id == i].sort_values("rank").neighbor_id.tolist()
        assert g == want[i]
        assert i not in g


@pytest.mark.parametrize("rows", [60, 13, 3])
def test_neighbors_multiply_each_pair_of_blocks_once(spark, rows, monkeypatch):
    from tastemap.operators import scoring
    vf, V = _factors(spark, 60, 3, 3)
    monkeypatch.setattr(scoring, "_CELLS", 40)
    pairs = []
    real = scoring.block_pairs
    monkeypatch.setattr(scoring, "block_pairs", lambda b, n: pairs.append((real(b, n), n)) or pairs[-1][0])
    monkeypatch.setattr(REC, "neighbor_topk", lambda it, n: scoring.neighbor_topk(it, n, max_block_bytes=rows * 24))
    got = REC.item_neighbors(vf.repartition(4), 7).toPandas()
    want = _brute(V, V, 7, self_ex=True)
    for i in range(60):
        assert got[got.item_id == i].sort_values("rank").neighbor_id.tolist() == want[i]
    frame, n = pairs[0]
    assert frame.select("pair").distinct().count() == n * (n + 1) // 2 and frame.count() == n * n


def test_blocks_are_skipped_by_length_without_loss(spark, monkeypatch):
    """Item lengths fall steeply: most blocks cannot reach a list, and the lists stay exact."""
    from tastemap.operators import scoring
    rng = np.random.default_rng(8)
    V = np.round(rng.normal(size=(400, 4)) * np.exp(-np.arange(400) / 20)[:, None], 6)
    U = np.round(rng.normal(size=(33, 4)), 3)
    V[7] = V[9]
    vf = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(V)], "item_id bigint, factor array<double>").repartition(3)
    uf = spark.createDataFrame([(u, [float(x) for x in v]) for u, v in enumerate(U)], "query_id bigint, factor array<double>")
    for segment in (1 << 18, 150):
        monkeypatch.setattr(scoring, "SEGMENT", segment)
        got = scoring.factor_topk(uf, vf, 6, max_block_bytes=20 * 32)
        from pyspark.sql import functions as F
        from tastemap.operators.ranking import top_k
        rows = top_k(got, "query_id", [F.col("score").desc(), F.col("item_id")], 6).orderBy("query_id", "rank").collect()
        want = _brute(U, V, 6)
        assert [r.item_id for r in rows] == [i for u in range(33) for i in want[u]]
    lists = scoring._Lists(np.arange(33), np.full(33, 6), U)
    assert lists.add(np.arange(200), V[:200], float(np.linalg.norm(V[:200], axis=1).max()))
    assert not lists.add(np.arange(300, 400), V[300:], float(np.linalg.norm(V[300:], axis=1).max()))


def test_scorer_uses_neither_driver_nor_broadcast_for_factors():
    import inspect
    from tastemap.operators import scoring
    source = inspect.getsource(scoring)
    assert "toPandas" not in source and "sc.broadcast" not in source and "sparkContext" not in source


def test_vectors_of_unequal_length_are_refused(spark):
    from tastemap.operators import scoring
    bad = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0])], "item_id bigint, factor array<double>")
    with pytest.raises(ValueError, match="lengths 1..2"):
        scoring.neighbor_topk(bad, 3)
    assert scoring.neighbor_topk(bad.filter("item_id = 3"), 3).count() == 0


def test_knn_votes_and_empty_lists(spark):
    nb = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (2, 4), (3, 4)], "item_id bigint, neighbor_id bigint")
    train = spark.createDataFrame([(1, 1, 5.0), (1, 2, 4.0), (2, 3, 1.0)],
                                  "user_id bigint, item_id bigint, rating double")
    votes = {(r[0], r[1]): r[2] for r in REC.knn_votes(train, nb).collect()}
    assert votes == {(1, 3): 2, (1, 4): 1, (2, 4): 1}
    users = spark.createDataFrame([(1,), (2,), (9,)], "user_id bigint")
    recs = REC.knn_recommend(REC.knn_votes(train, nb), users, 1).collect()
    assert {(r[0], r[1]) for r in recs} == {(1, 3), (2, 4)}


def test_knn_votes_brute_force_with_heavy_keys(spark, monkeypatch):
    """Repeated pairs, one user and one item with a third of the rows, dealt in parts; every count by hand."""
    monkeypatch.setattr(REC, "HEAVY_ROWS", 20)
    rng = np.random.default_rng(8)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 30, 300), rng.integers(0, 60, 300), rng.integers(1, 6, 300))]
    rows += [(7, i, 4.0) for i in range(60)] + [(u, 5, 4.0) for u in range(100, 200)] + rows[:40]
    near = [(i, int(n)) for i in range(55) for n in rng.choice(70, 6, replace=False)]
    train = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    nb = spark.createDataFrame(near, "item_id bigint, neighbor_id bigint")
    seen = {(u, i) for u, i, _ in rows}
    for least in (None, 3.0):
        want = {}
        for u, i in {(u, i) for u, i, r in rows if least is None or r >= least}:
            for a, b in near:
                if a == i and (u, b) not in seen:
                    want[u, b] = want.get((u, b), 0) + 1
        got = REC.knn_votes(train.repartition(5), nb, least).collect()
        assert len(got) == len(want) and {(r[0], r[1]): r[2] for r in got} == want
    assert REC.knn_votes(train.limit(0), nb).count() == 0 and REC.knn_votes(train, nb.limit(0)).count() == 0


def test_popular_unseen_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = {(int(u), int(i)): float(rng.integers(1, 6)) for u, i in zip(rng.integers(0, 40, 600), rng.integers(0, 50, 600))}
    # one heavy user who has seen almost everything
    for i in range(48):
        rows[(99, i)] = 3.0
    pdf = pd.DataFrame([(u, i, r) for (u, i), r in rows.items()], columns=["user_id", "item_id", "rating"])
    train = spark.createDataFrame(pdf, "user_id bigint, item_id bigint, rating double")
    users = train.select("user_id").distinct()
    got = popular_unseen(train, users, 5).toPandas()
    means = pdf.groupby("item_id").rating.mean().round(9)
    order = sorted(means.index, key=lambda i: (-means[i], i))
    for u in pdf.user_id.unique():
        seen = set(pdf[pdf.user_id == u].item_id)
        want = [i for i in order if i not in seen][:5]
        g = got[got.user_id == u].sort_values("rank").item_id.tolist()
        assert g == want, u


def test_factor_lists_independent_of_layout(spark):
    vf, _ = _factors(spark, 80, 4, 11)
    uf, _ = _factors(spark, 25, 4, 12, col="user_id")
    a = REC.factor_recommend(uf.repartition(2), vf.repartition(3), None, 6).collect()
    b = REC.factor_recommend(uf.repartition(5), vf.repartition(1), None, 6).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_heavy_user_sees_most_items(spark):
    vf, V = _factors(spark, 120, 4, 21)
    uf, U = _factors(spark, 6, 4, 22, col="user_id")
    seen = {0: set(range(110)), 1: {3}, 2: set()}
    seen_df = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint")
    got = REC.factor_recommend(uf, vf, seen_df, 15).toPandas()
    want = _brute(U, V, 15, seen)
    for u in range(6):
        assert got[got.user_id == u].sort_values("rank").item_id.tolist() == want[u], u
    assert len(want[0]) == 10  # only ten unseen items are left for the heavy user


def test_popular_and_metrics_on_empty_inputs(spark):
    from tastemap.operators import metrics as M
    empty = spark.createDataFrame([], "user_id bigint, item_id bigint, rating double")
    users = spark.createDataFrame([(1,), (2,)], "user_id bigint")
    assert popular_unseen(empty, users, 5).count() == 0
    lists = spark.createDataFrame([], "user_id bigint, item_id bigint, rank bigint")
    truth = spark.createDataFrame([(1, 3)], "user_id bigint, item_id bigint")
    m = M.ranking_metrics(lists, truth, 10, list_users=users).first()
    assert m["users"] == 1 and m["precision_at_k"] == 0.0 and m["ndcg_at_k"] == 0.0


def test_unseen_lists_need_no_room_for_seen_items(spark, monkeypatch):
    """Seen pairs go to the task of their query block: no more than k rows leave a query and segment, however much it has seen."""
    from pyspark.sql import functions as F
    from tastemap.operators import scoring
    monkeypatch.setattr(scoring, "_SEEN", 7)
    monkeypatch.setattr(scoring, "_CELLS", 50)
    vf, V = _factors(spark, 90, 4, 31)
    uf, U = _factors(spark, 40, 4, 32, col="query_id")
    seen = {u: {(u * 5 + 3 * j) % 90 for j in range((u * 11) % 80)} for u in range(40)}
    pairs = [(u, i) for u, s in seen.items() for i in s] + [(3, 1000), (None, 4), (77, 5), (5, None)]
    seen_df = spark.createDataFrame(pairs, "query_id bigint, item_id bigint").repartition(3)
    uf = uf.withColumn("n", F.udf(lambda u: len(seen[u]), "long")("query_id"))
    for segment in (1 << 18, 40):
        monkeypatch.setattr(scoring, "SEGMENT", segment)
        got = scoring.unseen_topk(uf, vf.repartition(3), seen_df, 4, "n", max_block_bytes=10 * 32).toPandas()
        assert got.groupby("query_id").size().max() <= 4 * (3 if segment == 40 else 1)
        want = _brute(U, V, 4, seen)
        for u in range(40):
            mine = got[got.query_id == u].sort_values(["score", "item_id"], ascending=[False, True])
            assert mine.item_id.tolist()[:4] == want[u], u


def test_kept_items_of_ties_and_unequal_room():
    from tastemap.operators import scoring
    rng = np.random.default_rng(3)
    s = np.round(rng.normal(size=(30, 500)), 1)
    keep = np.where(np.arange(30) % 4 == 0, 0, np.arange(30) % 9)
    ids = rng.permutation(500)
    for turned in (False, True):
        kept = scoring._Kept(keep)
        for a in range(0, 500, 70):
            part = np.ascontiguousarray(s[:, a:a + 70])
            for r in (np.arange(0, 30, 2), np.arange(1, 30, 2)):
                kept.offer(r, np.ascontiguousarray(part[r].T) if turned else part[r], ids[a:a + 70], turned)
        got = kept.batch(np.arange(30)).to_pandas()
        for i in range(30):
            want = sorted(zip(-s[i], ids))[:keep[i]]
            mine = got[got.query_id == i]
            assert list(zip(-mine.score, mine.item_id)) == want


def test_pair_scores_carry_no_factor_with_a_pair(spark, monkeypatch):
    """Scores of given pairs equal the plain join's, with repeated, null and unknown keys and other columns, and no factor
    crosses an exchange in a row with its pair."""
    from tastemap.operators import scoring, svd as SVD
    monkeypatch.setattr(scoring, "BLOCK_BYTES", 1 << 13)
    rng = np.random.default_rng(4)
    vf, _ = _factors(spark, 2500, 4, 41)
    uf, _ = _factors(spark, 1500, 4, 42, col="user_id")
    vf, uf = vf.union(vf.filter("item_id < 9")), uf.union(uf.filter("user_id = 7"))
    rows = [(int(u), f"r{n}" if n % 3 else None, int(i)) for n, (u, i) in enumerate(zip(rng.integers(0, 1600, 4000), rng.integers(0, 2600, 4000)))]
    rows += [(7, "many", i) for i in range(300)] + [(None, "x", 3), (3, "x", None)]
    pairs = spark.createDataFrame(rows, "user_id bigint, note string, item_id bigint")
    want = SVD.predict_with_factors(pairs, uf, vf).select("user_id", "item_id", "note", "prediction")
    got = SVD.predict_with_factors(pairs.repartition(5), uf, vf, many=True)
    assert got.columns == ["user_id", "note", "item_id", "prediction"]

    def key(r):
        return r[0], r[1], r[2] or "", round(r[3], 9)
    mine = sorted(map(key, got.select("user_id", "item_id", "note", "prediction").collect()))
    assert len(mine) > 4000 and mine == sorted(map(key, want.collect()))
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
    assert SVD.predict_with_factors(pairs, uf.limit(0), vf, many=True).count() == 0


def test_rows_that_cannot_vote_leave_before_the_users_meet(spark):
    """Only items with neighbours, or that are neighbours (2: seen, takes a vote away), go to their user."""
    train = spark.createDataFrame([(1, 1, 4.0), (1, 2, 5.0), (1, 9, 5.0), (2, 8, 1.0), (None, 1, 1.0)], "user_id long, item_id long, rating double")
    nb = spark.createDataFrame([(1, 2), (1, 5), (5, 1), (6, None)], "item_id long, neighbor_id long")
    packed = {(r.user_id, r.item_id): sorted(r._near) for r in REC.packed_neighbors(train, nb).collect()}
    assert packed == {(1, 1): [2, 5], (1, 2): []}
    assert [tuple(r) for r in REC.knn_votes(train, nb).collect()] == [(1, 5, 1)]


@pytest.mark.parametrize("name", ["unseen_candidates", "knn_votes", "knn_recommend"])
def test_neighbour_queries_write_the_split_once(spark, name):
    from conftest import SF_SMALL
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "Scan ExistingRDD" in plan
