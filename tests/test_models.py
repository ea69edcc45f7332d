"""Models on planted low-rank data (the derived ratings carry no signal)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL

from tastemap.operators import als as ALS, ratings as R, svd as SVD
from tastemap.operators.metrics import rmse
from tastemap.sources import fixtures as FX


def planted(spark, n_users=300, n_items=120, rank=3, observed=0.4, noise=0.05, seed=7, full=False):
    rng = np.random.default_rng(seed)
    P = rng.uniform(0, 1, (n_users, rank))
    Q = rng.uniform(0, 1, (n_items, rank))
    M = P @ Q.T
    M = 1 + 4 * (M - M.min()) / (M.max() - M.min())
    if not full:
        M = M + rng.normal(0, noise, M.shape)
    mask = np.ones_like(M, bool) if full else rng.uniform(size=M.shape) < observed
    rows = [(int(u), int(i), float(M[u, i])) for u, i in zip(*np.nonzero(mask))]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double"), M


def test_svd_reconstructs_full_matrix(spark):
    df, M = planted(spark, 40, 25, full=True)
    users = R.dense_index(df, "user_id", "u_idx")
    items = R.dense_index(df, "item_id", "i_idx")
    # rank 3 plus the shift to [1, 5]: rank 4
    res = SVD.svd_factors(df, users, items, k=4)
    assert res.status == "ok" and res.k == 4
    want = np.linalg.svd(M, compute_uv=False)[:4]
    assert np.allclose(res.singular_values, want, rtol=1e-6)
    pred = SVD.predict_with_factors(df, res.user_factors, res.item_factors).toPandas()
    err = np.sqrt(((pred.rating - pred.prediction) ** 2).mean())
    assert err < 1e-6


def _indexed(df):
    return df, R.dense_index(df, "user_id", "u_idx"), R.dense_index(df, "item_id", "i_idx")


@pytest.mark.parametrize("strip, cell, group, parts, fan", [(8192, 1 << 15, 16, 1024, 32), (7, 40, 2, 5, 2)])
def test_svd_equals_numpy_with_restarts(spark, monkeypatch, strip, cell, group, parts, fan):
    """A slowly falling spectrum, a basis of three blocks, and strips and cells of a few rows."""
    from tastemap.operators import strips as ST
    for name, value in (("STRIP", strip), ("CELL", cell), ("GROUP", group), ("MAX_PARTS", parts), ("FAN_IN", fan), ("LEAST_STRIPS", 3)):
        monkeypatch.setattr(ST, name, value)
    monkeypatch.setattr(SVD, "MAX_BASIS", 3)
    rng = np.random.default_rng(4)
    M = np.round(rng.uniform(1, 5, (90, 61)) * (rng.uniform(size=(90, 61)) < 0.4))
    M[:, 7] = M[11] = 0
    pairs = spark.createDataFrame([(int(u), int(i), float(M[u, i])) for u, i in zip(*np.nonzero(M))], "user_id long, item_id long, rating double")
    users = spark.createDataFrame([(u * 10, u) for u in range(90)], "user_id long, u_idx long")
    items = spark.createDataFrame([(i * 10, i) for i in range(61)], "item_id long, i_idx long")
    pairs = pairs.selectExpr("user_id * 10 as user_id", "item_id * 10 as item_id", "rating")
    res = SVD.svd_factors(pairs, users, items, k=5)
    want = np.linalg.svd(M, compute_uv=False)[:5]
    assert res.status == "ok" and np.allclose(res.singular_values, want, rtol=1e-6)
    U = {r["user_id"]: r["factor"] for r in res.user_factors.collect()}
    V = {r["item_id"]: r["factor"] for r in res.item_factors.collect()}
    assert len(V) == 61 and V[70] == [0.0] * 5 and 110 not in U and len(U) == 89
    v = np.array([V[10 * i] for i in range(61)])
    u = np.array([U.get(10 * i, [0.0] * 5) for i in range(90)]) / want
    assert np.allclose(v.T @ v, np.eye(5), atol=1e-8) and np.allclose(u.T @ u, np.eye(5), atol=1e-8)
    assert np.abs(M @ v - u * want).max() < 1e-8 and np.abs(M.T @ u - v * want).max() < 1e-3


def test_row_sums_of_short_and_long_runs(monkeypatch):
    from tastemap.operators import strips as ST
    monkeypatch.setattr(ST, "AT_ONCE", 100)
    rng = np.random.default_rng(8)
    size = np.array([1, 5, 90, 32, 33, 2, 1, 400])
    first = np.cumsum(size) - size
    x, at, r = rng.normal(size=(50, 7)), rng.integers(0, 50, size.sum()), rng.uniform(1, 5, size.sum())
    assert np.allclose(ST.row_sums(x, at, r[:, None], first), np.add.reduceat(x[at] * r[:, None], first, axis=0), atol=1e-9)


def test_svd_does_not_follow_the_layout(spark):
    df, _ = planted(spark, 60, 40)
    _, users, items = _indexed(df)
    a, b = (SVD.svd_factors(df.repartition(n), users, items, k=6).singular_values for n in (1, 7))
    assert np.allclose(a, b, rtol=1e-9)


@pytest.mark.parametrize("rank", [1, 3])
def test_svd_of_low_rank_has_no_values_beyond_it(spark, rank):
    rng = np.random.default_rng(3)
    M = rng.normal(size=(30, rank)) @ rng.normal(size=(rank, 20))
    df = spark.createDataFrame([(u, i, float(M[u, i])) for u in range(30) for i in range(20)], "user_id long, item_id long, rating double")
    res = SVD.svd_factors(*_indexed(df), k=6)
    assert res.k == rank and np.allclose(res.singular_values, np.linalg.svd(M, compute_uv=False)[:rank], rtol=1e-6)
    zero = SVD.svd_factors(*_indexed(df.withColumn("rating", F.lit(0.0))), k=6)
    assert zero.status == "skipped: matrix has rank 0"


def test_svd_queries_write_the_split_once(spark, monkeypatch):
    from tastemap.plans import pipeline, queries as Q
    calls, prepare, holdout = [], pipeline.prepare, Q.S.holdout_per_user
    monkeypatch.setattr(pipeline, "prepare", lambda *a, **k: calls.append("written") or prepare(*a, **k))
    monkeypatch.setattr(Q.S, "holdout_per_user", lambda *a, **k: calls.append("again") or holdout(*a, **k))
    res, train, test = Q.svd_model(spark, SF_SMALL)
    assert calls == ["written"] and res.status == "ok" and train.count() > 0 and test.count() > 0


def test_svd_skip_guards(spark):
    df = spark.createDataFrame([(1, 1, 3.0)], "user_id bigint, item_id bigint, rating double")
    res = SVD.svd_factors(df, R.dense_index(df, "user_id", "u_idx"), R.dense_index(df, "item_id", "i_idx"))
    assert res.status.startswith("skipped")


def test_als_beats_global_mean(spark):
    df, _ = planted(spark)
    from tastemap.operators.split import holdout_per_user
    train, test = holdout_per_user(df)
    model = ALS.fit(train, ALS.AlsParams(rank=5, reg=0.05, iters=10))
    preds = ALS.predict(model, test)
    e = rmse(preds).first()["rmse"]
    mean = train.agg(F.avg("rating")).first()[0]
    base = rmse(test.withColumn("prediction", F.lit(mean))).first()["rmse"]
    assert e < base * 0.6


def test_als_repeatable_and_exclude_seen(spark):
    df, _ = planted(spark, 80, 40)
    p = ALS.AlsParams(rank=4, reg=0.1, iters=5)
    a = ALS.predict(ALS.fit(df, p), df).agg(F.sum("prediction")).first()[0]
    b = ALS.predict(ALS.fit(df, p), df).agg(F.sum("prediction")).first()[0]
    assert a == pytest.approx(b, rel=1e-9)
    model = ALS.fit(df, p)
    users = df.select("user_id").distinct()
    recs = ALS.recommend(model, users, 5, seen=df)
    assert recs.join(df, ["user_id", "item_id"], "inner").count() == 0
    ranks = recs.groupBy("user_id").agg(F.max("rank").alias("m"), F.count("*").alias("n"))
    assert ranks.filter("m <> n").count() == 0


def test_als_rejects_wide_ids(spark):
    df = spark.createDataFrame([(2**40, 1, 3.0)], "user_id bigint, item_id bigint, rating double")
    with pytest.raises(ValueError):
        ALS.fit(df)


def test_als_wide_ids_are_indexed(spark):
    df, _ = planted(spark, 60, 30)
    wide = df.select((F.col("user_id") + F.lit(2**40)).alias("user_id"),
                     (F.col("item_id") + F.lit(2**35)).alias("item_id"), "rating")
    f = ALS.fit_any_ids(wide, ALS.AlsParams(rank=3, iters=5))
    assert f.indexed
    preds = ALS.predict_any(f, wide)
    assert preds.count() == wide.count()
    assert preds.filter(F.col("user_id") < 2**40).count() == 0
    recs = ALS.recommend_any(f, wide.select("user_id").distinct(), 3, seen=wide)
    assert recs.join(wide, ["user_id", "item_id"]).count() == 0
    assert recs.filter(F.col("item_id") < 2**35).count() == 0
    narrow = ALS.fit_any_ids(df, ALS.AlsParams(rank=3, iters=5))
    assert not narrow.indexed


def test_registered_model_queries_invariants(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from tastemap.plans.queries import split
    q = E.queries()
    train, test = split(spark, SF_SMALL)
    svd = q["svd_recommend"](spark, SF_SMALL)
    assert svd.join(train, ["user_id", "item_id"]).count() == 0
    assert svd.groupBy("user_id").agg(F.max("rank").alias("m")).filter("m > 10").count() == 0
    grid = q["als_cv_grid"](spark, SF_SMALL).collect()
    assert len(grid) == 2 and all(r["rmse"] > 0 for r in grid)
    sv = [r["value"] for r in q["svd_singular_values"](spark, SF_SMALL).orderBy("idx").collect()]
    assert sv == sorted(sv, reverse=True) and sv[-1] > 0


def test_cross_validation_is_seeded(spark):
    df, _ = planted(spark, 60, 30)
    _, a = ALS.cross_validate(df, small=True, parallelism=2, seed=7)
    _, b = ALS.cross_validate(df, small=True, parallelism=2, seed=7)
    ra = sorted(map(tuple, a.collect()))
    rb = sorted(map(tuple, b.collect()))
    assert all(r[4] > 0 for r in ra)
    assert [r[:3] for r in ra] == [(20, 0.1, 6), (40, 0.1, 6)]
    assert all(x[3] == pytest.approx(y[3], rel=1e-9) for x, y in zip(ra, rb))


def test_model_search_does_not_depend_on_partitioning(spark):
    df, _ = planted(spark, 60, 30)
    df = df.checkpoint()
    one, many = (sorted(map(tuple, ALS.cross_validate(d, small=True, parallelism=2)[1].collect())) for d in (df.coalesce(1), df.repartition(8)))
    assert [r[:3] + r[4:] for r in one] == [r[:3] + r[4:] for r in many]
    assert all(x[3] == pytest.approx(y[3], rel=1e-4) for x, y in zip(one, many))


def test_als_does_not_depend_on_partitioning(spark):
    """The block count is a parameter, so layout and parallelism leave the model as it is."""
    train = R.clean_ratings(FX.ratings(spark, SF_SMALL)).checkpoint()
    pairs = train.select("user_id", "item_id").limit(300).checkpoint()

    def predictions(df):
        model = ALS.fit(df, ALS.AlsParams(rank=4, iters=4))
        return {(r["user_id"], r["item_id"]): r["prediction"] for r in ALS.predict(model, pairs).collect()}

    one, many = predictions(train.coalesce(1)), predictions(train.repartition(8))
    assert one.keys() == many.keys()
    assert max(abs(one[k] - many[k]) for k in one) < 1e-3


@pytest.mark.parametrize("center", [None, "user"])
def test_svd_centring(spark, center):
    pairs = R.clean_ratings(FX.ratings(spark, SF_SMALL), dedup="pair").select("user_id", "item_id", "rating").checkpoint()
    res = SVD.svd_factors(*_indexed(pairs), k=4, center=center)
    assert res.status == "ok" and len(res.singular_values) == 4 and res.item_factors.count() > 0
    assert (res.user_means is None) == (center is None)


def test_als_drops_shuffles_while_it_runs(spark):
    """Every setting has a checkpoint before its last iteration, and the interval does not touch the model."""
    from dataclasses import replace
    import numpy as np
    from tastemap.operators import als as ALS
    rng = np.random.default_rng(6)
    rows = [(int(u), int(i), float(r)) for u, i, r in zip(rng.integers(0, 60, 900), rng.integers(0, 40, 900), rng.integers(1, 6, 900))]
    df = spark.createDataFrame(rows, "user_id int, item_id int, rating double").checkpoint(eager=True)
    for p in ALS.param_grid() + ALS.param_grid(small=True) + [ALS.AlsParams()]:
        assert 2 * ALS.estimator(p).getCheckpointInterval() <= p.iters
    p = ALS.AlsParams(rank=4, iters=5)
    one, two = (sorted(map(tuple, ALS.factor_tables(ALS.fit(df, q))[1].collect())) for q in (p, replace(p, checkpoint_interval=10)))
    assert [r[0] for r in one] == [r[0] for r in two]
    assert np.allclose([r[1] for r in one], [r[1] for r in two], atol=1e-6)


def test_als_cv_grid_runs_the_whole_search(spark, monkeypatch):
    """All 8 settings on 3 folds and the refit (each fit here of one iteration)."""
    from collections import Counter
    from dataclasses import replace
    from tastemap.plans import queries as Q
    fits, estimator = [], ALS.estimator
    monkeypatch.setattr(ALS, "estimator", lambda p: fits.append((p.rank, p.reg, p.iters)) or estimator(replace(p, rank=2, iters=1)))
    table = Q.q_als_cv_grid(spark, SF_SMALL).collect()
    grid = [(p.rank, p.reg, p.iters) for p in ALS.param_grid()]
    assert [(r["rank"], r["reg_param"], r["max_iter"]) for r in table] == grid
    assert all(r["rmse"] > 0 for r in table) and len(fits) == 25 and set(Counter(fits[:24]).values()) == {3}


def _flat(spark):
    """One large singular value and a flat rest, which needs many steps."""
    rng = np.random.default_rng(12)
    M = np.round(rng.uniform(1, 5, (260, 200)) * (rng.uniform(size=(260, 200)) < 0.3))
    pairs = spark.createDataFrame([(int(u), int(i), float(M[u, i])) for u, i in zip(*np.nonzero(M))], "user_id long, item_id long, rating double")
    return M, _indexed(pairs.checkpoint())


def test_svd_steps_do_not_read_the_whole_basis(spark, monkeypatch):
    """A step meets the last two blocks and the locked vectors, however many blocks there are."""
    from tastemap.operators import strips as ST
    met, project = [], ST.project
    monkeypatch.setattr(ST, "project", lambda z, width, blocks, *more: met.append(len(blocks)) or project(z, width, blocks, *more))
    M, data = _flat(spark)
    res = SVD.svd_factors(*data, k=4)
    assert np.allclose(res.singular_values, np.linalg.svd(M, compute_uv=False)[:4], rtol=1e-6)
    assert len(met) > 6 and max(met) <= 3


def test_svd_begins_again_when_the_basis_is_not_orthogonal(spark, monkeypatch):
    """Nothing is locked: the largest vector comes back, which the Gram matrix of the final vectors shows."""
    runs, steps = [], SVD._steps
    monkeypatch.setattr(SVD, "LOCK", 0.0)
    monkeypatch.setattr(SVD, "_steps", lambda *a: runs.append(a[-1]) or steps(*a))
    M, data = _flat(spark)
    res = SVD.svd_factors(*data, k=4, tol=1e-8)
    assert runs == [False, True]
    assert np.allclose(res.singular_values, np.linalg.svd(M, compute_uv=False)[:4], rtol=1e-6)
    V = np.array([r["factor"] for r in res.item_factors.collect()])
    assert np.allclose(V.T @ V, np.eye(4), atol=1e-8)


@pytest.mark.parametrize("group, parts", [(4, 32), (1, 64)])
def test_products_are_added_up_before_they_are_moved(spark, monkeypatch, group, parts):
    """64 cells in tiles of 2 x 4 strips: each tile sends one part of each of its strips; heavy tiles are dealt over tasks."""
    from tastemap.operators import strips as ST
    for name, value in (("STRIP", 8), ("CELL", 40), ("GROUP", group)):
        monkeypatch.setattr(ST, name, value)
    rng = np.random.default_rng(5)
    M = rng.uniform(1, 5, (64, 64)) * (rng.uniform(size=(64, 64)) < 0.3)
    a = ST.pack(spark.createDataFrame([(int(u), int(i), float(M[u, i])) for u, i in zip(*np.nonzero(M))], "u_idx int, i_idx int, rating double"), 64, 64)
    x = rng.normal(size=(64, 3))
    tall = spark.createDataFrame([(s, x[s * 8:s * 8 + 8].tobytes()) for s in range(8)], "strip int, mat binary")
    for by_user, want in ((True, M @ x), (False, M.T @ x)):
        z = ST.times(a, tall, 3, by_user).checkpoint()
        got = {r["strip"]: np.frombuffer(bytes(r["mat"])).reshape(8, 3) for r in ST.summed(z, 3, a.side(by_user)).collect()}
        assert np.allclose(np.vstack([got[s] for s in range(8)]), want, atol=1e-12)
        assert z.count() <= parts and (group > 1 or a.groups["ib" if by_user else "ub"][1] > 8)
