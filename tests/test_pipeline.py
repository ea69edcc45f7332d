"""End-to-end run, failure isolation, sources and feature corner cases."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tastemap.operators import als as ALS, features as FE, recommend as REC, svd as SVD
from tastemap.operators import ratings as R
from tastemap.plans import pipeline as PL
from tastemap.session import scratch_path
from tastemap.sources import fixtures as FX, sinks, tables


def test_pipeline_all_models(spark):
    out = scratch_path(spark, "pipe")
    cfg = PL.PipelineConfig(als=ALS.AlsParams(rank=5, iters=3), svd_k=5, output_uri=out, features=True)
    res = PL.run(spark, FX.ratings(spark, SF_SMALL), FX.items(spark, SF_SMALL), cfg)
    rows = {(r["model"], r["metric"]): r for r in res.metrics.collect()}
    for model in ("ALS", "SVD"):
        for m in ("precision_at_k", "recall_at_k", "ndcg_at_k", "rmse"):
            assert rows[(model, m)]["status"] == "ok"
    assert ("kNN", "ndcg_at_k") in rows
    assert spark.read.json(f"{out}/metrics").count() == len(rows)
    assert spark.read.parquet(f"{out}/recommendations/knn").count() > 0
    assert spark.read.parquet(f"{out}/features.parquet").count() > 0
    for name in ("ratings", "per_item", "per_user"):
        assert spark.read.parquet(f"{out}/profiles/{name}.parquet").count() > 0
    assert {r["model"] for r in spark.read.parquet(f"{out}/comparison.parquet").collect()} == {"ALS", "SVD", "kNN"}
    assert ALS.load(f"{out}/models/als").rank == 5


def test_failure_in_lazy_metrics_stays_with_its_model(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(PL.ALS, "predict_any", lambda f, p: p.withColumn("prediction", F.raise_error(F.lit("boom")).cast("double")))
    cfg = PL.PipelineConfig(als=ALS.AlsParams(rank=3, iters=2), svd_k=4)
    rows = PL.run(spark, FX.ratings(spark, SF_SMALL), None, cfg).metrics.collect()
    assert [r["status"][:5] for r in rows if r["model"] == "ALS"] == ["error"]
    assert {r["model"] for r in rows if r["status"] == "ok"} == {"SVD", "kNN"}


def test_pipeline_failure_isolated(spark):
    # rank 0 is rejected by ALS; SVD and kNN must still report
    cfg = PL.PipelineConfig(als=ALS.AlsParams(rank=0), svd_k=5)
    res = PL.run(spark, FX.ratings(spark, SF_SMALL), None, cfg)
    rows = res.metrics.collect()
    als = [r for r in rows if r["model"] == "ALS"]
    assert len(als) == 1 and als[0]["status"].startswith("error")
    assert any(r["model"] == "SVD" and r["status"] == "ok" for r in rows)
    assert any(r["model"] == "kNN" and r["status"] == "ok" for r in rows)


def test_pipeline_random_split(spark):
    cfg = PL.PipelineConfig(split="random", models=("SVD", "kNN"), svd_k=4)
    res = PL.run(spark, FX.ratings(spark, SF_SMALL), None, cfg)
    assert res.train.count() + res.test.count() == R.clean_ratings(FX.ratings(spark, SF_SMALL)).count()
    assert res.metrics.filter("status <> 'ok'").count() == 0


def test_missing_item_table_and_preference(spark):
    assert tables.scan_items(spark, scratch_path(spark, "absent") + "/books.csv") is None
    base = scratch_path(spark, "pref")
    FX.ratings(spark, SF_SMALL).write.option("header", "true").csv(f"{base}/ratings.csv")
    df = tables.scan_ratings_any(spark, [f"{base}/ratings.parquet", f"{base}/ratings.csv"])
    assert df.count() == FX.ratings(spark, SF_SMALL).count()
    with pytest.raises(FileNotFoundError):
        tables.scan_ratings_any(spark, [f"{base}/nothing.parquet"])


def test_item_table_without_key_is_skipped(spark):
    path = scratch_path(spark, "nokey")
    spark.createDataFrame([(1, "a")], "id int, authors string").write.option("header", "true").csv(path)
    assert tables.scan_items(spark, path) is None


def test_feature_table_without_metadata_and_dummy(spark):
    c = R.clean_ratings(FX.ratings(spark, SF_SMALL))
    f = FE.build_features(R.enrich_stats(c))
    assert "features" in f.columns and "authors_kept" not in f.columns
    bare = FE.build_features(c.select("user_id", "item_id", "rating"))
    assert "no_inputs" in bare.columns


def test_median_keeps_int_type_and_nan_is_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, 4.0), (5, 5.0), (4, None)],
                               "a int, b double")
    out, med = FE.impute_median(df, ["a", "b"])
    assert med == {"a": 2, "b": 4.0}
    assert dict(out.dtypes)["a_filled"] == "int"
    assert sorted(r["b_filled"] for r in out.collect()) == [1.0, 4.0, 4.0, 4.0, 5.0]


def test_top_categories_null_uses_slot(spark):
    df = spark.createDataFrame([(None,)] * 5 + [("x",)] * 3 + [("y",)] * 2 + [("",)] * 1, "authors string")
    top = [r["authors"] for r in FE.top_categories(df, "authors", 2).collect()]
    assert top == ["x"]
    col = FE.collapse_categories(df, FE.top_categories(df, "authors", 2))
    assert {r["authors_kept"] for r in col.collect()} == {"unknown", "x", "other"}


def test_knn_min_rating_and_svd_options(spark):
    train = spark.createDataFrame([(1, 1, 5.0), (1, 2, 1.0)], "user_id bigint, item_id bigint, rating double")
    nb = spark.createDataFrame([(1, 3), (2, 4)], "item_id bigint, neighbor_id bigint")
    v = {r[1] for r in REC.knn_votes(train, nb, min_rating=3.0).collect()}
    assert v == {3}
    c = R.clean_ratings(FX.ratings(spark, SF_SMALL), dedup="pair").select("user_id", "item_id", "rating")
    u, i = R.dense_index(c, "user_id", "u_idx"), R.dense_index(c, "item_id", "i_idx")
    plain = SVD.svd_factors(c, u, i, k=5, use_sigma=False)
    centred = SVD.svd_factors(c, u, i, k=5, center="user")
    assert plain.status == "ok" and centred.status == "ok" and centred.user_means is not None
    p = SVD.predict_with_factors(c, centred.user_factors, centred.item_factors, centred.user_means)
    assert p.filter(F.isnan("prediction")).count() == 0


def test_als_lists_without_exclusion(spark):
    c = R.clean_ratings(FX.ratings(spark, SF_SMALL))
    model = ALS.fit(c, ALS.AlsParams(rank=4, iters=3))
    users = c.select("user_id").distinct()
    recs = ALS.recommend(model, users, 5)
    assert recs.groupBy("user_id").count().filter("count > 5").count() == 0
    path = scratch_path(spark, "nested")
    sinks.write_lists(recs, path)
    back = spark.read.parquet(path)
    assert back.filter(F.size("items") > 5).count() == 0


def test_median_with_hot_value(spark):
    # one value holds a third of the rows: the sort must still split it
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") % 1000).cast("double")).alias("x"))
    df = df.unionByName(spark.createDataFrame([(None,)], "x double"))
    _, med = FE.impute_median(df, ["x"])
    vals = sorted(r[0] for r in df.dropna().collect())
    assert med["x"] == vals[(len(vals) - 1) // 2]


@pytest.mark.parametrize("rows, accuracy", [(20_000, 10_000), (5, 100), (50, 20)])
def test_medians_by_narrowing_equal_the_sorted_middle(spark, monkeypatch, rows, accuracy):
    import random
    monkeypatch.setattr(FE, "_BRACKET_ROWS", rows)
    monkeypatch.setattr(FE, "_ACCURACY", accuracy)
    r = random.Random(rows)
    data = [(r.choice([None, 3, r.randrange(10**6)]), float("nan") if i % 9 == 0 else r.gauss(0, 1e6), 5, None, 2**60 + i % 700) for i in range(3000)]
    df = spark.createDataFrame(data, "a long, b double, c int, d double, e long").repartition(5)
    got = FE.exact_medians(df, ["a", "b", "c", "d", "e"])
    for j, c in enumerate("abcde"):
        v = sorted(x[j] for x in data if x[j] is not None and x[j] == x[j])
        assert got[c] == (v[(len(v) - 1) // 2] if v else None), c
    assert set(FE.exact_medians(df.filter("a < 0"), ["a", "b"]).values()) == {None}


def test_caps_keep_the_same_rows_as_a_full_order(spark):
    from tastemap.functions.exprs import hash_key
    from tastemap.operators import split as S
    df = spark.range(0, 5000).selectExpr("id % 700 as user_id", "id % 37 as item_id", "1.0 + id % 5 as rating").repartition(6)
    key = [hash_key("user_id", "item_id", seed=3), F.col("user_id"), F.col("item_id"), F.col("rating")]
    for n in (0, 1, 999, 4999, 5000, 9000):
        want = [tuple(r) for r in df.orderBy(*key).limit(n).collect()]
        assert sorted(map(tuple, S.capped_rows(df, n, seed=3).collect())) == sorted(want)
    assert S.capped_users(df, 50).count() == 50


def test_profile_counts_of_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 4.0), (1, 3, 5.0), (2, 2, 1.0), (None, 2, 2.0), (3, None, 2.0)], "user_id long, item_id long, rating double")
    p = R.dataset_profile(df).first().asDict()
    assert (p["n_ratings"], p["n_users"], p["n_items"], p["n_pairs"], p["rating_min"], p["rating_max"]) == (6, 3, 2, 3, 1.0, 5.0)
    e = R.dataset_profile(df.filter("rating > 9")).first()
    assert (e["n_ratings"], e["n_users"], e["n_pairs"], e["density"]) == (0, 0, 0, None)


def test_bucketed_split_same_rows_and_no_user_shuffle(spark):
    import contextlib, io
    a = PL.prepare(FX.ratings(spark, SF_SMALL))
    b = PL.prepare(FX.ratings(spark, SF_SMALL), bucket=True, buckets=4)
    for x, y in zip(a, b):
        assert sorted(map(tuple, x.collect())) == sorted(map(tuple, y.collect()))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        b[1].groupBy("user_id", "item_id").count().explain()
    assert "Exchange hashpartitioning" not in buf.getvalue()


def test_pipeline_single_user(spark):
    rows = [("7", str(i), str(1 + i % 5)) for i in range(6)]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating string")
    res = PL.run(spark, df, None, PL.PipelineConfig(als=ALS.AlsParams(rank=2, iters=2), svd_k=3))
    got = {(r["model"], r["status"].split(":")[0]) for r in res.metrics.collect()}
    assert ("SVD", "skipped") in got and ("kNN", "skipped") in got
    assert any(m == "ALS" for m, _ in got)
    assert res.test.count() == 1 and res.train.count() == 5


def test_cli_end_to_end_with_reference_column_names(spark):
    from tastemap.plans import cli
    data = scratch_path(spark, "cli-data")
    r = FX.ratings(spark, SF_SMALL).withColumnRenamed("item_id", "book_id")
    r.select("book_id", "user_id", "rating").write.option("header", "true").csv(f"{data}/ratings.csv")
    FX.items(spark, SF_SMALL).withColumnRenamed("item_id", "book_id").write.option("header", "true") \
        .csv(f"{data}/books.csv")
    out = scratch_path(spark, "cli-out")
    res = cli.main(["--data", data, "--out", out], spark=spark)
    assert res.metrics.filter("status = 'ok'").count() >= 8
    assert spark.read.parquet(f"{data}/ratings.parquet").count() == r.count()
    assert spark.read.parquet(f"{out}/features.parquet").count() > 0
    assert spark.read.json(f"{out}/metrics").count() == res.metrics.count()


def test_pipeline_without_models_is_an_error(spark):
    with pytest.raises(ValueError):
        PL.run(spark, FX.ratings(spark, SF_SMALL), None, PL.PipelineConfig(models=()))
