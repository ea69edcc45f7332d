"""Properties of the hash split and hold-out."""

import hashlib

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tastemap.operators import ratings as R, split as S
from tastemap.sources import fixtures as FX


def _clean(spark):
    return R.clean_ratings(FX.ratings(spark, SF_SMALL))


def _set(df):
    return {tuple(r) for r in df.collect()}


def test_holdout_partition_and_one_per_user(spark):
    c = _clean(spark)
    train, test = S.holdout_per_user(c)
    all_rows, tr, te = _set(c), _set(train), _set(test)
    assert tr | te == all_rows
    assert not (tr & te)
    per_user = test.groupBy("user_id").count().filter("count <> 1").count()
    assert per_user == 0
    multi = c.groupBy("user_id").count().filter("count >= 2").count()
    assert test.count() == multi


def test_holdout_independent_of_layout(spark):
    c = _clean(spark)
    a = _set(S.holdout_per_user(c.repartition(3))[1])
    b = _set(S.holdout_per_user(c.repartition(7))[1])
    assert a == b


def test_pick_order_is_that_of_the_whole_hash(spark):
    """Smallest (md5, item, rating) of each user, pairs rated twice included; also far-out ratings."""
    rows = [(u, i, float(r)) for u in range(40) for i in range(u % 7 + 1) for r in {1 + (u * i) % 5, 5 - i % 3}] + [(99, 1, 1e9), (99, 1, -1e9)]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, []).append((hashlib.md5(f"{u}|{i}|42".encode()).hexdigest(), i, r))
    want = {(u, *min(v)[1:]) for u, v in by_user.items() if len(v) > 1}
    assert _set(S.holdout_picks(df.repartition(4), seed=42)) == want


def test_pick_is_a_hash_aggregate(spark):
    df = spark.createDataFrame([(1, 1, 3.0)], "user_id bigint, item_id bigint, rating double")
    plan = S.holdout_picks(df)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHash" not in plan


def test_single_rating_user_stays_in_train(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (2, 1, 4.0), (2, 2, 5.0)], "user_id bigint, item_id bigint, rating double")
    train, test = S.holdout_per_user(df)
    assert (1, 1, 3.0) in _set(train)
    assert {r[0] for r in test.collect()} == {2}


def test_hash_split_fraction_and_layout(spark):
    c = _clean(spark)
    f1 = _set(S.hash_split(c.repartition(2)).filter("is_train").drop("is_train"))
    f2 = _set(S.hash_split(c.repartition(5)).filter("is_train").drop("is_train"))
    assert f1 == f2
    frac = len(f1) / c.count()
    assert 0.75 < frac < 0.85


def test_dense_index_layout_independent(spark):
    c = _clean(spark)
    a = _set(R.dense_index(c.repartition(3), "user_id", "u_idx"))
    b = _set(R.dense_index(c.repartition(6), "user_id", "u_idx"))
    assert a == b
    idx = sorted(v for _, v in a)
    assert idx == list(range(len(idx)))
    ordered = [u for u, _ in sorted(a, key=lambda t: t[1])]
    assert ordered == sorted(ordered)


def test_clean_ratings_dirty_rules(spark):
    rows = [("1", "10", "3"), ("1", "10", "3"), ("x", "10", "3"), ("2", None, "4"), ("3", "11", "0"),
            ("3", "12", "6"), ("3", "13", "NaN"), ("3", "14", None), ("4", "15", "5.0"), ("4", "16", "1")]
    df = spark.createDataFrame(rows, "user_id string, item_id string, rating string")
    out = _set(R.clean_ratings(df))
    assert out == {(1, 10, 3.0), (4, 15, 5.0), (4, 16, 1.0)}
    pairs = R.clean_ratings(spark.createDataFrame([("1", "2", "3"), ("1", "2", "4")],
                                                  "user_id string, item_id string, rating string"), dedup="pair")
    r = pairs.first()
    assert r["rating"] == 3.5 and r["n_ratings"] == 2


def test_hot_user_holdout(spark):
    # one user owns a third of the rows
    base = spark.range(0, 3000).select((F.col("id") % 1000 + 1).alias("user_id"), (F.col("id") % 97).alias("item_id"),
                                       (F.col("id") % 5 + 1).cast("double").alias("rating"))
    hot = spark.range(0, 1500).select(F.lit(0).cast("bigint").alias("user_id"), F.col("id").alias("item_id"),
                                      (F.col("id") % 5 + 1).cast("double").alias("rating"))
    df = base.unionByName(hot).dropDuplicates()
    train, test = S.holdout_per_user(df)
    assert test.filter("user_id = 0").count() == 1
    assert train.count() + test.count() == df.count()


def test_numeric_text_ids_are_kept_and_agree_with_parquet(spark):
    rows = [("12.0", "3.7", "4"), ("1e3", "7", "5"), (" 5 ", "6", "3"), ("99999999999999999999", "1", "4"), ("inf", "1", "4"),
            ("x1", "2", "4"), ("-3.9", "2", "4")]
    text = R.clean_ratings(spark.createDataFrame(rows, "user_id string, item_id string, rating string"))
    want = {(12, 3, 4.0), (1000, 7, 5.0), (5, 6, 3.0), (-3, 2, 4.0)}
    assert {tuple(r) for r in text.collect()} == want
    numbers = spark.createDataFrame([(12.0, 3.7, 4.0), (1000.0, 7.0, 5.0), (5.0, 6.0, 3.0), (-3.9, 2.0, 4.0), (float("nan"), 1.0, 4.0)],
                                    "user_id double, item_id double, rating double")
    assert {tuple(r) for r in R.clean_ratings(numbers).collect()} == want


def test_repeated_items_take_the_smallest_row(spark):
    ratings = spark.createDataFrame([(1, 1, 4.0), (2, 1, 3.0)], "user_id long, item_id long, rating double")
    items = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, None, 5)], "item_id long, authors string, year int")
    got = {tuple(r) for r in R.enrich_items(ratings, items).select("user_id", "authors", "year").collect()}
    assert got == {(1, None, 5), (2, None, 5)}
