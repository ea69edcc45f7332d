"""Ranking metrics on the hand table (K = 2) and corner cases."""

import math

import pytest

from tastemap.operators import metrics as M


def lists_df(spark, lists):
    rows = [(u, it, r + 1) for u, items in lists.items() for r, it in enumerate(items)]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint, rank bigint")


def truth_df(spark, truth):
    rows = [(u, it) for u, items in truth.items() for it in items]
    return spark.createDataFrame(rows, "user_id bigint, item_id bigint")


def users_df(spark, users):
    return spark.createDataFrame([(u,) for u in users], "user_id bigint")


def test_hand_table(spark):
    lists = {1: [10, 11], 2: [12], 4: [15]}
    truth = {1: [10], 2: [13, 12], 3: [14]}
    m = M.ranking_metrics(lists_df(spark, lists), truth_df(spark, truth), 2,
                          list_users=users_df(spark, [1, 2, 3, 4])).first()
    assert m["users"] == 3
    assert m["precision_at_k"] == pytest.approx(1 / 3)
    assert m["recall_at_k"] == pytest.approx(0.5)
    assert m["ndcg_at_k"] == pytest.approx((1.0 + 1 / (1 + 1 / math.log2(3)) + 0.0) / 3, abs=1e-9)
    assert m["ndcg_at_k"] == pytest.approx(0.537716, abs=1e-6)


def test_per_user_values(spark):
    lists = {1: [10, 11], 2: [12], 4: [15]}
    truth = {1: [10], 2: [13, 12], 3: [14]}
    pu = {r["user_id"]: r for r in M.per_user_ranking(
        lists_df(spark, lists), truth_df(spark, truth), 2, list_users=users_df(spark, [1, 2, 3, 4])).collect()}
    assert set(pu) == {1, 2, 3}
    assert pu[2]["ndcg"] == pytest.approx(1 / (1 + 1 / math.log2(3)))
    assert pu[3]["precision"] == 0.0 and pu[3]["recall"] == 0.0


def test_precision_divides_by_k_not_list_length(spark):
    m = M.ranking_metrics(lists_df(spark, {1: [5]}), truth_df(spark, {1: [5]}), 10).first()
    assert m["precision_at_k"] == pytest.approx(0.1)
    assert m["recall_at_k"] == pytest.approx(1.0)


def test_no_counted_user_gives_zero(spark):
    m = M.ranking_metrics(lists_df(spark, {1: [5]}), truth_df(spark, {2: [5]}), 10).first()
    assert m["users"] == 0
    assert m["precision_at_k"] == 0.0 and m["ndcg_at_k"] == 0.0


def test_leave_one_out_recall_is_k_times_precision(spark):
    lists = {u: [u * 10 + i for i in range(10)] for u in range(1, 30)}
    truth = {u: [u * 10 + (u % 12)] for u in range(1, 30)}
    m = M.ranking_metrics(lists_df(spark, lists), truth_df(spark, truth), 10).first()
    assert m["recall_at_k"] == pytest.approx(10 * m["precision_at_k"])


def test_rmse_and_clip(spark):
    df = spark.createDataFrame([(1, 1, 5.0, 7.0), (1, 2, 1.0, -3.0), (2, 1, 3.0, float("nan")),
                                (2, 2, 4.0, None)],
                               "user_id bigint, item_id bigint, rating double, prediction double")
    r = M.rmse(df, clip_to=(1.0, 5.0)).first()
    assert r["n_scored"] == 2 and r["rmse"] == pytest.approx(0.0)
    r2 = M.rmse(df).first()
    assert r2["rmse"] == pytest.approx(math.sqrt((4 + 16) / 2))
    empty = M.rmse(df.filter("false")).first()
    assert empty["rmse"] is None and empty["n_scored"] == 0
