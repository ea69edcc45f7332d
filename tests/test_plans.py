"""Physical-plan properties that matter at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tastemap.plans import queries as Q

HEAVY = {"end_to_end_metrics", "als_cv_grid", "svd_singular_values", "svd_factors", "item_factors_roundtrip",
         "svd_recommend", "als_predict", "als_recommend", "als_recs_nested", "als_save_load", "stage_raw_tables",
         "svd_singular_values_check", "item_factors_roundtrip_check", "svd_recommend_check", "end_to_end_check", "als_cv_grid_full",
         "als_recs_nested_check", "als_predict_check", "als_recommend_check", "als_save_load_check",
         "model_comparison", "metrics_long"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - HEAVY))
def test_no_pair_products_or_row_udfs(spark, name):
    p = plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in p, bad


def test_profile_has_no_expand_and_medians_no_sort(spark):
    assert "Expand" not in plan(E.queries()["dataset_profile"](spark, SF_SMALL))
    from tastemap.operators import features as FE
    t = Q.enriched(spark, SF_SMALL).checkpoint()
    seen = []
    agg = type(t).agg
    try:
        type(t).agg = lambda self, *a: seen.append(agg(self, *a)) or seen[-1]
        FE.exact_medians(t, ["average_rating", "item_rating_mean"])
    finally:
        type(t).agg = agg
    assert seen and all("Sort " not in plan(s) and "rangepartitioning" not in plan(s) for s in seen)


def test_lists_without_exclusion_have_no_cartesian_product(spark):
    assert "CartesianProduct" not in plan(E.queries()["als_recs_nested"](spark, SF_SMALL))


def test_topk_limits_before_shuffle(spark):
    p = plan(E.queries()["topk_per_user"](spark, SF_SMALL))
    # a partial limit on the map side, a final one after the exchange
    assert "row_number(), 10, Partial" in p
    assert "row_number(), 10, Final" in p


def test_scan_prunes_columns(spark):
    p = plan(E.queries()["scan_ratings"](spark, SF_SMALL))
    line = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln][0]
    assert "l_comment" not in line and "l_shipdate" not in line and "l_extendedprice" not in line


def test_clean_filter_pushed_to_scan(spark):
    p = plan(E.queries()["topk_per_user"](spark, SF_SMALL))
    assert "PushedFilters" in p and "IsNotNull(l_quantity)" in p


def test_knn_uses_vectorised_python_only(spark):
    p = plan(E.queries()["knn_recommend"](spark, SF_SMALL))
    assert "MapInArrow" in p and "BatchEvalPython" not in p


@pytest.mark.parametrize("name", ["recall_at_k", "ndcg_at_k", "precision_at_k"])
def test_split_is_written_once_where_read_several_times(spark, name):
    plan = E.queries()[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_orderkey" not in plan and "Scan ExistingRDD" in plan


def test_feature_slots_are_grouped_by_bounded_tasks(spark, monkeypatch):
    """Tasks grow in number with the rows, and slots are grouped only where their rows have met."""
    from tastemap.plans import queries as Q
    monkeypatch.setattr(Q, "SLOT_ROWS", 400)
    df = Q.QUERIES["feature_slots"](spark, SF_SMALL)
    above, found, _ = df._jdf.queryExecution().executedPlan().toString().partition("REPARTITION_BY_NUM")
    assert found and above.count("HashAggregate") == 2 and above.count("Exchange") == 1
    parts = -(-Q.clean(spark, SF_SMALL).count() // 400)
    assert parts > 4 and f", {parts})" in above
