"""Evaluation.

Ranking metrics are joins and aggregates over long tables: lists
``(user_id, item_id, rank)`` and truth ``(user_id, item_id)``. No per-user
array is built, so a user with many relevant items is summed map-side like
any other key.

Semantics:
* a user counts when it has a list (possibly empty: pass ``list_users``)
  and at least one relevant item;
* Precision@K = hits in the first K / K (not the list length);
* Recall@K = hits / number of relevant items;
* NDCG@K with binary gain, discount log2(rank + 1) for 1-based ranks,
  ideal DCG over min(relevant, K) positions;
* each metric is the mean over counted users, 0.0 when none counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.functions.exprs import clip, log_discount


def truth_sets(test: DataFrame, threshold: float = DEFAULTS.relevant_threshold) -> DataFrame:
    """Relevant items per user, long and distinct: test rows rated >= threshold."""
    return test.filter(F.col("rating") >= threshold).select("user_id", "item_id").distinct()


def per_user_ranking(lists: DataFrame, truth: DataFrame, k: int = DEFAULTS.top_k,
                     list_users: DataFrame | None = None) -> DataFrame:
    """Per counted user: hits, n_relevant, precision, recall, ndcg."""
    top = lists.filter(F.col("rank") <= k).select("user_id", "item_id", "rank")
    users = (list_users if list_users is not None else top).select("user_id").distinct()
    n_rel = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    hits = (top.join(truth, ["user_id", "item_id"], "inner")
            .groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("hits"), F.sum(log_discount("rank")).alias("dcg")))
    counted = users.join(n_rel, "user_id", "inner").join(hits, "user_id", "left").fillna(0, ["hits", "dcg"])
    ideal_n = F.least(F.col("n_relevant"), F.lit(k))
    idcg = F.aggregate(F.sequence(F.lit(1), ideal_n.cast("int")), F.lit(0.0),
                       lambda acc, i: acc + F.lit(1.0) / F.log2(i.cast("double") + F.lit(1.0)))
    return counted.select(
        "user_id", "hits", "n_relevant",
        (F.col("hits") / F.lit(float(k))).alias("precision"),
        (F.col("hits") / F.col("n_relevant")).alias("recall"),
        F.when(idcg > 0, F.col("dcg") / idcg).otherwise(F.lit(0.0)).alias("ndcg"),
    )


def ranking_metrics(lists: DataFrame, truth: DataFrame, k: int = DEFAULTS.top_k,
                    list_users: DataFrame | None = None) -> DataFrame:
    """One row: users, precision_at_k, recall_at_k, ndcg_at_k (means, 0.0 if no user)."""
    pu = per_user_ranking(lists, truth, k, list_users)
    return pu.agg(
        F.count(F.lit(1)).alias("users"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("precision_at_k"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("recall_at_k"),
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg_at_k"),
    ).withColumn("k", F.lit(k).cast("bigint"))


def rmse(predictions: DataFrame, label: str = "rating", prediction: str = "prediction",
         clip_to: tuple[float, float] | None = None) -> DataFrame:
    """One row: rmse (NULL when no pair is scored) and the number of scored
    pairs. Rows with a null or NaN prediction are dropped first (P10)."""
    p = predictions.filter(F.col(prediction).isNotNull() & ~F.isnan(prediction))
    pred = clip(prediction, *clip_to) if clip_to else F.col(prediction)
    err = F.pow(F.col(label) - pred, 2)
    return p.agg(F.sqrt(F.avg(err)).alias("rmse"), F.count(F.lit(1)).alias("n_scored"))


def metrics_long(model: str, ranking: DataFrame | None = None, error: DataFrame | None = None,
                 status: str = "ok") -> DataFrame:
    """Metrics of one model as ``(model, metric, value, status)`` rows."""
    parts = []
    if ranking is not None:
        parts.append(ranking.select(F.lit(model).alias("model"), F.lit(status).alias("status"),
                                    F.stack(F.lit(3), F.lit("precision_at_k"), "precision_at_k",
                                            F.lit("recall_at_k"), "recall_at_k",
                                            F.lit("ndcg_at_k"), "ndcg_at_k").alias("metric", "value")))
    if error is not None:
        parts.append(error.select(F.lit(model).alias("model"), F.lit(status).alias("status"),
                                  F.stack(F.lit(2), F.lit("rmse"), "rmse", F.lit("n_scored"), F.col("n_scored").cast("double")).alias("metric", "value")))
    if not parts:
        raise ValueError("nothing to report")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("model", "metric", "value", "status")


def status_row(spark, model: str, status: str, message: str = "") -> DataFrame:
    """A model that was skipped or failed, as one metrics row."""
    return spark.createDataFrame([(model, "status", None, f"{status}: {message}")],
                                 "model string, metric string, value double, status string")


def compare_models(metrics: DataFrame) -> DataFrame:
    """Wide comparison table, one row per model (M11); metric names are a
    known small set, so the pivot values are given."""
    names = ["rmse", "precision_at_k", "recall_at_k", "ndcg_at_k"]
    return metrics.groupBy("model").pivot("metric", names).agg(F.first("value"))
