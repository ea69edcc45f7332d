"""Ratings: cleaning, de-duplication, statistics, enrichment, dense ids
(P1-P3, A1-A2, A5, A7-A9, J1-J2, J5, W2).

Skew notes. Statistics are hash aggregates with a map-side partial step,
so a user or item holding a third of all rows costs one partial row per
map task, not a third of the data in one task. Enrichment joins a big side
with a one-row-per-key side; AQE turns it into a broadcast join when the
key side is small at run time, and otherwise splits a skewed partition of
the big side (left outer join: the left side may be split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS

TRIPLE = ["user_id", "item_id", "rating"]


def id_value(df: DataFrame, col: str, id_type: str = "bigint") -> F.Column:
    """An id as ``id_type``: text that is a number with a fraction or an exponent
    (``12.0``, ``3.7``, ``1e3``) counts by its whole part, as a number column would;
    other text, NaN and ids out of range are NULL."""
    plain = F.col(col).try_cast(id_type)
    if df.schema[col].dataType.typeName() != "string":
        return plain
    return F.coalesce(plain, F.col(col).try_cast("decimal(38,18)").try_cast(id_type))


def clean_ratings(df: DataFrame, lo: float = DEFAULTS.rating_min, hi: float = DEFAULTS.rating_max,
                  id_type: str = "bigint", dedup: str = "triple") -> DataFrame:
    """Project and cast the triple, drop rows with any null (NaN counts as
    null), keep ratings in [lo, hi], then de-duplicate.

    ``try_cast`` turns malformed text into NULL (Spark 4 runs ANSI casts,
    which would raise). ``dedup="triple"`` drops exact copies; ``"pair"``
    keeps one row per (user, item) with the mean rating; ``"none"`` keeps all.
    """
    out = df.select(
        id_value(df, "user_id", id_type).alias("user_id"),
        id_value(df, "item_id", id_type).alias("item_id"),
        F.col("rating").try_cast("double").alias("rating"),
    )
    # explicit predicates rather than na.drop(): the optimizer knows them as
    # not-null constraints, so two uses of the cleaned table plan the same
    # subtree and the second reuses the first one's exchange
    out = out.filter(F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
                     & F.col("rating").isNotNull() & ~F.isnan("rating")
                     & F.col("rating").between(lo, hi))
    if dedup == "triple":
        return out.dropDuplicates(TRIPLE)
    if dedup == "pair":
        return dedup_pairs(out)
    if dedup == "none":
        return out
    raise ValueError(f"dedup must be triple, pair or none, not {dedup!r}")


def dedup_pairs(df: DataFrame) -> DataFrame:
    """One row per (user, item); rating = mean of its ratings, n = copies."""
    return (df.groupBy("user_id", "item_id")
            .agg(F.avg("rating").alias("rating"), F.count(F.lit(1)).alias("n_ratings")))


def item_stats(df: DataFrame) -> DataFrame:
    return (df.groupBy("item_id")
            .agg(F.count(F.lit(1)).alias("item_rating_count"), F.avg("rating").alias("item_rating_mean")))


def user_stats(df: DataFrame) -> DataFrame:
    return (df.groupBy("user_id")
            .agg(F.count(F.lit(1)).alias("user_rating_count"), F.avg("rating").alias("user_rating_mean")))


def enrich_stats(df: DataFrame) -> DataFrame:
    """Ratings with item and user count and mean."""
    return df.join(item_stats(df), "item_id", "left").join(user_stats(df), "user_id", "left")


def enrich_items(df: DataFrame, items: DataFrame | None, key: str = "item_id") -> DataFrame:
    """Left join item metadata (J2). The dimension key is de-duplicated
    first (the smallest row of a repeated id, so a retry gives the same one), and a
    repeated id cannot multiply rating rows."""
    if items is None:
        return df
    rest = [c for c in items.columns if c != key]
    dim = items.select(key).distinct() if not rest else items.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(
        key, *[F.col(f"_row.{c}").alias(c) for c in rest])
    return df.join(dim, key, "left")


def user_item_sets(df: DataFrame, user_col: str = "user_id", item_col: str = "item_id") -> DataFrame:
    """Sorted set of items per user (A5). The array is bounded by the
    number of distinct items; pipelines use anti-joins instead."""
    return (df.groupBy(user_col)
            .agg(F.array_sort(F.collect_set(item_col)).alias("items"))
            .withColumn("n_items", F.size("items").cast("bigint")))


def distinct_ids(df: DataFrame) -> DataFrame:
    """Distinct user and item ids as one long table ``(kind, id)``."""
    users = df.select(F.lit("user").alias("kind"), F.col("user_id").alias("id")).distinct()
    its = df.select(F.lit("item").alias("kind"), F.col("item_id").alias("id")).distinct()
    return users.unionByName(its)


def dataset_profile(df: DataFrame) -> DataFrame:
    """One-row profile (A9): rows, users, items, distinct pairs, density.

    The exact distinct counts come from one table of distinct (user, item) pairs, which both sides
    group again (its shuffle is reused), instead of one copy of every row per count."""
    pairs = df.groupBy("user_id", "item_id").agg(F.count(F.lit(1)).alias("n"), F.min("rating").alias("low"),
                                                 F.max("rating").alias("high"), F.sum("rating").alias("total"))
    known = lambda c: F.col(c).isNotNull().cast("long")
    users = pairs.groupBy("user_id").agg(F.sum(known("item_id")).alias("p"), F.sum("n").alias("n"), F.min("low").alias("low"),
                                         F.max("high").alias("high"), F.sum("total").alias("total"))
    users = users.agg(F.sum(known("user_id")).alias("n_users"), F.sum(F.when(F.col("user_id").isNotNull(), F.col("p"))).alias("n_pairs"),
                      F.sum("n").alias("n_ratings"), F.min("low").alias("rating_min"), F.max("high").alias("rating_max"), F.sum("total").alias("total"))
    items = pairs.select("item_id").distinct().agg(F.count("item_id").alias("n_items"))
    one = users.unionByName(items, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in (
        "n_ratings", "n_users", "n_items", "n_pairs", "rating_min", "rating_max", "total")])
    zero = {c: 0 for c in ("n_ratings", "n_users", "n_items", "n_pairs")}
    one = one.withColumn("rating_mean", F.col("total") / F.col("n_ratings")).drop("total").fillna(zero)
    return one.withColumn("density", F.try_divide(F.col("n_pairs").cast("double"), (F.col("n_users") * F.col("n_items")).cast("double")))


def global_row_index(df: DataFrame, order_cols: list, index_col: str = "idx") -> DataFrame:
    """0-based position of each row in the total order ``order_cols`` without
    an unpartitioned window (which would run in one task).

    The rows are range-partitioned and sorted, written to the checkpoint
    directory (lineage cut; the sampled range bounds are not repeatable, so
    the sorted table must be read the same way by both uses), numbered
    within each partition, and shifted by the row count of all earlier
    partitions. Only one row per partition reaches the offsets table.
    """
    ordered = df.orderBy(*order_cols).checkpoint(eager=True)
    mono = ordered.withColumn("_m", F.monotonically_increasing_id())
    mono = mono.withColumn("_p", F.shiftright("_m", 33))
    mono = mono.withColumn("_l", F.col("_m") - F.shiftleft(F.col("_p"), 33))
    counts = mono.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn(
        "_off",
        F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    # offsets has one row per partition of the sorted table: a proven bound.
    return (mono.join(F.broadcast(offsets.select("_p", "_off")), "_p")
            .withColumn(index_col, (F.col("_off") + F.col("_l")).cast("bigint"))
            .drop("_m", "_p", "_l", "_off"))


def dense_index(df: DataFrame, id_col: str, index_col: str) -> DataFrame:
    """Distinct ids numbered 0..n-1 in id order."""
    return global_row_index(df.select(id_col).distinct(), [F.col(id_col)], index_col)


def index_ratings(df: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Attach dense user and item indices (J5, P12 as a join)."""
    return df.join(users, "user_id", "inner").join(items, "item_id", "inner")
