"""Splits and samples.

Every random choice is a hash of the row's key and the seed
(``md5(user|item|seed)``), so the result does not depend on partitioning,
task order or retries, and a recomputed partition after an executor loss
gives the same rows.

The leave-one-out pick is a per-user aggregate with ``count(*)``, not a
window: an aggregate has a map-side partial step, so a user with a third of
all rows is not sorted in one task. Its order is one number of fixed width
(:func:`pick_order`), so both steps are hash aggregates without a sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.functions.exprs import hash_key, hash_number

TRIPLE = ["user_id", "item_id", "rating"]


_RATING_DIGITS = 18   # of the order below: +-10^5 in steps of 10^-12


def pick_order(seed: int = DEFAULTS.seed):
    """The order of the pick as a ``decimal(38, 0)``: 60 bits of ``md5(user|item|seed)``, then the rating (in steps of
    10^-12, held to +-10^5). A decimal fits the fixed-width buffer of hash aggregation, a string or struct does not.
    Within a user, rows of equal order are ratings of one pair closer than a step; nulls come last."""
    half = F.lit(10.0 ** 5)
    rating = F.coalesce(F.least(F.greatest(F.col("rating").cast("double"), -half), half), half)
    steps = F.floor((rating + half) * 1e12).cast("decimal(18,0)")
    high = F.conv(F.substring(hash_key("user_id", "item_id", seed=seed), 1, 15), 16, 10).cast("decimal(19,0)")
    return (high * F.lit(10 ** _RATING_DIGITS).cast("decimal(19,0)") + steps).cast("decimal(38,0)")


def holdout_picks(ratings: DataFrame, seed: int = DEFAULTS.seed) -> DataFrame:
    """The held-out row of each user with at least two rows (P8/W1):
    smallest ``md5(user|item|seed)``, then rating (:func:`pick_order`)."""
    per_user = (ratings.withColumn("_order", pick_order(seed)).groupBy("user_id")
                .agg(F.count(F.lit(1)).alias("_n"), F.min_by("item_id", "_order").alias("item_id"),
                     F.min_by("rating", "_order").alias("rating")))
    return per_user.filter(F.col("_n") >= 2).select("user_id", "item_id", "rating")


def holdout_flagged(ratings: DataFrame, seed: int = DEFAULTS.seed) -> DataFrame:
    """Ratings with a boolean ``is_test`` column (one pass, one join)."""
    picks = holdout_picks(ratings, seed).withColumn("is_test", F.lit(True))
    return (ratings.join(picks, TRIPLE, "left")
            .withColumn("is_test", F.coalesce(F.col("is_test"), F.lit(False))))


def holdout_per_user(ratings: DataFrame, seed: int = DEFAULTS.seed) -> tuple[DataFrame, DataFrame]:
    """Leave-one-out per user (L1): (train, test). Users with one row stay in
    train. Both sides come from one flagged table; persist it if both are used."""
    flagged = holdout_flagged(ratings, seed)
    train = flagged.filter(~F.col("is_test")).select(*TRIPLE)
    test = flagged.filter(F.col("is_test")).select(*TRIPLE)
    return train, test


def holdout_train_anti(ratings: DataFrame, seed: int = DEFAULTS.seed) -> DataFrame:
    """Train as all rows minus the test rows on the full triple."""
    return ratings.join(holdout_picks(ratings, seed), TRIPLE, "left_anti")


def hash_split(ratings: DataFrame, fraction: float = DEFAULTS.train_fraction,
               seed: int = DEFAULTS.seed) -> DataFrame:
    """Random row split (L2) as a flag: ``is_train`` when the first 8 hex
    digits of the row hash are below ``fraction * 2**32``."""
    bound = int(fraction * (1 << 32))
    return ratings.withColumn("is_train", hash_number("user_id", "item_id", seed=seed) < F.lit(bound))


def hash_sample(df: DataFrame, fraction: float = DEFAULTS.sample_fraction, seed: int = DEFAULTS.seed,
                key_cols=("user_id", "item_id")) -> DataFrame:
    """Bernoulli-style sample (L3) by hash; salted so it is independent of
    :func:`hash_split` with the same seed."""
    bound = int(fraction * (1 << 32))
    return df.filter(hash_number(F.lit("sample"), *key_cols, seed=seed) < F.lit(bound))


_BUCKETS = 1 << 16   # buckets of the first four hex digits of a hash


def _smallest(df: DataFrame, n: int, key, ties: list) -> DataFrame:
    """The ``n`` rows that come first by the hash ``key``, then ``ties``: a histogram of hash buckets gives the bucket in
    which the n-th row lies; all rows below it stay by a plain filter, and only that bucket is ordered."""
    bucket = F.conv(F.substring(key, 1, 4), 16, 10).cast("int")
    upto = Window.orderBy("bucket")   # over at most _BUCKETS rows
    counts = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    edge = counts.withColumn("upto", F.sum("n").over(upto)).filter(F.col("upto") >= n).orderBy("bucket").first()
    if edge is None:
        return df
    rest = df.filter(bucket == edge["bucket"]).orderBy(key, *ties).limit(n - (edge["upto"] - edge["n"]))
    return df.filter(bucket < edge["bucket"]).unionByName(rest)


def capped_rows(df: DataFrame, n: int, seed: int = DEFAULTS.seed,
                key_cols=("user_id", "item_id", "rating")) -> DataFrame:
    """Repeatable row cap (L4): the n rows with the smallest hash. The cap is the feature."""
    keys = list(key_cols)
    return _smallest(df, n, hash_key(*keys[:2], seed=seed), [F.col(c) for c in keys])


def capped_users(df: DataFrame, n: int, seed: int = DEFAULTS.seed) -> DataFrame:
    """Repeatable cap on users (T3): the n users with the smallest ``md5(user|seed)``."""
    return _smallest(df.select("user_id").distinct(), n, hash_key("user_id", seed=seed), [F.col("user_id")])
