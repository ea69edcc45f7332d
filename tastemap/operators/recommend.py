"""Recommenders on factors and neighbours.

* :func:`user_factors_from_ratings` - rating-weighted mean of the item
  factors a user rated (vector aggregate with a map-side partial step).
* :func:`factor_recommend` - top-K items per user by dot product, seen
  items removed exactly (see :mod:`tastemap.operators.scoring`).
* :func:`item_neighbors` - top-N other items per item by dot product.
* :func:`knn_votes` / :func:`knn_recommend` - unweighted votes of the
  neighbours of a user's training items, seen items removed, top-K.

Each step is a join, an aggregate or a per-group top-K. Neighbours travel
packed, at most N to a training row, and are expanded only after the user's
rows are together; votes are grouped on (user, item), which spreads a heavy
user over many keys.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.operators.ranking import top_k
from tastemap.operators.scoring import factor_topk, neighbor_topk, unseen_topk


def user_factors_from_ratings(train: DataFrame, item_factors: DataFrame) -> DataFrame:
    """(user_id, factor, n_seen): weighted mean of rated items' factors;
    ``n_seen`` counts the user's train rows that have factors."""
    j = train.select("user_id", "item_id", "rating").join(item_factors, "item_id", "inner")
    agg = (j.groupBy("user_id")
           .agg(Summarizer.mean(array_to_vector("factor"), F.col("rating")).alias("v"),
                F.count(F.lit(1)).alias("n_seen")))
    return agg.select("user_id", vector_to_array("v").alias("factor"), "n_seen")


def factor_recommend(user_factors: DataFrame, item_factors: DataFrame, seen: DataFrame | None,
                     k: int = DEFAULTS.top_k, users: DataFrame | None = None) -> DataFrame:
    """Top-k ``(user_id, item_id, score, rank)`` over all items with factors.

    ``user_factors`` has ``(user_id, factor)`` and, when ``seen`` is given,
    ``n_seen`` (an upper bound of the user's seen items among the factor
    items). ``seen (user_id, item_id)`` pairs are removed (exclude seen)."""
    uf = user_factors
    if users is not None:
        uf = uf.join(users.select("user_id").distinct(), "user_id", "inner")
    extra = None
    if seen is not None:
        if "n_seen" not in uf.columns:
            counts = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_seen"))
            uf = uf.join(counts, "user_id", "left").fillna(0, ["n_seen"])
        extra = "n_seen"
    q = uf.select(F.col("user_id").alias("query_id"), "factor", *([extra] if extra else []))
    if seen is not None:
        cand = unseen_topk(q, item_factors, seen.select(F.col("user_id").alias("query_id"), "item_id"), k, extra)
    else:
        cand = factor_topk(q, item_factors, k)
    return top_k(cand.withColumnRenamed("query_id", "user_id"), "user_id", [F.col("score").desc(), F.col("item_id").asc()], k)


def item_neighbors(item_factors: DataFrame, n: int = DEFAULTS.knn_neighbors) -> DataFrame:
    """Top-n other items per item by dot product: ``(item_id, neighbor_id, score, rank)``."""
    cand = neighbor_topk(item_factors, n)
    cand = cand.select(F.col("query_id").alias("item_id"), F.col("item_id").alias("neighbor_id"), "score")
    return top_k(cand, "item_id", [F.col("score").desc(), F.col("neighbor_id").asc()], n)


def knn_expansion(train: DataFrame, neighbors: DataFrame, min_rating: float | None = None) -> DataFrame:
    """Neighbour expansion of liked items (J10): one row per (user, liked
    item, neighbour), as ``(user_id, item_id)`` with the neighbour as item."""
    liked_src = train if min_rating is None else train.filter(F.col("rating") >= min_rating)
    liked = liked_src.select("user_id", "item_id").distinct()
    return (liked.join(neighbors.select("item_id", "neighbor_id"), "item_id", "inner")
            .select("user_id", F.col("neighbor_id").alias("item_id")))


HEAVY_ROWS = 1_000_000   # rows of one key that go to a task


def _parts(rows: DataFrame, key: str, name: str) -> DataFrame:
    """Keys with more than ``HEAVY_ROWS`` rows and the number of parts to deal them in; at most rows / HEAVY_ROWS keys."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HEAVY_ROWS)
    return counts.select(key, F.ceil(F.col("_n") / HEAVY_ROWS).cast("int").alias(name))


def _part_of(other: str, parts: str):
    return F.pmod(F.xxhash64(other), F.coalesce(F.col(parts), F.lit(1))).cast("int")


def packed_neighbors(train: DataFrame, neighbors: DataFrame, min_rating: float | None = None) -> DataFrame:
    """``(user_id, item_id, _near, _u)``: the user's items with their neighbours packed (null: not liked), and the part of the
    user a row goes to. An item without neighbours that is none either gives no vote and takes none away: its rows leave here."""
    liked = F.lit(True) if min_rating is None else F.coalesce(F.col("rating") >= min_rating, F.lit(False))
    rows = train.select("user_id", "item_id", liked.alias("_liked")).filter("user_id is not null and item_id is not null")
    items, users = _parts(rows, "item_id", "_ip"), _parts(rows, "user_id", "_up")
    both = F.array(F.struct("item_id", "neighbor_id"), F.struct(F.col("neighbor_id").alias("item_id"), F.lit(None).alias("neighbor_id")))
    near = (neighbors.select(F.explode(both).alias("_b")).select("_b.*").groupBy("item_id").agg(F.collect_list("neighbor_id").alias("_near"))
            .join(items, "item_id", "left")
            .select("item_id", "_near", F.explode(F.sequence(F.lit(0), F.coalesce("_ip", F.lit(1)) - 1)).alias("_i")))
    pairs = (rows.join(items, "item_id", "left").withColumn("_i", _part_of("user_id", "_ip"))
             .repartition("item_id", "_i").groupBy("item_id", "_i", "user_id").agg(F.max("_liked").alias("_liked")))
    return (pairs.join(near, ["item_id", "_i"], "inner").join(users, "user_id", "left")
            .select("user_id", _part_of("item_id", "_up").alias("_u"), "item_id",
                    F.when(F.col("_liked"), F.col("_near")).alias("_near")))


def knn_votes(train: DataFrame, neighbors: DataFrame, min_rating: float | None = None) -> DataFrame:
    """``(user_id, item_id, votes)`` of unseen items (A10).

    The neighbours of an item are one array row. Training rows meet them in one shuffle by item, in which equal pairs
    also become one, and go to their user with the array still packed (:func:`packed_neighbors`): at most |train| rows, not N
    times as many. There the arrays are expanded and counted; the row's own item is counted along as seen, so seen items
    leave without a join. Items and users of more than ``HEAVY_ROWS`` rows are dealt in parts by a hash of the other id."""
    packed = packed_neighbors(train, neighbors, min_rating).repartition("user_id", "_u")
    own = F.array("item_id")
    own_first = F.when(F.col("_near").isNull(), own).otherwise(F.concat(own, "_near"))
    votes = (packed.select("user_id", F.posexplode(own_first).alias("_place", "item_id")).groupBy("user_id", "item_id")
             .agg(F.count_if(F.col("_place") > 0).alias("votes"), F.count_if(F.col("_place") == 0).alias("_seen")))
    return votes.filter("_seen = 0").select("user_id", "item_id", "votes")


def knn_recommend(votes: DataFrame, users: DataFrame | None = None, k: int = DEFAULTS.top_k) -> DataFrame:
    """Top-k by votes, ties to the smaller item id (T6). Users without any
    vote get no rows: an empty list, which the metrics count as 0 when the
    user is passed as a list user."""
    v = votes
    if users is not None:
        v = v.join(users.select("user_id").distinct(), "user_id", "inner")
    return top_k(v, "user_id", [F.col("votes").desc(), F.col("item_id").asc()], k)
