"""Most-popular unseen lists: per user, the first K items of one global
order (item mean desc, item id) that the user has not rated in train.
They give the metrics a list source that needs no model.

No user x item product is formed. The global order is numbered once
(distributed), each user asks for the first K + (its seen count)
positions -- enough, since at most that many of them can be seen -- and
seen items are removed by an anti-join. Positions are generated in chunks
of at most ``chunk`` rows that are spread over tasks before they are
expanded, so a user who has rated a third of the catalogue is expanded by
many tasks. Rows produced: users x K + |train| at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.functions.exprs import round_score
from tastemap.operators.ranking import top_k
from tastemap.operators.ratings import global_row_index, item_stats


def expand_positions(need: DataFrame, n_col: str = "_need", chunk: int = 4096,
                     pos_col: str = "_pos") -> DataFrame:
    """(user_id, n) -> rows (user_id, pos) for pos in [0, n), expanded chunk-wise."""
    chunks = need.select("user_id", F.col(n_col),
                         F.explode(F.sequence(F.lit(0), ((F.col(n_col) - 1) / chunk).cast("int"))).alias("_c"))
    chunks = chunks.repartition("user_id", "_c")
    lo = F.col("_c") * chunk
    hi = F.least(lo + chunk, F.col(n_col)) - 1
    return chunks.select("user_id", F.explode(F.sequence(lo, hi)).alias(pos_col))


def popular_unseen(train: DataFrame, users: DataFrame, k: int = DEFAULTS.top_k) -> DataFrame:
    """Lists ``(user_id, item_id, score, rank)``; score = train item mean."""
    stats = item_stats(train).select("item_id", round_score("item_rating_mean").alias("score"))
    ranked = global_row_index(stats, [F.col("score").desc(), F.col("item_id").asc()], "_pos")
    seen = train.groupBy("user_id").agg(F.count(F.lit(1)).alias("_seen"))
    need = (users.select("user_id").distinct().join(seen, "user_id", "left")
            .select("user_id", (F.lit(k) + F.coalesce(F.col("_seen"), F.lit(0))).alias("_need")))
    cand = expand_positions(need).join(ranked, "_pos", "inner")
    cand = cand.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return top_k(cand, "user_id", [F.col("_pos").asc()], k).select("user_id", "item_id", "score", "rank")
