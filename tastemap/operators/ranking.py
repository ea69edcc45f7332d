"""Per-group top-K.

``row_number() over (partition by g order by ...) <= k`` is planned by
Spark as a WindowGroupLimit: a partial limit runs on the map side before
the shuffle, so after the exchange each group holds at most
k x (map partitions) rows. A group that owns a third of all candidate rows
is cut down where it lies, not shipped whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, group_cols, order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group in ``order`` (which must be a
    total order: end it with a key column); adds a 1-based bigint rank."""
    if isinstance(group_cols, str):
        group_cols = [group_cols]
    w = Window.partitionBy(*group_cols).orderBy(*order)
    return (df.withColumn(rank_col, F.row_number().over(w))
            .filter(F.col(rank_col) <= k)
            .withColumn(rank_col, F.col(rank_col).cast("bigint")))

