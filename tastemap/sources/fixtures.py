"""Stand-in inputs derived from the test tables (TPC-H-like star schema).

Every fixture is a Spark plan over the given Parquet tables, so its size
grows with the tables. The matching DuckDB text for each fixture lives in
:mod:`tastemap.plans.sql` and follows the same rules.

* ratings       customer x part through orders and lineitem
* ratings_dirty ratings as text with malformed ids, nulls, out-of-range,
                NaN and duplicated rows, by fixed rules on the keys
* items         part as book-like metadata, with nulls by fixed rules
* item_factors  embeddings as 64-dimensional item factors
* interactions  events as a second ratings source
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _rating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return li.join(od, li.l_orderkey == od.o_orderkey, "inner")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id bigint, item_id bigint, rating double), one row per line item."""
    return _rating_rows(spark, sf_dir).select(
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.ceil(F.col("l_quantity") / 10).cast("double").alias("rating"),
    )


def ratings_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as text with defects placed by fixed rules on the keys:
    order key divisible by 101 -> user id 'u<id>', by 107 -> '<id>.0', by 109 -> '<id>e0',
    by 103 -> item id 'b<id>', by 97 -> '<id>.7', by 73 -> 20 digits (out of range),
    line number 7 -> null rating, by 89 -> '0', by 83 -> '6', by 79 -> 'NaN';
    rows whose order key is divisible by 13 appear twice."""
    base = _rating_rows(spark, sf_dir)
    ok = F.col("l_orderkey")
    rating_txt = F.ceil(F.col("l_quantity") / 10).cast("string")
    rows = base.select(
        F.when(ok % 101 == 0, F.concat(F.lit("u"), F.col("o_custkey").cast("string")))
         .when(ok % 107 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
         .when(ok % 109 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit("e0")))
         .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
        F.when(ok % 103 == 0, F.concat(F.lit("b"), F.col("l_partkey").cast("string")))
         .when(ok % 97 == 0, F.concat(F.col("l_partkey").cast("string"), F.lit(".7")))
         .when(ok % 73 == 0, F.lit("99999999999999999999"))
         .otherwise(F.col("l_partkey").cast("string")).alias("item_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .when(ok % 89 == 0, F.lit("0"))
         .when(ok % 83 == 0, F.lit("6"))
         .when(ok % 79 == 0, F.lit("NaN"))
         .otherwise(rating_txt).alias("rating"),
        ok.alias("_ok"),
    )
    dup = rows.filter(F.col("_ok") % 13 == 0)
    return rows.unionByName(dup).drop("_ok")


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as item metadata: brand as author (Brand#7 -> null), size as a
    publication year (null when key divisible by 11), price / 300 as the
    average rating (null when key divisible by 7)."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("item_id"),
        F.when(F.col("p_brand") == "Brand#7", F.lit(None)).otherwise(F.col("p_brand")).alias("authors"),
        F.when(key % 11 == 0, F.lit(None)).otherwise(F.lit(1950) + F.col("p_size")).alias("original_publication_year"),
        F.when(key % 7 == 0, F.lit(None)).otherwise(F.col("p_retailprice") / 300).alias("average_rating"),
    )


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings as (item_id bigint, factor array<double>)."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("item_id"), F.col("embedding").cast("array<double>").alias("factor"))


# Rating by event type.
EVENT_RATINGS = {"error": 1.0, "view": 2.0, "click": 3.0, "signup": 4.0, "purchase": 5.0}


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a ratings source: item from ``props.k``, rating by event type."""
    ev = table(spark, sf_dir, "events")
    rating = F.lit(None).cast("double")
    for name, value in reversed(list(EVENT_RATINGS.items())):
        rating = F.when(F.col("event_type") == name, F.lit(value)).otherwise(rating)
    return ev.select(
        F.col("user_id"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        rating.alias("rating"),
    )
