"""Registry of checked queries: each key has a Spark plan over the test
tables and, where SQL can express it, the DuckDB text that must give the
same rows.

Conventions for the comparison: keys are bigint, ranks and counts bigint,
computed doubles rounded to 6 decimals on both sides, arrays rendered as
comma-joined text, and no vector column in any result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.functions.exprs import round_score
from tastemap.operators import metrics as M
from tastemap.operators import popular, profile, ratings as R, split as S
from tastemap.operators.ranking import top_k
from tastemap.operators import als as ALS, features as FE, recommend as REC, svd as SVD
from tastemap.functions.exprs import clip
from tastemap.plans.sql import metric_rows_sql, ranking_sql, with_ctes
from tastemap.sources import fixtures as FX
from tastemap.sources import sinks, tables
from tastemap.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared bases

def clean(spark, sf) -> DataFrame:
    return R.clean_ratings(FX.ratings(spark, sf))


def split(spark, sf):
    return S.holdout_per_user(clean(spark, sf))


def split_once(spark, sf):
    """The same split written once, for queries that read it several times."""
    from tastemap.plans.pipeline import prepare
    return prepare(FX.ratings(spark, sf))[1:]


def lists_popular(spark, sf, k=DEFAULTS.top_k):
    train, test = split_once(spark, sf)
    return popular.popular_unseen(train, test.select("user_id").distinct(), k), train, test


# ---------------------------------------------------------------- scans

@register("scan_ratings", with_ctes("SELECT user_id, item_id, rating FROM ratings", "ratings"))
def q_scan_ratings(spark, sf):
    return FX.ratings(spark, sf)


_DIRTY_SQL = """dirty AS (
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN 'u' || CAST(o_custkey AS VARCHAR) WHEN l_orderkey % 107 = 0 THEN o_custkey || '.0'
              WHEN l_orderkey % 109 = 0 THEN o_custkey || 'e0' ELSE CAST(o_custkey AS VARCHAR) END AS user_id,
         CASE WHEN l_orderkey % 103 = 0 THEN 'b' || CAST(l_partkey AS VARCHAR) WHEN l_orderkey % 97 = 0 THEN l_partkey || '.7'
              WHEN l_orderkey % 73 = 0 THEN '99999999999999999999' ELSE CAST(l_partkey AS VARCHAR) END AS item_id,
         CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 89 = 0 THEN '0'
              WHEN l_orderkey % 83 = 0 THEN '6' WHEN l_orderkey % 79 = 0 THEN 'NaN'
              ELSE CAST(CAST(ceil(l_quantity / 10) AS BIGINT) AS VARCHAR) END AS rating,
         l_orderkey AS ok
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
dirty_all AS (SELECT user_id, item_id, rating FROM dirty
              UNION ALL SELECT user_id, item_id, rating FROM dirty WHERE ok % 13 = 0),
typed AS (SELECT TRY_CAST(trunc(TRY_CAST(user_id AS DOUBLE)) AS BIGINT) AS user_id,
                 TRY_CAST(trunc(TRY_CAST(item_id AS DOUBLE)) AS BIGINT) AS item_id,
                 TRY_CAST(rating AS DOUBLE) AS rating FROM dirty_all)"""


@register("scan_csv_ratings", with_ctes("SELECT user_id, item_id, rating FROM ratings", "ratings"))
def q_scan_csv_ratings(spark, sf):
    path = scratch_path(spark, "ratings-csv")
    FX.ratings(spark, sf).write.option("header", "true").csv(path)
    return R.clean_ratings(tables.scan_ratings(spark, path), dedup="none")


@register("scan_parquet_ratings", with_ctes("SELECT user_id, item_id, rating FROM ratings", "ratings"))
def q_scan_parquet_ratings(spark, sf):
    """S2 by suffix, with the item column under its other accepted name."""
    path = scratch_path(spark, "ratings") + ".parquet"
    FX.ratings(spark, sf).withColumnRenamed("item_id", "book_id").write.parquet(path)
    return tables.scan_ratings(spark, path)


@register("source_preference_parquet", with_ctes("SELECT user_id, item_id, rating FROM ratings WHERE rating >= 3", "ratings"))
def q_source_preference_parquet(spark, sf):
    """Both copies exist and differ, so the rows tell that the Parquet one was read."""
    base = scratch_path(spark, "both")
    FX.ratings(spark, sf).write.option("header", "true").csv(f"{base}/ratings.csv")
    FX.ratings(spark, sf).filter("rating >= 3").write.parquet(f"{base}/ratings.parquet")
    return tables.scan_ratings_any(spark, [f"{base}/ratings.parquet", f"{base}/ratings.csv"])


@register("csv_to_parquet", with_ctes("SELECT user_id, item_id, rating FROM ratings", "ratings"))
def q_csv_to_parquet(spark, sf):
    csv = scratch_path(spark, "stage-csv")
    FX.ratings(spark, sf).write.option("header", "true").csv(csv)
    staged = tables.csv_to_parquet(spark, csv, scratch_path(spark, "stage") + ".parquet",
                                   schema=tables.RATINGS_TEXT_SCHEMA)
    return R.clean_ratings(staged, dedup="none")


@register("source_preference", with_ctes("SELECT user_id, item_id, rating FROM ratings", "ratings"))
def q_source_preference(spark, sf):
    """The Parquet copy when it exists, else the CSV; here only the CSV
    exists, so the second candidate is read."""
    base = scratch_path(spark, "pref")
    FX.ratings(spark, sf).write.option("header", "true").csv(f"{base}/ratings.csv")
    df = tables.scan_ratings_any(spark, [f"{base}/ratings.parquet", f"{base}/ratings.csv"])
    return R.clean_ratings(df, dedup="none")


@register("stage_raw_tables", with_ctes("""SELECT 'ratings' AS table_name, true AS staged, count(*) AS n_rows FROM ratings
UNION ALL SELECT 'books', true, (SELECT count(*) FROM part)
UNION ALL SELECT 'book_tags', false, CAST(NULL AS BIGINT)
UNION ALL SELECT 'tags', false, CAST(NULL AS BIGINT)
UNION ALL SELECT 'to_read', false, CAST(NULL AS BIGINT)""", "ratings"))
def q_stage_raw_tables(spark, sf):
    base = scratch_path(spark, "raw")
    FX.ratings(spark, sf).write.option("header", "true").csv(f"{base}/ratings.csv")
    FX.items(spark, sf).write.option("header", "true").csv(f"{base}/books.csv")
    return tables.stage_raw_tables(spark, base, base + "-parquet",
                                   ["ratings", "books", "book_tags", "tags", "to_read"])


@register("scan_items", with_ctes(
    "SELECT item_id, authors, original_publication_year, round(average_rating, 6) AS average_rating FROM items",
    "items"))
def q_scan_items(spark, sf):
    path = scratch_path(spark, "books-csv")
    FX.items(spark, sf).withColumn("extra", F.lit("x")).write.option("header", "true").csv(path)
    df = tables.scan_items(spark, path)
    return df.select(F.col("item_id").cast("bigint"), "authors",
                     F.col("original_publication_year").cast("int"),
                     r6(F.col("average_rating").cast("double")).alias("average_rating"))


@register("scan_item_factors", with_ctes(
    "SELECT item_id, CAST(len(factor) AS BIGINT) AS dims, round(sqrt(list_inner_product(factor, factor)), 6) AS norm FROM factors",
    "factors"))
def q_scan_item_factors(spark, sf):
    path = scratch_path(spark, "factors") + ".parquet"
    sinks.write_item_factors(FX.item_factors(spark, sf), path)
    f = tables.scan_item_factors(spark, path)
    from tastemap.functions.exprs import array_norm
    return f.select("item_id", F.size("factor").cast("bigint").alias("dims"), r6(array_norm("factor")).alias("norm"))


# ---------------------------------------------------------------- cleaning, stats

@register("clean_ratings", with_ctes("""SELECT DISTINCT user_id, item_id, rating FROM typed
WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL AND NOT isnan(rating)
  AND rating BETWEEN 1 AND 5""", extra=_DIRTY_SQL))
def q_clean_ratings(spark, sf):
    path = scratch_path(spark, "dirty-csv")
    FX.ratings_dirty(spark, sf).write.option("header", "true").csv(path)
    return R.clean_ratings(tables.scan_ratings(spark, path))


@register("dedup_pairs", with_ctes(
    "SELECT user_id, item_id, round(avg(rating), 6) AS rating, count(*) AS n_ratings FROM clean GROUP BY user_id, item_id",
    "clean"))
def q_dedup_pairs(spark, sf):
    d = R.dedup_pairs(clean(spark, sf))
    return d.select("user_id", "item_id", r6("rating").alias("rating"), "n_ratings")


@register("item_stats", with_ctes(
    "SELECT item_id, item_rating_count, round(item_rating_mean, 6) AS item_rating_mean FROM istats", "istats"))
def q_item_stats(spark, sf):
    s = R.item_stats(clean(spark, sf))
    return s.select("item_id", "item_rating_count", r6("item_rating_mean").alias("item_rating_mean"))


@register("user_stats", with_ctes(
    "SELECT user_id, user_rating_count, round(user_rating_mean, 6) AS user_rating_mean FROM ustats", "ustats"))
def q_user_stats(spark, sf):
    s = R.user_stats(clean(spark, sf))
    return s.select("user_id", "user_rating_count", r6("user_rating_mean").alias("user_rating_mean"))


@register("enrich_stats", with_ctes("""SELECT c.user_id, c.item_id, c.rating, i.item_rating_count,
  round(i.item_rating_mean, 6) AS item_rating_mean, u.user_rating_count, round(u.user_rating_mean, 6) AS user_rating_mean
FROM clean c LEFT JOIN istats i USING (item_id) LEFT JOIN ustats u USING (user_id)""", "istats", "ustats"))
def q_enrich_stats(spark, sf):
    e = R.enrich_stats(clean(spark, sf))
    return e.select("user_id", "item_id", "rating", "item_rating_count", r6("item_rating_mean").alias("item_rating_mean"),
                    "user_rating_count", r6("user_rating_mean").alias("user_rating_mean"))


@register("enrich_items", with_ctes("""SELECT user_id, item_id, rating, authors, original_publication_year,
  round(average_rating, 6) AS average_rating FROM enriched""", "enriched"))
def q_enrich_items(spark, sf):
    e = R.enrich_items(clean(spark, sf), FX.items(spark, sf))
    return e.select("user_id", "item_id", "rating", "authors", "original_publication_year",
                    r6("average_rating").alias("average_rating"))


@register("distinct_ids", with_ctes("""SELECT 'user' AS kind, user_id AS id FROM (SELECT DISTINCT user_id FROM clean) a
UNION ALL SELECT 'item' AS kind, item_id AS id FROM (SELECT DISTINCT item_id FROM clean) b""", "clean"))
def q_distinct_ids(spark, sf):
    return R.distinct_ids(clean(spark, sf))


@register("dataset_profile", with_ctes("""SELECT count(*) AS n_ratings, count(DISTINCT user_id) AS n_users,
  count(DISTINCT item_id) AS n_items, (SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM clean) p) AS n_pairs,
  min(rating) AS rating_min, max(rating) AS rating_max, round(avg(rating), 6) AS rating_mean,
  round((SELECT count(*) FROM (SELECT DISTINCT user_id, item_id FROM clean) p)
        / (count(DISTINCT user_id) * count(DISTINCT item_id)), 6) AS density FROM clean""", "clean"))
def q_dataset_profile(spark, sf):
    p = R.dataset_profile(clean(spark, sf))
    return p.select("n_ratings", "n_users", "n_items", "n_pairs", "rating_min", "rating_max",
                    r6("rating_mean").alias("rating_mean"), r6("density").alias("density"))


@register("user_item_sets", with_ctes("""SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY item_id) AS items,
  count(*) AS n_items FROM (SELECT DISTINCT user_id, item_id FROM train) s GROUP BY user_id""", "train"))
def q_user_item_sets(spark, sf):
    train, _ = split(spark, sf)
    s = R.user_item_sets(train)
    return s.select("user_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"),
                    "n_items")


# ---------------------------------------------------------------- ranking slice

@register("topk_per_user", with_ctes("""SELECT user_id, item_id, rating, item_rating_mean, rank FROM (
  SELECT c.user_id, c.item_id, c.rating, round(s.item_rating_mean, 6) AS item_rating_mean,
         row_number() OVER (PARTITION BY c.user_id
           ORDER BY c.rating DESC, round(s.item_rating_mean, 9) DESC, c.item_id) AS rank
  FROM clean c JOIN istats s USING (item_id)) q WHERE rank <= 10""", "clean", "istats"))
def q_topk_per_user(spark, sf):
    return topk_per_user(clean(spark, sf), DEFAULTS.top_k)


def topk_per_user(ratings: DataFrame, k: int) -> DataFrame:
    """Each user's k best-rated items; ties by item mean, then item id."""
    joined = ratings.join(R.item_stats(ratings), "item_id", "inner")
    order = [F.col("rating").desc(), round_score("item_rating_mean").desc(), F.col("item_id").asc()]
    return top_k(joined, "user_id", order, k).select(
        "user_id", "item_id", "rating", r6("item_rating_mean").alias("item_rating_mean"), "rank")


# ---------------------------------------------------------------- splits

@register("holdout_test", with_ctes("SELECT user_id, item_id, rating FROM test", "test"))
def q_holdout_test(spark, sf):
    return split(spark, sf)[1]


@register("holdout_train", with_ctes("SELECT user_id, item_id, rating FROM train", "train"))
def q_holdout_train(spark, sf):
    return split(spark, sf)[0]


@register("holdout_train_anti", with_ctes("SELECT user_id, item_id, rating FROM train", "train"))
def q_holdout_train_anti(spark, sf):
    return S.holdout_train_anti(clean(spark, sf))


@register("hash_split", with_ctes(f"""SELECT user_id, item_id, rating,
  CAST(('0x' || substr(md5(concat_ws('|', user_id, item_id, 42)), 1, 8)) AS BIGINT) < {int(0.8 * (1 << 32))} AS is_train
FROM clean""", "clean"))
def q_hash_split(spark, sf):
    return S.hash_split(clean(spark, sf))


@register("hash_sample", with_ctes(f"""SELECT user_id, item_id, rating FROM clean
WHERE CAST(('0x' || substr(md5(concat_ws('|', 'sample', user_id, item_id, 42)), 1, 8)) AS BIGINT) < {int(0.05 * (1 << 32))}""",
                                   "clean"))
def q_hash_sample(spark, sf):
    return S.hash_sample(clean(spark, sf))


@register("capped_ratings", with_ctes("""SELECT user_id, item_id, rating FROM clean
ORDER BY md5(concat_ws('|', user_id, item_id, 42)), user_id, item_id, rating LIMIT 1000""", "clean"))
def q_capped_ratings(spark, sf):
    return S.capped_rows(clean(spark, sf), 1000)


@register("capped_users", with_ctes("""SELECT user_id FROM (SELECT DISTINCT user_id FROM clean) u
ORDER BY md5(concat_ws('|', user_id, 42)), user_id LIMIT 1000""", "clean"))
def q_capped_users(spark, sf):
    return S.capped_users(clean(spark, sf), 1000)


# ---------------------------------------------------------------- profiles

@register("rating_distribution", with_ctes(
    "SELECT rating, count(*) AS n_ratings FROM clean GROUP BY rating", "clean"))
def q_rating_distribution(spark, sf):
    return profile.rating_distribution(clean(spark, sf))


def _hist_sql(key: str) -> str:
    return with_ctes(f"""SELECT bin, round(lo + bin * (hi - lo) / 50, 6) AS bin_lo,
  round(lo + (bin + 1) * (hi - lo) / 50, 6) AS bin_hi, count(*) AS n_keys FROM (
  SELECT CAST(CASE WHEN hi = lo THEN 0 ELSE least(49, floor((n - lo) * 50 / (hi - lo))) END AS BIGINT) AS bin, lo, hi
  FROM (SELECT {key}, count(*) AS n FROM clean GROUP BY {key}) pk,
       (SELECT min(n) AS lo, max(n) AS hi FROM (SELECT {key}, count(*) AS n FROM clean GROUP BY {key}) x) b) s
GROUP BY bin, lo, hi""", "clean")


def _hist(df):
    return df.select("bin", r6("bin_lo").alias("bin_lo"), r6("bin_hi").alias("bin_hi"), "n_keys")


@register("hist_per_item", _hist_sql("item_id"))
def q_hist_per_item(spark, sf):
    return _hist(profile.hist_per_item(clean(spark, sf)))


@register("hist_per_user", _hist_sql("user_id"))
def q_hist_per_user(spark, sf):
    return _hist(profile.hist_per_user(clean(spark, sf)))


# ---------------------------------------------------------------- dense ids

@register("dense_user_index", with_ctes("SELECT user_id, u_idx FROM uidx", "uidx"))
def q_dense_user_index(spark, sf):
    return R.dense_index(clean(spark, sf), "user_id", "u_idx")


@register("dense_item_index", with_ctes("SELECT item_id, i_idx FROM iidx", "iidx"))
def q_dense_item_index(spark, sf):
    return R.dense_index(clean(spark, sf), "item_id", "i_idx")


@register("index_ratings", with_ctes("""SELECT c.user_id, c.item_id, c.rating, u.u_idx, i.i_idx
FROM clean c JOIN uidx u USING (user_id) JOIN iidx i USING (item_id)""", "uidx", "iidx"))
def q_index_ratings(spark, sf):
    c = clean(spark, sf)
    out = R.index_ratings(c, R.dense_index(c, "user_id", "u_idx"), R.dense_index(c, "item_id", "i_idx"))
    return out.select("user_id", "item_id", "rating", "u_idx", "i_idx")


@register("sparse_row_chunks", with_ctes("""SELECT u.u_idx, i.i_idx // 64 AS chunk, count(*) AS nnz,
  string_agg(CAST(i.i_idx AS VARCHAR), ',' ORDER BY i.i_idx) AS indices, round(sum(p.rating), 6) AS value_sum
FROM (SELECT user_id, item_id, avg(rating) AS rating FROM train GROUP BY user_id, item_id) p
JOIN uidx u USING (user_id) JOIN iidx i USING (item_id) GROUP BY u.u_idx, i.i_idx // 64""", "train", "uidx", "iidx"))
def q_sparse_row_chunks(spark, sf):
    from tastemap.operators.svd import sparse_row_chunks
    c = clean(spark, sf)
    train, _ = S.holdout_per_user(c)
    rows = sparse_row_chunks(R.dedup_pairs(train), R.dense_index(c, "user_id", "u_idx"), R.dense_index(c, "item_id", "i_idx"), 64)
    return rows.select(
        "u_idx", "chunk", F.size("entries").cast("bigint").alias("nnz"),
        F.array_join(F.transform("entries", lambda e: e["i_idx"].cast("string")), ",").alias("indices"),
        r6(F.aggregate("entries", F.lit(0.0), lambda s, e: s + e["value"])).alias("value_sum"))


@register("sparse_rows", with_ctes("""SELECT u.u_idx, count(*) AS nnz,
  string_agg(CAST(i.i_idx AS VARCHAR), ',' ORDER BY i.i_idx) AS indices, round(sum(p.rating), 6) AS value_sum
FROM (SELECT user_id, item_id, avg(rating) AS rating FROM train GROUP BY user_id, item_id) p
JOIN uidx u USING (user_id) JOIN iidx i USING (item_id) GROUP BY u.u_idx""", "train", "uidx", "iidx"))
def q_sparse_rows(spark, sf):
    from tastemap.operators.svd import sparse_rows
    c = clean(spark, sf)
    train, _ = S.holdout_per_user(c)
    rows = sparse_rows(R.dedup_pairs(train), R.dense_index(c, "user_id", "u_idx"), R.dense_index(c, "item_id", "i_idx"))
    return rows.select(
        "u_idx", F.size("entries").cast("bigint").alias("nnz"),
        F.array_join(F.transform("entries", lambda e: e["i_idx"].cast("string")), ",").alias("indices"),
        r6(F.aggregate("entries", F.lit(0.0), lambda s, e: s + e["value"])).alias("value_sum"))


# ---------------------------------------------------------------- metrics

@register("truth_sets", with_ctes("SELECT user_id, item_id FROM truth", "truth"))
def q_truth_sets(spark, sf):
    return M.truth_sets(split(spark, sf)[1])


def _metric_query(metric: str):
    sql = with_ctes(f"""SELECT CAST(10 AS BIGINT) AS k, count(*) AS users,
  round(coalesce(avg({ {'precision_at_k': 'hits / 10.0', 'recall_at_k': 'hits / n_relevant',
                        'ndcg_at_k': 'CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END'}[metric] }), 0.0), 6) AS {metric}
FROM pu""", "lists", "truth", "idcg", extra=ranking_sql("lists", 10))

    def fn(spark, sf):
        lists, _, test = lists_popular(spark, sf)
        m = M.ranking_metrics(lists, M.truth_sets(test), DEFAULTS.top_k)
        return m.select("k", "users", r6(metric).alias(metric))
    register(metric, sql)(fn)


for _m in ("precision_at_k", "recall_at_k", "ndcg_at_k"):
    _metric_query(_m)


@register("recs_nested", with_ctes("""SELECT user_id, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS items,
  count(*) AS n FROM lists GROUP BY user_id""", "lists"))
def q_recs_nested(spark, sf):
    lists, _, _ = lists_popular(spark, sf)
    path = scratch_path(spark, "recs") + ".parquet"
    sinks.write_lists(lists, path)
    back = spark.read.parquet(path)
    return back.select("user_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"),
                       F.size("items").cast("bigint").alias("n"))



# ---------------------------------------------------------------- factors, neighbours, kNN

def factor_bases(spark, sf):
    train, test = split(spark, sf)
    vf = FX.item_factors(spark, sf)
    uf = REC.user_factors_from_ratings(train, vf)
    return train, test, uf, vf


@register("item_neighbors", with_ctes(
    "SELECT item_id, neighbor_id, score, CAST(rank AS BIGINT) AS rank FROM neighbors", "neighbors"))
def q_item_neighbors(spark, sf):
    nb = REC.item_neighbors(FX.item_factors(spark, sf), DEFAULTS.knn_neighbors)
    return nb.select("item_id", "neighbor_id", "score", "rank")


def knn_bases(spark, sf):
    train, test = split_once(spark, sf)   # the votes read train four times
    nb = REC.item_neighbors(FX.item_factors(spark, sf), DEFAULTS.knn_neighbors)
    return train, test, nb


@register("unseen_candidates", with_ctes("SELECT DISTINCT user_id, item_id FROM cands", "cands"))
def q_unseen_candidates(spark, sf):
    train, _, nb = knn_bases(spark, sf)
    return REC.knn_votes(train, nb).select("user_id", "item_id")


@register("knn_votes", with_ctes("SELECT user_id, item_id, votes FROM votes", "votes"))
def q_knn_votes(spark, sf):
    train, _, nb = knn_bases(spark, sf)
    return REC.knn_votes(train, nb)


def knn_lists(spark, sf):
    train, test, nb = knn_bases(spark, sf)
    users = test.select("user_id").distinct()
    return REC.knn_recommend(REC.knn_votes(train, nb), users, DEFAULTS.top_k), train, test, users


@register("knn_recommend", with_ctes("SELECT user_id, item_id, votes, CAST(rank AS BIGINT) AS rank FROM knn", "knn"))
def q_knn_recommend(spark, sf):
    return knn_lists(spark, sf)[0]


@register("score_pairs", with_ctes("""SELECT c.user_id, c.item_id, round(list_inner_product(u.factor, f.factor), 6) AS score
FROM (SELECT DISTINCT user_id, item_id FROM cands) c JOIN ufac u USING (user_id) JOIN factors f USING (item_id)""",
                                   "cands", "ufac"))
def q_score_pairs(spark, sf):
    """Scores of the kNN candidate pairs under the factor model: a given
    pair set is scored, never all user x item pairs."""
    train, _, uf, vf = factor_bases(spark, sf)
    nb = REC.item_neighbors(vf, DEFAULTS.knn_neighbors)
    cand = REC.knn_votes(train, nb).select("user_id", "item_id")
    sc = SVD.predict_with_factors(cand, uf.drop("n_seen"), vf, many=True)
    return sc.select("user_id", "item_id", r6("prediction").alias("score"))


_PRED_SQL = """SELECT t.user_id, t.item_id, t.rating, list_inner_product(u.factor, f.factor) AS prediction
FROM test t JOIN ufac u USING (user_id) JOIN factors f USING (item_id)"""


def factor_predictions(spark, sf):
    _, test, uf, vf = factor_bases(spark, sf)
    return SVD.predict_with_factors(test, uf.drop("n_seen"), vf)


@register("predict_pairs", with_ctes(
    f"SELECT user_id, item_id, rating, round(prediction, 6) AS prediction FROM ({_PRED_SQL}) p", "test", "ufac"))
def q_predict_pairs(spark, sf):
    p = factor_predictions(spark, sf)
    return p.select("user_id", "item_id", "rating", r6("prediction").alias("prediction"))


@register("clip_predictions", with_ctes(
    f"""SELECT user_id, item_id, rating, round(least(5.0, greatest(1.0, prediction)), 6) AS prediction
FROM ({_PRED_SQL}) p""", "test", "ufac"))
def q_clip_predictions(spark, sf):
    p = factor_predictions(spark, sf)
    return p.select("user_id", "item_id", "rating", r6(clip("prediction", 1.0, 5.0)).alias("prediction"))


@register("rmse", with_ctes(f"""SELECT round(sqrt(avg(pow(rating - least(5.0, greatest(1.0, prediction)), 2))), 6) AS rmse,
  count(*) AS n_scored FROM ({_PRED_SQL}) p""", "test", "ufac"))
def q_rmse(spark, sf):
    e = M.rmse(factor_predictions(spark, sf), clip_to=(1.0, 5.0))
    return e.select(r6("rmse").alias("rmse"), "n_scored")


def factor_lists(spark, sf):
    train, test, uf, vf = factor_bases(spark, sf)
    users = test.select("user_id").distinct()
    return REC.factor_recommend(uf, vf, train, DEFAULTS.top_k, users=users), train, test


@register("factor_recommend", with_ctes("""SELECT user_id, item_id, score, CAST(rank AS BIGINT) AS rank FROM (
  SELECT u.user_id, f.item_id, round(list_inner_product(u.factor, f.factor), 9) AS score,
         row_number() OVER (PARTITION BY u.user_id
           ORDER BY round(list_inner_product(u.factor, f.factor), 9) DESC, f.item_id) AS rank
  FROM ufac u JOIN tusers USING (user_id) CROSS JOIN factors f
  WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = f.item_id)) s
WHERE rank <= 10""", "ufac", "tusers"))
def q_factor_recommend(spark, sf):
    lists, _, _ = factor_lists(spark, sf)
    return lists.select("user_id", "item_id", "score", "rank")


_FLISTS = """flists AS (
  SELECT user_id, item_id, rank FROM (
    SELECT u.user_id, f.item_id,
           row_number() OVER (PARTITION BY u.user_id
             ORDER BY round(list_inner_product(u.factor, f.factor), 9) DESC, f.item_id) AS rank
    FROM ufac u JOIN tusers USING (user_id) CROSS JOIN factors f
    WHERE NOT EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id AND t.item_id = f.item_id)) s
  WHERE rank <= 10)"""


@register("metrics_long", with_ctes(
    f"""SELECT model, metric, round(value, 6) AS value, 'ok' AS status FROM (
{metric_rows_sql('popular', 'ppu')}
UNION ALL {metric_rows_sql('knn', 'kpu')}
UNION ALL {metric_rows_sql('factor', 'fpu')}
UNION ALL SELECT 'factor', 'rmse', sqrt(avg(pow(rating - least(5.0, greatest(1.0, prediction)), 2))) FROM ({_PRED_SQL}) p
UNION ALL SELECT 'factor', 'n_scored', count(*) FROM ({_PRED_SQL}) p) m""",
    "lists", "knn", "truth", "idcg", "ufac", "tusers",
    extra=",\n".join([_FLISTS, ranking_sql("lists", 10, prefix="p"),
                      ranking_sql("knn", 10, list_users="SELECT user_id FROM tusers", prefix="k"),
                      ranking_sql("flists", 10, prefix="f")])))
def q_metrics_long(spark, sf):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(model_metrics(spark, sf), path)
    back = spark.read.schema("model string, metric string, value double, status string").json(path)
    return back.select("model", "metric", r6("value").alias("value"), "status")


def model_metrics(spark, sf) -> DataFrame:
    """Metrics of three list sources on one hold-out split: most popular,
    item-kNN on the embedding neighbours and factor scoring."""
    from tastemap.plans.pipeline import prepare
    k = DEFAULTS.top_k
    _, train, test = prepare(FX.ratings(spark, sf))  # split written once, read by all models
    truth = M.truth_sets(test)
    users = test.select("user_id").distinct()
    pop = popular.popular_unseen(train, users, k)
    vf = FX.item_factors(spark, sf)
    nb = REC.item_neighbors(vf, DEFAULTS.knn_neighbors)
    knn = REC.knn_recommend(REC.knn_votes(train, nb), users, k)
    uf = REC.user_factors_from_ratings(train, vf)
    fl = REC.factor_recommend(uf, vf, train, k, users=users)
    err = M.rmse(SVD.predict_with_factors(test, uf.drop("n_seen"), vf), clip_to=(1.0, 5.0))
    return (M.metrics_long("popular", M.ranking_metrics(pop, truth, k))
            .unionByName(M.metrics_long("knn", M.ranking_metrics(knn, truth, k, list_users=users)))
            .unionByName(M.metrics_long("factor", M.ranking_metrics(fl, truth, k), err)))


@register("model_comparison", with_ctes(
    f"""SELECT model, round(max(CASE WHEN metric = 'rmse' THEN value END), 6) AS rmse,
  round(max(CASE WHEN metric = 'precision_at_k' THEN value END), 6) AS precision_at_k,
  round(max(CASE WHEN metric = 'recall_at_k' THEN value END), 6) AS recall_at_k,
  round(max(CASE WHEN metric = 'ndcg_at_k' THEN value END), 6) AS ndcg_at_k FROM (
{metric_rows_sql('popular', 'ppu')}
UNION ALL {metric_rows_sql('knn', 'kpu')}
UNION ALL {metric_rows_sql('factor', 'fpu')}
UNION ALL SELECT 'factor', 'rmse', sqrt(avg(pow(rating - least(5.0, greatest(1.0, prediction)), 2))) FROM ({_PRED_SQL}) p) m
GROUP BY model""",
    "lists", "knn", "truth", "idcg", "ufac", "tusers",
    extra=",\n".join([_FLISTS, ranking_sql("lists", 10, prefix="p"),
                      ranking_sql("knn", 10, list_users="SELECT user_id FROM tusers", prefix="k"),
                      ranking_sql("flists", 10, prefix="f")])))
def q_model_comparison(spark, sf):
    """Wide comparison table, one row per model."""
    wide = M.compare_models(model_metrics(spark, sf))
    return wide.select("model", *[r6(c).alias(c) for c in ("rmse", "precision_at_k", "recall_at_k", "ndcg_at_k")])


# ---------------------------------------------------------------- features

def enriched(spark, sf):
    c = clean(spark, sf)
    return R.enrich_items(R.enrich_stats(c), FX.items(spark, sf))


TOP_N = 10  # categories kept at the test scale (25 brands)


@register("top_categories", with_ctes("""SELECT authors, n_ratings FROM (
  SELECT authors, count(*) AS n_ratings FROM enriched GROUP BY authors
  ORDER BY n_ratings DESC, authors ASC NULLS FIRST LIMIT 10) t
WHERE authors IS NOT NULL AND authors <> ''""", "enriched"))
def q_top_categories(spark, sf):
    return FE.top_categories(enriched(spark, sf), "authors", TOP_N)


@register("top_categories_default", with_ctes("""SELECT authors, n_ratings FROM (
  SELECT authors, count(*) AS n_ratings FROM enriched GROUP BY authors
  ORDER BY n_ratings DESC, authors ASC NULLS FIRST LIMIT 200) t
WHERE authors IS NOT NULL AND authors <> ''""", "enriched"))
def q_top_categories_default(spark, sf):
    """The documented default of 200 categories."""
    return FE.top_categories(enriched(spark, sf), "authors")


_TOPCAT = """topcat AS (SELECT authors FROM (
  SELECT authors, count(*) AS n_ratings FROM enriched GROUP BY authors
  ORDER BY n_ratings DESC, authors ASC NULLS FIRST LIMIT 10) t WHERE authors IS NOT NULL AND authors <> ''),
collapsed AS (SELECT e.*, CASE WHEN e.authors IS NULL THEN 'unknown'
                              WHEN e.authors IN (SELECT authors FROM topcat) THEN e.authors ELSE 'other' END AS authors_kept
              FROM enriched e)"""


def collapsed(spark, sf):
    e = enriched(spark, sf)
    return FE.collapse_categories(e, FE.top_categories(e, "authors", TOP_N))


@register("collapse_categories", with_ctes(
    "SELECT user_id, item_id, rating, authors_kept FROM collapsed", "enriched", extra=_TOPCAT))
def q_collapse_categories(spark, sf):
    return collapsed(spark, sf).select("user_id", "item_id", "rating", "authors_kept")


@register("index_categories", with_ctes("""SELECT authors_kept,
  CAST(row_number() OVER (ORDER BY count(*) DESC, authors_kept) - 1 AS DOUBLE) AS authors_kept_code
FROM collapsed GROUP BY authors_kept""", "enriched", extra=_TOPCAT))
def q_index_categories(spark, sf):
    from pyspark.ml.feature import StringIndexer
    c = collapsed(spark, sf)
    model = StringIndexer(inputCol="authors_kept", outputCol="authors_kept_code", handleInvalid="keep",
                          stringOrderType="frequencyDesc").fit(c)
    return model.transform(c.select("authors_kept").distinct())


_IMP_SQL = """med AS (SELECT quantile_disc(original_publication_year, 0.5) AS my,
                        quantile_disc(average_rating, 0.5) AS ma FROM enriched2),
imputed AS (SELECT e.*, coalesce(original_publication_year, my) AS original_publication_year_filled,
                   coalesce(average_rating, ma) AS average_rating_filled FROM enriched2 e, med)"""

_ENRICHED2 = """enriched2 AS (
  SELECT c.user_id, c.item_id, c.rating, s.item_rating_count, s.item_rating_mean, u.user_rating_count,
         u.user_rating_mean, i.authors, i.original_publication_year, i.average_rating
  FROM clean c LEFT JOIN istats s USING (item_id) LEFT JOIN ustats u USING (user_id) LEFT JOIN items i USING (item_id))"""


def imputed(spark, sf):
    e = enriched(spark, sf)
    out, _ = FE.impute_median(e, FE.feature_inputs(e)[0])
    return out


@register("impute_median", with_ctes("""SELECT user_id, item_id, rating, original_publication_year_filled,
  round(average_rating_filled, 6) AS average_rating_filled FROM imputed""", "istats", "ustats", "items",
                                     extra=",\n".join([_ENRICHED2, _IMP_SQL])))
def q_impute_median(spark, sf):
    i = imputed(spark, sf)
    return i.select("user_id", "item_id", "rating", "original_publication_year_filled",
                    r6("average_rating_filled").alias("average_rating_filled"))


# fixed values: the numeric columns of the enriched table
_NUMERIC = ("item_rating_count", "item_rating_mean", "user_rating_count", "user_rating_mean",
            "original_publication_year", "average_rating")
_SCALED = [c + "_filled" for c in _NUMERIC]


@register("scale_features", with_ctes("SELECT user_id, item_id, rating, " + ", ".join(
    f"round(CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE 0.0 END, 6) AS {c}_scaled" for c in _SCALED)
    + " FROM imputed, (SELECT " + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in _SCALED) + " FROM imputed) sd",
    "istats", "ustats", "items", extra=",\n".join([_ENRICHED2, _IMP_SQL.replace(
        "coalesce(average_rating, ma) AS average_rating_filled",
        "coalesce(average_rating, ma) AS average_rating_filled, item_rating_count AS item_rating_count_filled, "
        "item_rating_mean AS item_rating_mean_filled, user_rating_count AS user_rating_count_filled, "
        "user_rating_mean AS user_rating_mean_filled")])))
def q_scale_features(spark, sf):
    from pyspark.ml.feature import StandardScaler, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    i = imputed(spark, sf)
    va = VectorAssembler(inputCols=_SCALED, outputCol="v", handleInvalid="keep")
    sc = StandardScaler(inputCol="v", outputCol="s", withStd=True, withMean=False)
    a = va.transform(i)
    out = sc.fit(a).transform(a).withColumn("s", vector_to_array("s"))
    return out.select("user_id", "item_id", "rating",
                      *[r6(F.col("s")[j]).alias(c + "_scaled") for j, c in enumerate(_SCALED)])


def feature_table(spark, sf, n_top=TOP_N):
    return FE.build_features(enriched(spark, sf), n_top=n_top)


def with_default_categories(sql: str) -> str:
    """The text for the documented default of 200 categories."""
    return sql.replace("ASC NULLS FIRST LIMIT 10)", f"ASC NULLS FIRST LIMIT {DEFAULTS.top_categories})")


@register("one_hot", with_ctes("""SELECT c.user_id, c.item_id, c.rating, c.authors_kept, l.authors_kept_code,
  CAST(n.n_labels + 1 AS BIGINT) AS ohe_size, CAST(l.authors_kept_code + 1 AS BIGINT) AS ohe_hot_position
FROM collapsed c JOIN lab l USING (authors_kept), (SELECT count(*) AS n_labels FROM lab) n""", "enriched",
                              extra=_TOPCAT + """,
lab AS (SELECT authors_kept,
               CAST(row_number() OVER (ORDER BY count(*) DESC, authors_kept) - 1 AS DOUBLE) AS authors_kept_code
        FROM collapsed GROUP BY authors_kept)"""))
def q_one_hot(spark, sf):
    """One-hot with handleInvalid="keep": the vector has one slot more than
    there are labels (the invalid slot; the last slot is dropped)."""
    from pyspark.ml.functions import vector_to_array
    f = feature_table(spark, sf)
    arr = vector_to_array("authors_kept_slots")
    return f.select("user_id", "item_id", "rating", "authors_kept", "authors_kept_code",
                    F.size(arr).cast("bigint").alias("ohe_size"),
                    F.array_position(arr, 1.0).cast("bigint").alias("ohe_hot_position"))


_IMP_ALL_SQL = _IMP_SQL.replace(
    "coalesce(average_rating, ma) AS average_rating_filled",
    "coalesce(average_rating, ma) AS average_rating_filled, item_rating_count AS item_rating_count_filled, "
    "item_rating_mean AS item_rating_mean_filled, user_rating_count AS user_rating_count_filled, "
    "user_rating_mean AS user_rating_mean_filled")

# Feature rows in SQL: imputed numerics, collapsed category, one-hot slot.
_FEATURE_ROWS_SQL = ",\n".join([_ENRICHED2, _IMP_ALL_SQL, _TOPCAT, """fe AS (
  SELECT i.*, CASE WHEN i.authors IS NULL THEN 'unknown'
                   WHEN i.authors IN (SELECT authors FROM topcat) THEN i.authors ELSE 'other' END AS authors_kept
  FROM imputed i),
lab AS (SELECT authors_kept, count(*) AS cnt FROM fe GROUP BY authors_kept),
nlab AS (SELECT count(*) AS n_labels FROM lab),
sd AS (SELECT count(*) AS n, """ + ", ".join(f"stddev_samp({c}) AS s_{c}" for c in _SCALED) + """ FROM fe),
labsd AS (SELECT authors_kept, sqrt((cnt - cnt * cnt / n) / (n - 1)) AS s_lab FROM lab, sd)"""])

_NUM_SUM = " + ".join(_SCALED)
_SCALED_SUM = " + ".join(f"(CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE 0.0 END)" for c in _SCALED)


def _vector_summary(df, col):
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(col)
    return df.select("user_id", "item_id", "rating", F.size(arr).cast("bigint").alias("n_features"),
                     r6(F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)).alias("feature_sum"))


@register("assemble_features", with_ctes(f"""SELECT user_id, item_id, rating,
  CAST(6 + n_labels + 1 AS BIGINT) AS n_features, round({_NUM_SUM} + 1.0, 6) AS feature_sum
FROM fe, nlab""", "enriched", "istats", "ustats", "items", extra=_FEATURE_ROWS_SQL))
def q_assemble_features(spark, sf):
    """Assembled vector (numerics then one-hot): width and sum per row."""
    return _vector_summary(feature_table(spark, sf), "feature_slots")


_FEATURE_TABLE_SQL = with_ctes(f"""SELECT user_id, item_id, rating,
  CAST(6 + n_labels + 1 AS BIGINT) AS n_features,
  round({_SCALED_SUM} + (CASE WHEN s_lab > 0 THEN 1.0 / s_lab ELSE 0.0 END), 6) AS feature_sum
FROM fe JOIN labsd USING (authors_kept), sd, nlab""", "enriched", "istats", "ustats", "items", extra=_FEATURE_ROWS_SQL)


@register("feature_table", _FEATURE_TABLE_SQL)
def q_feature_table(spark, sf):
    """Scaled feature vector: width and sum per row (each slot divided by its
    sample standard deviation, 0 where that is 0)."""
    return _vector_summary(feature_table(spark, sf), "features")


@register("feature_table_default", with_default_categories(_FEATURE_TABLE_SQL))
def q_feature_table_default(spark, sf):
    return _vector_summary(feature_table(spark, sf, DEFAULTS.top_categories), "features")


SLOT_ROWS = 100_000  # feature rows whose slots a task groups


@register("feature_slots", with_ctes("""SELECT user_id, item_id, rating, CAST(slot AS BIGINT) AS slot, round(sum(value), 6) AS value FROM (
""" + "\nUNION ALL ".join(f"SELECT user_id, item_id, rating, {j} AS slot, CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE 0.0 END AS value FROM fe, sd"
                          for j, c in enumerate(_SCALED)) + f"""
UNION ALL SELECT user_id, item_id, rating, {len(_SCALED)} + l.nth, CASE WHEN s_lab > 0 THEN 1.0 / s_lab ELSE 0.0 END
FROM fe JOIN labsd USING (authors_kept) JOIN (SELECT authors_kept, row_number() OVER (ORDER BY cnt DESC, authors_kept) - 1 AS nth FROM lab) l USING (authors_kept)) x
WHERE value <> 0 GROUP BY user_id, item_id, rating, slot""", "enriched", "istats", "ustats", "items", extra=with_default_categories(_FEATURE_ROWS_SQL)))
def q_feature_slots(spark, sf):
    """Every slot of the scaled vector that is not zero, one row each, with the default 200 categories."""
    from pyspark.ml.functions import vector_to_array
    f = feature_table(spark, sf, DEFAULTS.top_categories)
    slots = f.select("user_id", "item_id", "rating", F.posexplode(vector_to_array("features")).alias("slot", "value")).filter("value <> 0")
    # as many tasks as the rows ask for: a task's groups are bounded, and no map task holds groups
    slots = slots.repartition(max(1, -(-f.count() // SLOT_ROWS)), "user_id", "item_id", "rating")
    return slots.groupBy("user_id", "item_id", "rating", F.col("slot").cast("bigint").alias("slot")).agg(r6(F.sum("value")).alias("value"))


@register("feature_table_roundtrip", _FEATURE_TABLE_SQL)
def q_feature_table_roundtrip(spark, sf):
    path = scratch_path(spark, "features") + ".parquet"
    sinks.write_table(feature_table(spark, sf).select("user_id", "item_id", "rating", "features"), path)
    return _vector_summary(spark.read.parquet(path), "features")


# ---------------------------------------------------------------- ALS

def als_model(spark, sf, params=None):
    train, test = split_once(spark, sf)
    return ALS.fit(train, params or ALS.AlsParams()), train, test


@register("als_predict")
def q_als_predict(spark, sf):
    model, _, test = als_model(spark, sf)
    return ALS.predict(model, test).select("user_id", "item_id", "rating", "prediction")


@register("als_recommend")
def q_als_recommend(spark, sf):
    model, train, test = als_model(spark, sf)
    return ALS.recommend(model, test.select("user_id").distinct(), DEFAULTS.top_k, seen=train)


@register("als_recs_nested")
def q_als_recs_nested(spark, sf):
    model, _, test = als_model(spark, sf)
    return nested_lists(spark, ALS.recommend(model, test.select("user_id").distinct(), DEFAULTS.top_k)).drop("scores")


def nested_lists(spark, lists):
    """Lists written in the nested form and read back."""
    path = scratch_path(spark, "als-recs") + ".parquet"
    sinks.write_lists(lists, path)
    back = spark.read.parquet(path)
    return back.select("user_id", F.size("items").cast("bigint").alias("n"), "items",
                       F.transform("recommendations", lambda r: r["score"]).alias("scores"))


@register("als_recs_nested_check", with_ctes("""SELECT user_id, least(10, n_items) AS n, least(10, n_items) AS n_distinct, true AS falling
FROM (SELECT DISTINCT user_id FROM test) u, (SELECT count(DISTINCT item_id) AS n_items FROM train) i
WHERE EXISTS (SELECT 1 FROM train t WHERE t.user_id = u.user_id)""", "test", "train"))
def q_als_recs_nested_check(spark, sf):
    """Nested lists with seen items: as long as asked, no item twice, scores falling."""
    model, _, test = als_model(spark, sf)
    n = nested_lists(spark, ALS.recommend(model, test.select("user_id").distinct(), DEFAULTS.top_k))
    falling = F.forall(F.sequence(F.lit(1), F.greatest(F.size("scores") - 1, F.lit(1))),
                       lambda i: F.coalesce(F.get("scores", i - 1) >= F.get("scores", i), F.lit(True)))
    return n.select("user_id", "n", F.size(F.array_distinct("items")).cast("bigint").alias("n_distinct"), falling.alias("falling"))


@register("als_save_load")
def q_als_save_load(spark, sf):
    model, _, test = als_model(spark, sf)
    path = scratch_path(spark, "als-model")
    ALS.save(model, path)
    return ALS.predict(ALS.load(path), test).select("user_id", "item_id", "rating", "prediction")


@register("als_cv_grid")
def q_als_cv_grid(spark, sf):
    """The full search with its errors: 8 settings x 3 folds and the refit."""
    train, _ = split_once(spark, sf)
    _, table = ALS.cross_validate(train, parallelism=2)
    return table


def grid_sql(ranks, regs, iters, folds: int) -> str:
    """Per setting the number of rows that all folds score: rows whose user and item another fold knows."""
    values = ", ".join(f"({r}, {g}, {i})" for r in ranks for g in regs for i in iters)
    return with_ctes(f"""SELECT g.rank, CAST(g.reg_param AS DOUBLE) AS reg_param, g.max_iter, n.n_scored, true AS finite FROM (VALUES {values}) g(rank, reg_param, max_iter), (
  SELECT count(*) AS n_scored FROM folded f
  WHERE EXISTS (SELECT 1 FROM folded o WHERE o.user_id = f.user_id AND o.fold <> f.fold)
    AND EXISTS (SELECT 1 FROM folded o WHERE o.item_id = f.item_id AND o.fold <> f.fold)) n""", "train", extra=f"""folded AS (
  SELECT user_id, item_id, CAST(('0x' || substr(md5(concat_ws('|', 'fold', user_id, item_id, 42)), 1, 8)) AS BIGINT) % {folds} AS fold FROM train)""")


@register("als_cv_grid_full", grid_sql(DEFAULTS.als_ranks, DEFAULTS.als_regs, DEFAULTS.als_iters, DEFAULTS.als_folds))
def q_als_cv_grid_full(spark, sf):
    """The full search: 8 settings x 3 folds and the refit."""
    from tastemap.plans.pipeline import prepare
    _, train, _ = prepare(FX.ratings(spark, sf))
    _, table = ALS.cross_validate(train)
    return table.select("rank", "reg_param", "max_iter", "n_scored", F.col("rmse").between(0.0, 10.0).alias("finite"))


@register("als_predict_check", with_ctes("""SELECT user_id, item_id, rating, true AS finite FROM test t
WHERE EXISTS (SELECT 1 FROM train r WHERE r.user_id = t.user_id) AND EXISTS (SELECT 1 FROM train r WHERE r.item_id = t.item_id)""",
                                                 "test", "train"))
def q_als_predict_check(spark, sf):
    """Which test pairs ALS predicts: those whose user and item it has seen."""
    model, _, test = als_model(spark, sf)
    return ALS.predict(model, test).select(
        "user_id", "item_id", "rating", (F.abs("prediction") < F.lit(1e6)).alias("finite"))


@register("als_recommend_check", with_ctes("""SELECT user_id, least(10, n_items - n_seen) AS n, CAST(0 AS BIGINT) AS seen_hits,
  true AS ranked, true AS scored
FROM (SELECT user_id, count(DISTINCT item_id) AS n_seen FROM train GROUP BY user_id) s JOIN (SELECT DISTINCT user_id FROM test) u
  USING (user_id), (SELECT count(DISTINCT item_id) AS n_items FROM train) i WHERE n_items > n_seen""", "test", "train"))
def q_als_recommend_check(spark, sf):
    """Per user: list length, seen items in it, ranks 1..n by falling score, score = dot product of the factors."""
    from tastemap.functions.exprs import dot
    model, train, test = als_model(spark, sf)
    recs = ALS.recommend(model, test.select("user_id").distinct(), DEFAULTS.top_k, seen=train)
    uf, vf = ALS.factor_tables(model)
    full = (recs.join(uf.withColumnRenamed("factor", "uf"), "user_id").join(vf.withColumnRenamed("factor", "vf"), "item_id")
            .join(train.select("user_id", "item_id", F.lit(1).alias("hit")).distinct(), ["user_id", "item_id"], "left"))
    rows = F.sort_array(F.collect_list(F.struct("rank", "score")))
    per = full.groupBy("user_id").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).cast("bigint").alias("seen_hits"), rows.alias("r"),
        F.max(F.abs(F.col("score") - dot("uf", "vf"))).alias("gap"))
    in_order = F.forall(F.sequence(F.lit(1), F.size("r")), lambda i: (F.get("r", i - 1)["rank"] == i)
                        & ((i == 1) | (F.get("r", i - 1)["score"] <= F.get("r", F.greatest(i - 2, F.lit(0)))["score"])))
    return per.select("user_id", "n", "seen_hits", in_order.alias("ranked"), (F.col("gap") < 1e-4).alias("scored"))


@register("als_save_load_check", with_ctes("""SELECT user_id, item_id, rating, true AS same FROM test t
WHERE EXISTS (SELECT 1 FROM train r WHERE r.user_id = t.user_id) AND EXISTS (SELECT 1 FROM train r WHERE r.item_id = t.item_id)""",
                                                   "test", "train"))
def q_als_save_load_check(spark, sf):
    """A saved and loaded model predicts what the model before it did."""
    model, _, test = als_model(spark, sf)
    path = scratch_path(spark, "als-model")
    ALS.save(model, path)
    after = ALS.predict(ALS.load(path), test).withColumnRenamed("prediction", "after")
    both = ALS.predict(model, test).join(after, ["user_id", "item_id", "rating"])
    return both.select("user_id", "item_id", "rating", (F.abs(F.col("prediction") - F.col("after")) < 1e-6).alias("same"))


# ---------------------------------------------------------------- SVD

def svd_model(spark, sf, use_sigma=True):
    from tastemap.plans.pipeline import prepare
    c, train, test = prepare(FX.ratings(spark, sf))
    users = R.dense_index(c, "user_id", "u_idx")
    items = R.dense_index(c, "item_id", "i_idx")
    res = SVD.svd_factors(R.dedup_pairs(train).select("user_id", "item_id", "rating"), users, items,
                          DEFAULTS.svd_k, use_sigma=use_sigma)
    return res, train, test


@register("svd_singular_values")
def q_svd_singular_values(spark, sf):
    res, _, _ = svd_model(spark, sf)
    return spark.createDataFrame([(i, v) for i, v in enumerate(res.singular_values)], "idx int, value double")


@register("svd_factors")
def q_svd_factors(spark, sf):
    from tastemap.functions.exprs import array_norm
    res, _, _ = svd_model(spark, sf)
    return res.item_factors.select("item_id", F.size("factor").cast("bigint").alias("dims"),
                                   r6(array_norm("factor")).alias("norm"))


@register("item_factors_roundtrip")
def q_item_factors_roundtrip(spark, sf):
    res, _, _ = svd_model(spark, sf)
    path = scratch_path(spark, "svd-factors") + ".parquet"
    sinks.write_item_factors(res.item_factors, path)
    return tables.scan_item_factors(spark, path)


@register("svd_recommend")
def q_svd_recommend(spark, sf):
    res, train, test = svd_model(spark, sf)
    return REC.factor_recommend(res.user_factors, res.item_factors, train, DEFAULTS.top_k,
                                users=test.select("user_id").distinct())



_SVD_K = f"""least({DEFAULTS.svd_k}, (SELECT count(DISTINCT user_id) FROM clean) - 1, (SELECT count(DISTINCT item_id) FROM clean) - 1)"""


@register("svd_singular_values_check", with_ctes(f"""SELECT i AS idx, true AS falling, true AS right_side, true AS left_side, true AS orthonormal
FROM (SELECT unnest(range(CAST({_SVD_K} AS BIGINT))) AS i) t""", "clean"))
def q_svd_singular_values_check(spark, sf):
    """Each triplet (s, u, v) against the rating rows by plain joins and sums: A v = s u, A.T u = s v, unit and
    orthogonal columns (two weighted sums of them have the length of the weights), values falling."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    res, train, _ = svd_model(spark, sf, use_sigma=False)
    entries = R.dedup_pairs(train).select("user_id", "item_id", "rating")
    s = F.array(*[F.lit(x) for x in res.singular_values])

    def gap(key, other, mine, theirs):
        scaled = F.transform("factor", lambda x: x * F.col("rating"))
        image = entries.join(theirs, other).groupBy(key).agg(Summarizer.sum(array_to_vector(scaled)).alias("image"))
        both = mine.join(image, key).select(F.zip_with(vector_to_array("image"), F.zip_with("factor", s, lambda a, b: a * b), lambda a, b: (a - b) * (a - b)).alias("d"))
        return both.agg(Summarizer.sum(array_to_vector("d")).alias("d")).select(F.posexplode(vector_to_array("d")).alias("idx", "gap"))

    def unit(t):
        weights = [[1.0 / (i + 1) for i in range(res.k)], [(-1.0) ** i for i in range(res.k)]]
        dots = [F.aggregate(F.zip_with("factor", F.array(*map(F.lit, w)), lambda a, b: a * b), F.lit(0.0), lambda x, y: x + y) for w in weights]
        ok = [F.abs(F.sum(d * d) - sum(x * x for x in w)) < 1e-5 for d, w in zip(dots, weights)]
        return t.agg((ok[0] & ok[1]).alias("ok")).first()["ok"]

    top = res.singular_values[0]
    right = gap("user_id", "item_id", res.user_factors, res.item_factors).select("idx", (F.sqrt("gap") < 1e-6 * top).alias("right_side"))
    left = gap("item_id", "user_id", res.item_factors, res.user_factors).select("idx", (F.sqrt("gap") < 1e-4 * top).alias("left_side"))
    ok = unit(res.user_factors) and unit(res.item_factors)
    falling = all(a >= b for a, b in zip(res.singular_values, res.singular_values[1:]))
    return right.join(left, "idx").select(F.col("idx").cast("bigint").alias("idx"), F.lit(falling).alias("falling"), "right_side", "left_side", F.lit(ok).alias("orthonormal"))


@register("item_factors_roundtrip_check", with_ctes(f"""SELECT i.item_id, CAST({_SVD_K} AS BIGINT) AS dims,
  NOT EXISTS (SELECT 1 FROM train t WHERE t.item_id = i.item_id) AS zero FROM (SELECT DISTINCT item_id FROM clean) i""", "clean", "train"))
def q_item_factors_roundtrip_check(spark, sf):
    """Written and read item factors: one row per item, of full width, zero just for items without a training rating."""
    from tastemap.functions.exprs import array_norm
    back = q_item_factors_roundtrip(spark, sf)
    return back.select("item_id", F.size("factor").cast("bigint").alias("dims"), (array_norm("factor") < 1e-12).alias("zero"))


@register("svd_recommend_check", with_ctes("""SELECT user_id, least(10, n_items - n_seen) AS n, CAST(0 AS BIGINT) AS seen_hits, true AS scored
FROM (SELECT user_id, count(DISTINCT item_id) AS n_seen FROM train GROUP BY user_id) s JOIN (SELECT DISTINCT user_id FROM test) u
  USING (user_id), (SELECT count(DISTINCT item_id) AS n_items FROM clean) i WHERE n_items > n_seen""", "test", "train", "clean"))
def q_svd_recommend_check(spark, sf):
    """Per user: list length, seen items in it, score = dot product of the factors."""
    from tastemap.functions.exprs import dot
    res, train, test = svd_model(spark, sf)
    recs = REC.factor_recommend(res.user_factors, res.item_factors, train, DEFAULTS.top_k, users=test.select("user_id").distinct())
    full = (recs.join(res.user_factors.withColumnRenamed("factor", "uf"), "user_id").join(res.item_factors.withColumnRenamed("factor", "vf"), "item_id")
            .join(train.select("user_id", "item_id", F.lit(1).alias("hit")).distinct(), ["user_id", "item_id"], "left"))
    per = full.groupBy("user_id").agg(F.count("*").alias("n"), F.coalesce(F.sum("hit"), F.lit(0)).cast("bigint").alias("seen_hits"),
                                      F.max(F.abs(F.col("score") - dot("uf", "vf"))).alias("gap"))
    return per.select("user_id", "n", "seen_hits", (F.col("gap") < 1e-6).alias("scored"))


# ---------------------------------------------------------------- end to end

@register("end_to_end_metrics")
def q_end_to_end_metrics(spark, sf):
    """ALS, SVD and item-kNN on the hold-out split, one metrics table."""
    from tastemap.plans import pipeline as PL
    res = PL.run(spark, FX.ratings(spark, sf), FX.items(spark, sf), PL.PipelineConfig())
    return res.metrics.select("model", "metric", r6("value").alias("value"), "status")


@register("end_to_end_check", """SELECT model, metric, 'ok' AS status, true AS sane FROM (
  SELECT unnest(['ALS', 'SVD', 'kNN']) AS model) m, (SELECT unnest(['precision_at_k', 'recall_at_k', 'ndcg_at_k', 'rmse', 'n_scored']) AS metric) n
WHERE model <> 'kNN' OR metric NOT IN ('rmse', 'n_scored')""")
def q_end_to_end_check(spark, sf):
    """The whole run with the feature table: which metrics it reports, each in its range, and recall = K x precision (one
    held-out row per user)."""
    from tastemap.plans import pipeline as PL
    m = PL.run(spark, FX.ratings(spark, sf), FX.items(spark, sf), PL.PipelineConfig(features=True)).metrics
    k = DEFAULTS.top_k
    by = m.groupBy("model").agg(*[F.max(F.when(F.col("metric") == f"{c}_at_k", F.col("value"))).alias(c) for c in ("precision", "recall")])
    sane = (F.when(F.col("metric") == "rmse", F.col("value").between(0.0, 4.0)).when(F.col("metric") == "n_scored", F.col("value") > 0)
            .otherwise(F.col("value").between(0.0, 1.0) & (F.abs(F.col("recall") - k * F.col("precision")) < 1e-9)))
    return m.join(by, "model").select("model", "metric", "status", sane.alias("sane"))


# ---------------------------------------------------------------- second ratings source

@register("interactions_profile", with_ctes("""SELECT count(*) AS n_pairs, count(DISTINCT user_id) AS n_users,
  count(DISTINCT item_id) AS n_items, round(avg(rating), 6) AS rating_mean, CAST(sum(n_ratings) AS BIGINT) AS n_ratings FROM (
  SELECT user_id, item_id, avg(rating) AS rating, count(*) AS n_ratings FROM (
    SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CASE event_type WHEN 'error' THEN 1.0 WHEN 'view' THEN 2.0 WHEN 'click' THEN 3.0
                           WHEN 'signup' THEN 4.0 WHEN 'purchase' THEN 5.0 END AS rating
    FROM events) e
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL
  GROUP BY user_id, item_id) p"""))
def q_interactions_profile(spark, sf):
    """events as ratings, de-duplicated per pair by the mean (dense, many repeats)."""
    pairs = R.clean_ratings(FX.interactions(spark, sf), dedup="pair")
    return pairs.agg(F.count(F.lit(1)).alias("n_pairs"), F.countDistinct("user_id").alias("n_users"),
                     F.countDistinct("item_id").alias("n_items"), r6(F.avg("rating")).alias("rating_mean"),
                     F.sum("n_ratings").alias("n_ratings"))


_IPAIRS = """ipairs AS (
  SELECT user_id, item_id, avg(rating) AS rating FROM (
    SELECT user_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CASE event_type WHEN 'error' THEN 1.0 WHEN 'view' THEN 2.0 WHEN 'click' THEN 3.0
                           WHEN 'signup' THEN 4.0 WHEN 'purchase' THEN 5.0 END AS rating
    FROM events) e
  WHERE user_id IS NOT NULL AND item_id IS NOT NULL AND rating IS NOT NULL
  GROUP BY user_id, item_id)"""


@register("interactions_holdout", with_ctes("""SELECT user_id, item_id, round(rating, 6) AS rating FROM (
  SELECT user_id, item_id, rating,
         row_number() OVER (PARTITION BY user_id
           ORDER BY md5(concat_ws('|', user_id, item_id, 42)), item_id, rating) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM ipairs) s WHERE n >= 2 AND rn = 1""", extra=_IPAIRS))
def q_interactions_holdout(spark, sf):
    """Leave-one-out on the events source after pair de-duplication (mean
    rating per user and item), the modelling input of the second source."""
    pairs = R.clean_ratings(FX.interactions(spark, sf), dedup="pair").select("user_id", "item_id", "rating")
    _, test = S.holdout_per_user(pairs)
    return test.select("user_id", "item_id", r6("rating").alias("rating"))


FLAGSHIP = "knn_recommend"
