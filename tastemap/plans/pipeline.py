"""End-to-end run (section 3 of the survey, M11, M12).

clean -> (features) -> hold-out split -> ALS, SVD, item-kNN -> lists ->
metrics. Each model runs in its own ``try``: a failure or a skip becomes a
status row and the other models go on.

The cleaned and split ratings feed every model, so they are written once
to the checkpoint directory (lineage is cut, and a lost executor does not
force the de-duplication shuffle to run again); optionally as a table
bucketed by user, so per-user work downstream reads it without a shuffle.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastemap.config import DEFAULTS
from tastemap.operators import als as ALS
from tastemap.operators import features as FE
from tastemap.operators import metrics as M
from tastemap.operators import profile as PR
from tastemap.operators import ratings as R
from tastemap.operators import recommend as REC
from tastemap.operators import split as S
from tastemap.operators import svd as SVD
from tastemap.session import ensure_checkpoint_dir, scratch_path
from tastemap.sources import sinks

log = logging.getLogger(__name__)


@dataclass
class PipelineConfig:
    k: int = DEFAULTS.top_k
    split: str = "holdout"            # or "random"
    cross_validate: bool = False      # True: grid search (small=True for the reduced grid)
    small_grid: bool = False
    max_ratings: int | None = None    # repeatable cap on the ratings, as a run option
    min_rating: float | None = None   # kNN: only items rated at least this vote
    center: str | None = None         # SVD on ratings less the user's mean
    als: ALS.AlsParams = field(default_factory=ALS.AlsParams)
    svd_k: int = DEFAULTS.svd_k
    use_sigma: bool = True
    neighbors: int = DEFAULTS.knn_neighbors
    exclude_seen: bool = True
    clip: tuple | None = (DEFAULTS.rating_min, DEFAULTS.rating_max)
    models: tuple = ("ALS", "SVD", "kNN")
    output_uri: str | None = None     # metrics JSON, lists and factors under this URI
    features: bool = False            # also build and write the feature table
    bucket_split: bool = False        # write the split bucketed by user (large clusters)
    parallel_models: bool = True      # ALS and SVD/kNN as concurrent jobs


@dataclass
class PipelineResult:
    metrics: DataFrame
    lists: dict
    train: DataFrame
    test: DataFrame


def write_bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as an external table bucketed and sorted by ``key`` under
    the shared checkpoint directory, and read it back. Like a checkpoint it
    cuts the lineage and survives executor loss; unlike a checkpoint the
    read keeps the hash layout, so later aggregates and joins on ``key``
    (or on ``key`` plus more columns) need no shuffle."""
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"tastemap_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.bucketBy(buckets, key).sortBy(key)
     .option("path", scratch_path(spark, table)).saveAsTable(table))
    return spark.table(table)


def prepare(ratings_raw: DataFrame, split: str = "holdout", bucket: bool = False,
            buckets: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, train, test) from one flagged table written once.

    Default: a reliable checkpoint. ``bucket=True`` writes it bucketed by
    user instead, so the per-user steps downstream (seen counts, pair
    de-duplication, neighbour expansion, truth, metrics joins) read it
    without a shuffle. Measured at sf0.1 the bucketed write costs more than
    it saves (9.9 s against 2.4 s, and 16 small partitions), so it is for
    large clusters where shuffling the training table dominates."""
    clean = R.clean_ratings(ratings_raw)
    if split == "holdout":
        flagged = S.holdout_flagged(clean)
    elif split == "random":
        flagged = S.hash_split(clean).withColumn("is_test", ~F.col("is_train")).drop("is_train")
    else:
        raise ValueError("split must be holdout or random")
    flagged = (write_bucketed(flagged, "user_id", "split", buckets) if bucket
               else flagged.checkpoint(eager=True))
    base = ["user_id", "item_id", "rating"]
    return (flagged.select(*base), flagged.filter(~F.col("is_test")).select(*base),
            flagged.filter(F.col("is_test")).select(*base))


def run(spark: SparkSession, ratings_raw: DataFrame, items: DataFrame | None = None,
        cfg: PipelineConfig = PipelineConfig()) -> PipelineResult:
    ensure_checkpoint_dir(spark)
    if cfg.max_ratings is not None:
        ratings_raw = S.capped_rows(R.clean_ratings(ratings_raw), cfg.max_ratings)
    clean, train, test = prepare(ratings_raw, cfg.split, bucket=cfg.bucket_split)
    truth = M.truth_sets(test)
    users = test.select("user_id").distinct()
    parts: list[DataFrame] = []
    lists: dict = {}
    seen = train if cfg.exclude_seen else None

    if cfg.features:
        feats = FE.build_features(R.enrich_items(R.enrich_stats(clean), items))
        if cfg.output_uri:
            sinks.write_table(feats.select("user_id", "item_id", "rating", "features"),
                              f"{cfg.output_uri}/features.parquet")

    if cfg.output_uri:
        for name, profile in (("ratings", PR.rating_distribution), ("per_item", PR.hist_per_item), ("per_user", PR.hist_per_user)):
            sinks.write_table(profile(clean), f"{cfg.output_uri}/profiles/{name}.parquet")

    def done(lists_: dict, out: list, name: str, recs: DataFrame, rows: DataFrame) -> None:
        # the few metric rows are made here and the lists written here, so that a failure
        # in either stays with its model
        rows = rows.checkpoint(eager=True)
        if cfg.output_uri:
            sinks.write_lists(recs, f"{cfg.output_uri}/recommendations/{name.lower()}")
        lists_[name] = recs
        out.append(rows)

    def als_branch():
        out, lists_ = [], {}
        if "ALS" not in cfg.models:
            return out, lists_
        try:
            if cfg.cross_validate:
                fitted, _ = ALS.cross_validate_any_ids(train, cfg.small_grid)
            else:
                fitted = ALS.fit_any_ids(train, cfg.als)
            err = M.rmse(ALS.predict_any(fitted, test), clip_to=cfg.clip)
            recs = ALS.recommend_any(fitted, users, cfg.k, seen=seen).checkpoint(eager=True)
            done(lists_, out, "ALS", recs, M.metrics_long("ALS", M.ranking_metrics(recs, truth, cfg.k), err))
            if cfg.output_uri:
                ALS.save(fitted.model, f"{cfg.output_uri}/models/als")
        except Exception as exc:  # one model failing must not stop the others
            log.exception("ALS failed")
            out.append(M.status_row(spark, "ALS", "error", str(exc)))
        return out, lists_

    def svd_knn_branch():
        out, lists_ = [], {}
        item_factors = None
        if "SVD" in cfg.models or "kNN" in cfg.models:
            try:
                uidx = R.dense_index(clean, "user_id", "u_idx")
                iidx = R.dense_index(clean, "item_id", "i_idx")
                res = SVD.svd_factors(R.dedup_pairs(train).select("user_id", "item_id", "rating"), uidx, iidx,
                                      cfg.svd_k, use_sigma=cfg.use_sigma, center=cfg.center)
                if res.status != "ok":
                    out.append(M.status_row(spark, "SVD", "skipped", res.status))
                else:
                    item_factors = res.item_factors
                    if cfg.output_uri:
                        sinks.write_item_factors(item_factors, f"{cfg.output_uri}/svd_item_factors.parquet")
                    if "SVD" in cfg.models:
                        recs = REC.factor_recommend(res.user_factors, item_factors, seen, cfg.k,
                                                    users=users).checkpoint(eager=True)
                        pred = SVD.predict_with_factors(test, res.user_factors, item_factors, res.user_means)
                        err = M.rmse(pred, clip_to=cfg.clip)
                        done(lists_, out, "SVD", recs, M.metrics_long("SVD", M.ranking_metrics(recs, truth, cfg.k), err))
            except Exception as exc:
                log.exception("SVD failed")
                out.append(M.status_row(spark, "SVD", "error", str(exc)))
        if "kNN" in cfg.models:
            try:
                if item_factors is None:
                    out.append(M.status_row(spark, "kNN", "skipped", "no item factors"))
                else:
                    nb = REC.item_neighbors(item_factors, cfg.neighbors)
                    recs = REC.knn_recommend(REC.knn_votes(train, nb, cfg.min_rating), users, cfg.k).checkpoint(eager=True)
                    done(lists_, out, "kNN", recs, M.metrics_long("kNN", M.ranking_metrics(recs, truth, cfg.k, list_users=users)))
            except Exception as exc:
                log.exception("kNN failed")
                out.append(M.status_row(spark, "kNN", "error", str(exc)))
        return out, lists_

    # The two branches share only the written split. Run them as concurrent
    # Spark jobs from two driver threads: the iterative SVD solver submits
    # small sequential jobs and leaves most executor cores idle, which the
    # ALS fit can use.
    def in_pool(name, fn):
        # each branch's jobs go to their own scheduler pool; with
        # spark.scheduler.mode=FAIR the pools share executors evenly
        def run_branch():
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"tastemap-{name}")
            try:
                return fn()
            finally:
                spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return run_branch

    if cfg.parallel_models:
        with ThreadPoolExecutor(max_workers=2) as pool:
            futures = [pool.submit(in_pool("als", als_branch)), pool.submit(in_pool("svd", svd_knn_branch))]
            results = [f.result() for f in futures]
    else:
        results = [als_branch(), svd_knn_branch()]
    for out, lists_ in results:
        parts.extend(out)
        lists.update(lists_)

    if not parts:
        raise ValueError("no model selected: models must name ALS, SVD or kNN")
    metrics = parts[0]
    for p in parts[1:]:
        metrics = metrics.unionByName(p)
    if cfg.output_uri:
        sinks.write_metrics(metrics, f"{cfg.output_uri}/metrics")
        metrics = spark.read.schema(metrics.schema).json(f"{cfg.output_uri}/metrics")
        sinks.write_table(M.compare_models(metrics), f"{cfg.output_uri}/comparison.parquet")
    return PipelineResult(metrics, lists, train, test)
