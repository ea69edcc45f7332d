"""tastemap: recommendation analytics on explicit ratings, written for Spark.

Every operator takes DataFrames and returns DataFrames. The work runs on
executors through the DataFrame, SQL and ML APIs; nothing unbounded is
collected on the driver.

Layout:
    sources/    scans, staging, sinks and the test-table fixtures
    functions/  column expressions (hashing, dot products, clipping, discounts)
    operators/  ratings, features, splits, ranking, scoring, ALS, SVD, kNN,
                metrics, profiles
    plans/      end-to-end pipeline and the registry of checked queries
    llm/        training-data operators (optional; nothing else imports them)
"""

from tastemap.config import Defaults

__all__ = ["Defaults"]
