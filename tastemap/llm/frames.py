"""Spark helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_package_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(), os.path.basename(_PACKAGE) + ".zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._package_shipped = True


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with this package available to the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (lineage ends here)."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc_mod(id_col: str, m: int):
    """crc32 of the id as text, modulo ``m`` (a null id counts as remainder 0)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % m, F.lit(0))


def components(edges: DataFrame) -> DataFrame:
    """(id, c): the smallest id of the connected component of every id in ``edges`` (a, b).

    Every id hooks to its smallest neighbour, the pointers are shortened by joins,
    and the edges are contracted to the new labels. At least every id that has a
    smaller neighbour disappears, so the rounds are logarithmic and each is a
    handful of shuffles of a shrinking edge table. Nothing reaches the driver
    but an is-empty flag.
    """
    cur = saved(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not cur.isEmpty():
        both = cur.union(cur.select("b", "a"))
        p = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
            "id", F.least("id", "m").alias("c"))
        for _ in range(2):
            q = p.select(F.col("id").alias("c"), F.col("c").alias("c2"))
            p = p.join(q, "c").select("id", F.col("c2").alias("c"))
        p = saved(p, "hooks")
        pa, pb = (p.select(F.col("id").alias(x), F.col("c").alias("c" + x)) for x in "ab")
        cur = saved(cur.join(pa, "a").join(pb, "b").filter("ca <> cb").select(
            F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "edges")
        if labels is None:
            labels = p
        else:
            q = p.select(F.col("id").alias("c"), F.col("c").alias("c2"))
            labels = labels.join(q, "c", "left").select("id", F.coalesce("c2", "c").alias("c"))
    if labels is None:
        return cur.select(F.col("a").alias("id"), F.col("b").alias("c"))
    return saved(labels, "labels")
