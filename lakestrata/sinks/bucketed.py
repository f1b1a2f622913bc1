"""Refined tables bucketed on a join key, so that a star's large join needs no exchange.

Rows of one key lie in one bucket, sorted. A key that holds too large a share of a table would make its
bucket one long task; such keys (and rows without a key) are kept beside the buckets, in plain files
that any number of tasks read, and meet their few partner rows by broadcast.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.functions.expressions import quoted
from lakestrata.session import staged


@dataclass(frozen=True)
class BucketedTable:
    """A catalog table of buckets, the folder of the rows beside them, and the keys of these."""

    name: str
    key: str
    n_buckets: int
    beside: str | None = None
    hot_keys: DataFrame | None = None

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows."""
        main = spark.table(self.name)
        return main.unionByName(spark.read.schema(main.schema).parquet(self.beside)) if self.beside else main


def write_bucketed(df: DataFrame, path: str, key: str, n_buckets: int = 64, hot_factor: float | None = 4.0, name: str | None = None) -> BucketedTable:
    """Write ``df`` under ``path`` in ``n_buckets`` buckets of ``key``, one sorted file each.

    With ``hot_factor`` keys with more rows than that many mean buckets, ``n_buckets / hot_factor`` of them at
    most, and null keys go to a folder beside. ``None`` (a table whose key is unique) buckets all rows.
    """
    name = name or f"bucketed_{uuid.uuid4().hex}"
    at = F.col(quoted(key))
    beside = hot = None
    main = df
    if hot_factor is not None:
        counts = df.where(at.isNotNull()).groupBy(at.alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
        counts = staged(counts, "key-counts")
        mean = (counts.agg(F.sum("__n")).first()[0] or 0) / n_buckets
        hot = staged(counts.where(F.col("__n") > F.lit(hot_factor * mean)).select("__key"), "hot-keys")
        main = df.where(at.isNotNull()).join(F.broadcast(hot), at == F.col("__key"), "left_anti")
        beside = f"{path.rstrip('/')}/beside"
        aside = df.where(at.isNull()).unionByName(df.join(F.broadcast(hot), at == F.col("__key"), "left_semi"))
        aside.write.mode("overwrite").parquet(beside)
    # the shuffle and the buckets use the same hash, so each task writes one bucket
    (main.repartition(n_buckets, at).write.mode("overwrite").format("parquet").bucketBy(n_buckets, key).sortBy(key)
         .option("path", f"{path.rstrip('/')}/buckets").saveAsTable(name))
    return BucketedTable(name, key, n_buckets, beside, hot)


def join_bucketed(spark: SparkSession, fact: BucketedTable, dim: BucketedTable, how: str = "left") -> DataFrame:
    """``fact`` joined to ``dim`` (unique key, bucketed alike) on their keys, without moving either's buckets."""
    if how not in ("left", "inner"):
        raise ValueError(f"join {how!r}: left or inner")
    if fact.n_buckets != dim.n_buckets:
        raise ValueError("both tables need the same number of buckets")
    if dim.beside is not None:
        raise ValueError("the dimension keeps all rows in its buckets (hot_factor=None)")
    d = spark.table(dim.name)
    on = lambda left, right: left[quoted(fact.key)] == right[quoted(dim.key)]
    main = spark.table(fact.name)
    out = main.join(d, on(main, d), how)
    if fact.beside is None:
        return out
    beside = spark.read.schema(main.schema).parquet(fact.beside)
    partners = d.join(F.broadcast(fact.hot_keys), d[quoted(dim.key)] == F.col("__key"), "left_semi")  # a row for each hot key
    return out.union(beside.join(F.broadcast(partners), on(beside, partners), how))
