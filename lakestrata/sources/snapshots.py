"""Index of a table's complete daily snapshots.

After a day's snapshot is written, one row (day, type, rows) is appended to ``{table_root}/snapshot_index``.
The newest snapshot is one ``max`` over these rows: no part file of any day is listed, and a day
whose write hasn't ended isn't there. A table without an index is resolved by listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.sinks.committed import path_exists

INDEX = "day string, ext string, n_rows bigint"


def index_path(table_root: str) -> str:
    return f"{table_root.rstrip('/')}/snapshot_index"


def snapshot_index(spark: SparkSession, table_root: str) -> DataFrame | None:
    """The complete snapshots of a table (a day written again has several rows); ``None`` without an index."""
    path = index_path(table_root)
    return spark.read.schema(INDEX).json(path) if path_exists(spark, path) else None


def record_snapshot(spark: SparkSession, table_root: str, day: str, ext: str = "parquet", n_rows: int | None = None,
                    earlier: list[str] | None = None) -> None:
    """Note that the snapshot of ``day`` is whole. ``earlier`` are the days that were there before the
    table had an index; they are noted by the first call."""
    rows = [(day, ext, n_rows)]
    if earlier and snapshot_index(spark, table_root) is None:
        rows = [(d, ext, None) for d in earlier if d != day] + rows
    spark.createDataFrame(rows, INDEX).coalesce(1).write.mode("append").json(index_path(table_root))


def newest_indexed_day(spark: SparkSession, table_root: str, ext: str = "parquet") -> str | None:
    """Newest day in the index; ``None`` without an index (or without a day of this type)."""
    index = snapshot_index(spark, table_root)
    return None if index is None else index.where((F.col("ext") == ext) & F.col("day").rlike("^[0-9]{8}$")).agg(F.max("day")).first()[0]
