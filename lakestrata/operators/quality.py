"""Data-quality reports, each one aggregate (one job) over the whole table.

The results are small DataFrames (one row, or one row per column) so callers can write
them, join them to a run log, or collect them; nothing is pulled to the driver here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from lakestrata.functions.expressions import null_like, quoted
from lakestrata.operators.relational import might_match


def _hashed(df: DataFrame) -> DataFrame:
    """Comparable columns (maps as their sorted entries) and two 64-bit hashes over them, ``__h1`` and ``__h2``."""
    plain = df.select(*[F.array_sort(F.map_entries(F.col(quoted(f.name)))).alias(f.name) if isinstance(f.dataType, MapType)
                        else F.col(quoted(f.name)) for f in df.schema.fields])
    names = [F.col(quoted(c)) for c in df.columns]
    return plain.withColumns({"__h1": F.xxhash64(F.lit(1), *names), "__h2": F.xxhash64(F.lit(2), *names)})


def integrity_check(df: DataFrame) -> DataFrame:
    """Exact-duplicate check whose shuffle carries a hash and a count for each row.

    Returns one row: ``n_rows``, ``n_distinct``, ``n_duplicates`` (= rows - distinct) and
    ``ok`` (no duplicates). Rows are counted by hash first; only rows whose hashes occur more than once
    are compared in full, so equal hashes of different rows don't count as duplicates. A bit map of those
    hashes keeps most other rows from being moved. Both aggregates combine map-side, so many copies of one
    row collapse before they move. ``df`` is read twice: pass a written table. Duplicates are reported, not removed.
    """
    rows = _hashed(df).drop("__h2")
    groups = rows.groupBy("__h1").agg(F.count(F.lit(1)).alias("__n"))
    many = groups.where("__n > 1").select("__h1")
    again = might_match(rows, "__h1", many, max_keys=None).join(many, "__h1")  # not a semi join, which would be done before the map
    repeated = again.groupBy("__h1", *[quoted(c) for c in df.columns]).agg(F.count(F.lit(1)).alias("__n"))
    both = (groups.agg(F.sum("__n").alias("n"), F.count_if(F.col("__n") == 1).alias("d"))
            .unionByName(repeated.agg(F.lit(0).cast("bigint").alias("n"), F.count(F.lit(1)).alias("d"))))
    return both.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.coalesce(F.sum("d"), F.lit(0)).cast("bigint").alias("n_distinct"),
    ).withColumn("n_duplicates", F.col("n_rows") - F.col("n_distinct")).withColumn("ok", F.col("n_duplicates") == 0)


def duplicate_files(df: DataFrame, file: str) -> DataFrame:
    """Files that hold a row more than once: ``file n_rows n_distinct n_duplicates``.

    Rows are compared within their own ``file`` (a column of ``df``); a row that two files hold once
    each is no duplicate, rows without a file are in none. As in ``integrity_check`` hashes are counted first, the file's hash standing
    for its name, and only rows with repeated hashes are compared in full.
    """
    body = [c for c in df.columns if c != file]
    rows = _hashed(df).withColumn("__f", F.xxhash64(F.col(quoted(file))))
    key = ["__f", "__h1", "__h2"]  # the hashes are over the file's name too
    groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    again = rows.join(groups.where("__n > 1").select(*key), key, "left_semi")
    repeated = again.groupBy(F.col(quoted(file)).alias("__file"), *[quoted(c) for c in body]).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    found = repeated.groupBy("__file").agg(F.sum(F.col("__n") - 1).alias("n_duplicates"))
    sizes = df.groupBy(F.col(quoted(file)).alias("__file")).agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.join(found, "__file").select(F.col("__file").alias("file"), "n_rows", (F.col("n_rows") - F.col("n_duplicates")).alias("n_distinct"), "n_duplicates")


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one ``bigint`` per column: how many values are null-like."""
    return df.agg(*[F.count_if(null_like(F.col(quoted(c)))).alias(c) for c in df.columns])


def null_profile(df: DataFrame, only_positive: bool = True) -> DataFrame:
    """Per column, the count of null-like values (null, '', text containing 'None' or
    'NULL'); one aggregate for all columns instead of one job per column.

    Rows: ``column_name string, n_null_like bigint``; by default only columns with a
    count above zero, as the reference reports.
    """
    wide = null_counts(df)
    names = df.columns
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', {quoted(c)}" for c in names)
    long = wide.selectExpr(f"stack({len(names)}, {stack}) AS (column_name, n_null_like)")
    return long.where("n_null_like > 0") if only_positive else long


def table_profile(df: DataFrame) -> DataFrame:
    """Row and column count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)))


def observe_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next (e.g. the write),
    so logging the row count costs no extra job."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("n_rows")), obs
