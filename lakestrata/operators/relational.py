"""Relational operators: semi/anti filters, unions, dedupe, latest-row-per-group, top-n,
SQL over named frames, and dimension joins with a checked broadcast.

Skew notes. Keyed dedupe and latest-per-group are written as a rank filter over a
window (``rank() == 1`` / ``row_number() == 1``): Spark's window-group-limit rule then
keeps only each map task's local winners *before* the shuffle, so a key that holds a
third of all rows sends a handful of rows per map task, not a third of the table, to
one reducer. Plans are checked in tests (``WindowGroupLimit`` appears on both sides of
the exchange).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestrata.functions.expressions import quoted
from lakestrata.session import staged


def _cols(xs: str | Column | Sequence[str | Column]) -> list[str | Column]:
    return [xs] if isinstance(xs, (str, Column)) else list(xs)


def _groupable(df: DataFrame) -> bool:
    """False when a column holds a map (maps cannot be grouping keys)."""
    from pyspark.sql.types import ArrayType, MapType, StructType

    def ok(t) -> bool:
        if isinstance(t, MapType):
            return False
        if isinstance(t, ArrayType):
            return ok(t.elementType)
        if isinstance(t, StructType):
            return all(ok(f.dataType) for f in t.fields)
        return True

    return all(ok(f.dataType) for f in df.schema.fields)


# --- filters by membership ---------------------------------------------------------------

def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys`` (``IN (SELECT ...)``), no fan-out."""
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, blocked: DataFrame, on: str | Sequence[str] | Column) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``blocked``; null keys are kept
    (``NOT EXISTS`` semantics, no ``NOT IN`` null trap)."""
    return df.join(blocked, on, "left_anti")


def exclude_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Drop rows whose ``column`` equals one of a short literal list; nulls are kept."""
    c = F.col(column)
    return df.where(c.isNull() | ~c.isin(list(values))) if values else df


# --- set operations ------------------------------------------------------------------------

def union_positional(*frames: DataFrame) -> DataFrame:
    """Append frames by column position; duplicates are kept (``UNION ALL``)."""
    return reduce(DataFrame.union, frames)


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Append frames by column name; a column missing from a frame is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct over all columns (partial aggregation collapses copies map-side).

    Top-level map columns, which cannot be grouping keys, are compared by their sorted
    entries and one of the equal maps is kept."""
    if _groupable(df):
        return df.dropDuplicates()
    from pyspark.sql.types import MapType

    maps = [f.name for f in df.schema.fields if isinstance(f.dataType, MapType)]
    keys = [F.array_sort(F.map_entries(F.col(quoted(c)))).alias(f"__k{i}") if c in maps
            else F.col(quoted(c)) for i, c in enumerate(df.columns)]
    out = df.groupBy(*keys).agg(*[F.first(F.col(quoted(c))).alias(f"__m{c}") for c in maps])
    return out.select(*[F.col(quoted(f"__m{c}")).alias(c) if c in maps else F.col(quoted(c))
                        for c in df.columns])


# --- one row per key -----------------------------------------------------------------------

def dedupe_keep_first(df: DataFrame, key: str | Sequence[str],
                      order_by: str | Column | Sequence[str | Column], ties: bool = True) -> DataFrame:
    """One row per key, the first in ``order_by`` (e.g. file, then position in file).

    Null keys form one group, like pandas ``drop_duplicates``. When ``order_by`` ties, a
    hash of the row's content decides, so a re-run task keeps the same row. ``ties=False`` says that no two
    rows tie (each has its own place in its file): then no hash moves with the rows.
    """
    order = _cols(order_by)
    if ties and _groupable(df):
        order = order + [F.xxhash64(*[F.col(quoted(c)) for c in df.columns])]
    w = Window.partitionBy(*_cols(key)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def latest_per_group(df: DataFrame, keys: str | Sequence[str], ts: str | Column,
                     keep_ties: bool = True, salts: int = 16, materialize: bool = False) -> DataFrame:
    """Rows at the latest ``ts`` of each group; with ``keep_ties`` every tied row stays.

    Rows with a null key or null time are dropped first: they can never equal a group's
    maximum, exactly as in the max-then-join-back form.

    Rows are ranked within (keys, salt) first; the map-side group limit lets each map task send
    only its own winners, and ``salts`` tasks share a hot key. The survivors are written once (the input is
    read once); their maximum per key then joins back on (keys, time), a join that AQE can split, so masses of rows tied at one key's
    maximum, copies or distinct, never meet in one task. ``salts=1`` ranks in one step.
    ``materialize`` writes the survivors once, so the input is read and ranked once, not twice.
    """
    keys = _cols(keys)
    ts_col = F.col(ts) if isinstance(ts, str) else ts
    not_null = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys], ts_col.isNotNull())
    rank_fn = F.rank() if keep_ties else F.row_number()
    w = Window.partitionBy(*keys).orderBy(ts_col.desc())
    rows = df.where(not_null)
    if salts > 1:
        # local winners by (keys, salt): only they are shuffled, and a hot key over many tasks
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("__salt")
        local = Window.partitionBy(*keys, "__salt").orderBy(ts_col.desc())
        rows = rows.select("*", salt).withColumn("__rk", rank_fn.over(local)).where("__rk = 1").drop("__rk", "__salt")
        if keep_ties:
            rows = staged(rows, "local-winners") if materialize else rows
            maxes = rows.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.max(ts_col).alias("__max"))
            same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__k{i}") for i, k in enumerate(keys)], ts_col == F.col("__max"))
            return rows.join(maxes, same).select(*[F.col(quoted(c)) for c in df.columns])
    return rows.withColumn("__rk", rank_fn.over(w)).where("__rk = 1").drop("__rk")


def latest_per_group_join_back(df: DataFrame, keys: str | Sequence[str], ts: str) -> DataFrame:
    """Same rows as ``latest_per_group`` written as max-per-group joined back on
    (keys, ts). Kept to compare plans; it scans and shuffles the input twice."""
    keys = list(_cols(keys))
    maxes = df.groupBy(*keys).agg(F.max(ts).alias("__max_ts"))
    cond = [df[k] == maxes[k] for k in keys] + [df[ts] == maxes["__max_ts"]]
    return df.join(maxes, cond, "inner").select(df["*"])


def max_by_group(df: DataFrame, keys: str | Sequence[str], ts: str | Column,
                 alias: str = "max_ts") -> DataFrame:
    """``MAX(ts)`` per group (partial aggregation before the shuffle)."""
    return df.groupBy(*_cols(keys)).agg(F.max(ts).alias(alias))


def count_by(df: DataFrame, keys: str | Sequence[str], alias: str = "cnt") -> DataFrame:
    """``COUNT(*)`` per group."""
    return df.groupBy(*_cols(keys)).agg(F.count(F.lit(1)).alias(alias))


#: Copies a row stands for in a sorted ``replicate_rows``.
SORTED_CHUNK = 64


def replicate_rows(df: DataFrame, count_col: str, chunk: int = 1 << 20,
                   spread_by: Sequence[str | Column] | None = None,
                   sort_by: Sequence[Column] | None = None, row_id: str | None = None) -> DataFrame:
    """Turn each row into ``count_col`` copies (the inverse of counting copies).

    Rows with at most ``chunk`` copies (the usual case) are expanded where they are, with
    no shuffle. A larger count is split into chunks of at most ``chunk`` rows, so no
    array larger than ``chunk`` elements is built, and the chunk rows are hash-partitioned
    on (``spread_by``, chunk) before they are expanded, so the copies of one hot row are
    made by many tasks. With ``sort_by`` every row goes through one range shuffle on
    (``sort_by``, chunk) and is sorted inside its partition before it is expanded, which yields the global
    order in that single shuffle and holds no copies; chunks are small there, so that ranges of
    like many chunks make like many rows. ``row_id`` numbers the copies ``0..n-1``. The number of shuffle
    partitions is kept (AQE would size them by the rows before they are expanded).
    """
    n = F.col(count_col).cast("bigint")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunk = min(chunk, SORTED_CHUNK) if sort_by else chunk
    k = F.ceil(n / F.lit(chunk)).cast("bigint")
    sizes = F.transform(F.sequence(F.lit(0).cast("bigint"), k - 1),
                        lambda i: F.struct(i.alias("i"), F.least(F.lit(chunk).cast("bigint"), n - i * chunk).alias("size")))
    def expand(chunks: DataFrame) -> DataFrame:
        pos = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__chunk.size") - 1)).alias("__pos")
        return (chunks.select("*", pos)
                      .withColumn("__rid", F.col("__chunk.i") * chunk + F.col("__pos"))
                      .drop("__chunk", "__pos"))

    if sort_by:
        chunks = df.where(n > 0).withColumn("__chunk", F.explode(sizes))
        chunks = chunks.repartitionByRange(parts, *sort_by, F.col("__chunk.i"))
        out = expand(chunks.sortWithinPartitions(*sort_by, F.col("__chunk.i")))
    else:
        small = df.where((n > 0) & (n <= chunk)).withColumn(
            "__rid", F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)))
        big = df.where(n > chunk).withColumn("__chunk", F.explode(sizes))
        big = expand(big.repartition(parts, *(spread_by or []), F.col("__chunk.i")))
        out = small.unionByName(big)
    return out.withColumnRenamed("__rid", row_id) if row_id else out.drop("__rid")


# --- ordering ------------------------------------------------------------------------------

def preview_topn(df: DataFrame, n: int, order_by: str | Column | Sequence[str | Column]) -> DataFrame:
    """First ``n`` rows in a total order (top-k per partition, then a merge of k-row lists)."""
    return df.orderBy(*_cols(order_by)).limit(n)


# --- dimension joins ----------------------------------------------------------------------

def broadcast_if_bounded(dim: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``dim`` for broadcast only when a bounded job proves it has at most
    ``max_rows`` rows; otherwise leave it to the planner (sort-merge join, AQE may still
    switch to broadcast from runtime sizes)."""
    fits = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if fits else dim


def join_dimension(fact: DataFrame, dim: DataFrame, on: str | Sequence[str] | Column,
                   how: str = "left", max_broadcast_rows: int | None = None) -> DataFrame:
    """Join a fact to a dimension; broadcast the dimension only behind a size check."""
    if max_broadcast_rows is not None:
        dim = broadcast_if_bounded(dim, max_broadcast_rows)
    return fact.join(dim, on, how)


def might_match(df: DataFrame, column: str, keys: DataFrame, bits: int = 24, max_keys: int | None = 1 << 22) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be among ``keys`` (its first column): a bit map of key hashes
    below a shuffle that the exact join follows.

    Rows with a null key go, every row with a wanted key stays, and others pass by chance (a share of
    keys / 2**bits). The map is a table of 64-bit words, ``2**(bits - 6)`` at most (4 MB), joined by
    broadcast whatever the number of keys. More than ``max_keys`` keys (counted by a bounded job) would fill it:
    then ``df`` comes back as it is, and also where the two types differ. ``max_keys=None`` doesn't count, and
    runs no job.
    """
    name = keys.columns[0]
    if df.schema[column].dataType != keys.schema[name].dataType:
        return df
    if max_keys is not None and keys.limit(max_keys + 1).count() > max_keys:
        return df
    place = lambda c: F.xxhash64(c).bitwiseAND(F.lit((1 << bits) - 1))  # noqa: E731 - never null, so no filter on it keeps plans of the keys apart
    words = (keys.where(F.col(quoted(name)).isNotNull()).select(place(F.col(quoted(name))).alias("__p"))
             .groupBy(F.shiftright("__p", 6).alias("__word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__p & 63 AS int))")).alias("__mask")))
    probed = df.where(F.col(quoted(column)).isNotNull()).withColumn("__p", place(F.col(quoted(column)))).withColumn("__word", F.shiftright("__p", 6))
    hit = F.expr("(shiftrightunsigned(__mask, cast(__p & 63 AS int)) & 1L) = 1L")
    return probed.join(F.broadcast(words), "__word").where(hit).drop("__p", "__word", "__mask")


# --- SQL over named frames -----------------------------------------------------------------

def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Register frames as temp views under their names."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def sql_over_frames(spark: SparkSession, query: str, args: Mapping[str, Any] | None = None,
                    **frames: DataFrame) -> DataFrame:
    """Run SQL that names frames as ``{name}`` and values as ``:param``.

    Frames are bound by reference (no global temp-view state), values as typed
    parameters (no string formatting of literals into the text).
    """
    return spark.sql(query, args=dict(args) if args else None, **frames)
