"""Column transforms: rename, cast, drop, value maps, string cleaning, audit columns,
surrogate keys, schema conform, and the ordered chain that combines them.

Every function is ``DataFrame -> DataFrame`` and builds one projection, so Catalyst
collapses a whole chain into a single ``Project`` inside the scan's codegen stage.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from lakestrata.fixed import (
    AUDIT_LOAD_TS,
    AUDIT_TS_FORMAT,
    AUDIT_VALID_FROM,
    AUDIT_VALID_FROM_VALUE,
    AUDIT_VALID_TO,
    AUDIT_VALID_TO_VALUE,
    AUDIT_VERSION,
    AUDIT_VERSION_VALUE,
    NOT_INFORMED,
)
from lakestrata.functions.expressions import clean_string, map_values, quoted
from lakestrata.session import checkpoint_root, staged


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename ``old -> new``; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def cast_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = False) -> DataFrame:
    """Cast columns to named types. A value that does not convert becomes null
    (``try_cast``), which keeps the non-ANSI rule under ANSI mode; ``strict`` raises."""
    if not mapping:
        return df
    return df.withColumns({
        c: (F.col(quoted(c)).cast(t) if strict else F.col(quoted(c)).try_cast(t)) for c, t in mapping.items()
    })


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop columns; names that are absent are ignored."""
    cols = list(columns)
    return df.drop(*cols) if cols else df


def map_column_values(df: DataFrame, spec: Mapping[str, Mapping[Any, Any]]) -> DataFrame:
    """``{column: {old: new}}``; pairs apply one after another, so chains cascade."""
    if not spec:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: map_values(F.col(quoted(c)), pairs, types[c]) for c, pairs in spec.items()})


def clean_string_columns(df: DataFrame, columns: Iterable[str],
                         sentinel: str = NOT_INFORMED) -> DataFrame:
    """Trim, upper-case, empty/null -> ``sentinel``, for each column."""
    cols = list(columns)
    return df.withColumns({c: clean_string(F.col(quoted(c)), sentinel) for c in cols}) if cols else df


def add_audit_columns(df: DataFrame, load_ts: Any = None) -> DataFrame:
    """Add (or overwrite) the four audit columns.

    ``load_ts`` fixes the load time (a ``datetime``, text or Column); default is the query's
    ``current_timestamp()``, which is one constant per query.
    """
    if load_ts is None:
        load = F.current_timestamp()
    elif isinstance(load_ts, Column):
        load = load_ts.cast("timestamp")
    else:
        if isinstance(load_ts, _dt.datetime):
            load_ts = load_ts.strftime("%Y-%m-%d %H:%M:%S.%f")
        load = F.lit(str(load_ts)).cast("timestamp")
    return df.withColumns({
        AUDIT_LOAD_TS: load,
        AUDIT_VERSION: F.lit(AUDIT_VERSION_VALUE),
        AUDIT_VALID_FROM: F.to_timestamp(F.lit(AUDIT_VALID_FROM_VALUE), AUDIT_TS_FORMAT),
        AUDIT_VALID_TO: F.to_timestamp(F.lit(AUDIT_VALID_TO_VALUE), AUDIT_TS_FORMAT),
    })


def add_surrogate_key(df: DataFrame, name: str, order_by: Sequence[str | Column] = (),
                      num_partitions: int | None = None, materialize: bool = False) -> DataFrame:
    """Contiguous ``1..n`` key (bigint) without moving the table into one partition.

    With ``order_by`` the key follows that order; without it the key has no meaning but to be
    contiguous (as the reference's). Rows are put into ranges by splitters from a bounded sample,
    compared on the order and then on a hash of the whole row, so one order value holding a third of the
    rows is cut over several ranges. Rows are counted by range, and a row's key is the rows of the ranges before
    plus its place in its own. The range depends on the row alone, so a task that is run again
    gives the same keys and nothing is copied; ``df`` is read three times and must give the
    same rows each time. Rows that agree in all columns share a range.

    ``materialize`` checkpoints the rows instead (to the shared checkpoint folder) and numbers them by their
    partition and place there: for inputs that differ from run to run, columns of map type, descending
    orders, or masses of equal rows, which it cuts by their input position.
    """
    directed = any(re.search(r"\b(ASC|DESC)\b", str(c)) for c in order_by if isinstance(c, Column))
    if materialize or directed or any(isinstance(f.dataType, MapType) for f in df.schema.fields):
        return _key_by_position(df, name, order_by, num_partitions)
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order_by], F.xxhash64(*[F.col(quoted(c)) for c in df.columns]))
    sample = df.select(place.alias("__sk_at")).orderBy(F.rand(7)).limit(100 * n)
    # a bounded sample: one small task sorts it
    nth = sample.withColumn("i", F.row_number().over(Window.orderBy("__sk_at"))).where(F.col("i") % 100 == 0).agg(F.sort_array(F.collect_set("__sk_at")).alias("__sk_cuts"))
    cuts = F.broadcast(staged(nth, "splitters").withColumn("__sk_one", F.lit(1)))
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(max(1, n.bit_length())))])
    # binary search: how many splitters are at or below the row
    below = F.aggregate(steps, F.lit(0), lambda low, step: F.when((low + step <= F.size("__sk_cuts")) & (F.get("__sk_cuts", low + step - 1) <= F.col("__sk_at")), low + step).otherwise(low))
    ranged = df.withColumns({"__sk_at": place, "__sk_one": F.lit(1)}).join(cuts, "__sk_one").withColumn("__sk_pid", below).drop("__sk_cuts", "__sk_one")
    offsets = F.broadcast(staged(_offsets(ranged), "range-offsets"))
    here = Window.partitionBy("__sk_pid").orderBy("__sk_at")
    out = ranged.withColumn("__sk_pos", F.row_number().over(here)).join(offsets, "__sk_pid")
    return out.withColumn(name, (F.col("__sk_off") + F.col("__sk_pos")).cast("bigint")).drop("__sk_at", "__sk_pid", "__sk_pos", "__sk_off")


def _offsets(tagged: DataFrame) -> DataFrame:
    """Rows before each ``__sk_pid``: one row per partition or range, so the window is bounded by their number."""
    counts = tagged.groupBy("__sk_pid").agg(F.count(F.lit(1)).alias("__sk_n"))
    before = Window.orderBy("__sk_pid").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("__sk_pid", F.coalesce(F.sum("__sk_n").over(before), F.lit(0)).alias("__sk_off"))


def _key_by_position(df: DataFrame, name: str, order_by: Sequence[str | Column], num_partitions: int | None) -> DataFrame:
    """The key from each row's partition and position in a checkpointed copy."""
    spark = df.sparkSession
    if order_by:
        n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # The input position breaks ties, so one order value holding a third of the rows is
        # spread over several range partitions instead of landing in one task.
        tie = F.monotonically_increasing_id().alias("__sk_in")
        df = (df.select("*", tie)
                .repartitionByRange(n, *order_by, "__sk_in")
                .sortWithinPartitions(*order_by, "__sk_in")
                .drop("__sk_in"))
    checkpoint_root(spark)
    tagged = df.withColumn("__sk_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.withColumns({
        "__sk_pid": F.shiftright("__sk_mid", 33),
        "__sk_pos": F.col("__sk_mid").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    out = tagged.join(F.broadcast(_offsets(tagged)), "__sk_pid").withColumn(
        name, (F.col("__sk_off") + F.col("__sk_pos") + F.lit(1)).cast("bigint"))
    return out.drop("__sk_mid", "__sk_pid", "__sk_pos", "__sk_off")


def conform_to_schema(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Select exactly the declared fields, in order, cast to the declared types.

    Absent fields become typed nulls; fields not declared are dropped; a value that does not
    convert becomes null unless ``strict``.
    """
    present = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in present:
            c = F.col(quoted(f.name)).cast(f.dataType) if strict else F.col(quoted(f.name)).try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


@dataclass(frozen=True)
class ConformSpec:
    """The transform chain, applied in this fixed order:
    rename -> cast -> drop -> map values -> clean strings -> surrogate key.
    Later steps name columns by their new names."""

    rename: Mapping[str, str] = field(default_factory=dict)
    cast: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()
    map_values: Mapping[str, Mapping[Any, Any]] = field(default_factory=dict)
    clean_strings: Sequence[str] = ()
    surrogate_key: str = ""
    surrogate_order: Sequence[str] = ()
    sentinel: str = NOT_INFORMED


def conform(df: DataFrame, spec: ConformSpec) -> DataFrame:
    out = rename_columns(df, spec.rename)
    out = cast_columns(out, spec.cast)
    out = drop_columns(out, spec.drop)
    out = map_column_values(out, spec.map_values)
    out = clean_string_columns(out, spec.clean_strings, spec.sentinel)
    if spec.surrogate_key:
        out = add_surrogate_key(out, spec.surrogate_key, spec.surrogate_order)
    return out
