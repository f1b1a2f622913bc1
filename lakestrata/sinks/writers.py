"""Sinks: Parquet/JSON/CSV/XML lake tables, Delta (when installed) and JDBC warehouse tables.

Writes go from the executors straight to the target path. ``mode="overwrite"`` replaces
the folder (Spark deletes, then writes; it refuses to overwrite a path the same plan
reads; ``committed.replace_committed`` switches versions instead). ``partition_overwrite=True`` replaces only the partitions present in the frame.
``max_records_per_file`` bounds file sizes without a repartition shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from lakestrata.operators.quality import observe_rows
from lakestrata.operators.transforms import add_audit_columns
from lakestrata.session import shuffles_freed
from lakestrata.sinks.committed import replace_committed


#: Codec of the Parquet files of the lake's layers.
LAYER_CODEC = "zstd"


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] | None,
            max_records_per_file: int | None, partition_overwrite: bool):
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if partition_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    return w


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: Sequence[str] | None = None,
                  max_records_per_file: int | None = None,
                  partition_overwrite: bool = False, compression: str | None = None) -> None:
    with shuffles_freed(df.sparkSession):
        _writer(df, mode, partition_by, max_records_per_file, partition_overwrite).parquet(path, compression=compression)


def write_json(df: DataFrame, path: str, mode: str = "overwrite",
               max_records_per_file: int | None = None, compression: str = "none") -> None:
    """JSON Lines part files (splittable on read, unlike one JSON array per file).

    Null fields are written, so a column without any value keeps its place. With ``compression`` a file is
    read by one task: give ``max_records_per_file`` too."""
    with shuffles_freed(df.sparkSession):
        (_writer(df, mode, None, max_records_per_file, False).option("ignoreNullFields", "false")
            .option("compression", compression).json(path))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = True) -> None:
    _writer(df, mode, None, None, False).option("header", str(header).lower()).csv(path)


def write_xml(df: DataFrame, path: str, row_tag: str, root_tag: str = "rows",
              mode: str = "overwrite", partition_by: Sequence[str] | None = None,
              max_records_per_file: int | None = None, compression: str = "none", open_files: int = 16) -> None:
    """XML part files, by folder of ``partition_by``. With ``compression`` a file is read by one task: give
    ``max_records_per_file`` too. A task keeps up to ``open_files`` folders' files open, so rows are only sorted
    by folder where it meets more."""
    writer = (_writer(df, mode, partition_by, max_records_per_file, False)
              .format("xml").option("rowTag", row_tag).option("rootTag", root_tag).option("compression", compression))
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(open_files))
    try:
        writer.save(path)
    finally:
        conf.set(key, before)


def write_delta(df: DataFrame, path: str, mode: str = "overwrite",
                merge_schema: bool = True) -> None:
    """Delta table write; needs the Delta package on the session's classpath."""
    try:
        _writer(df, mode, None, None, False).format("delta").option(
            "mergeSchema", str(merge_schema).lower()).save(path)
    except Exception as e:  # the data source class is resolved at save time
        if "delta" in str(e).lower() and ("not find" in str(e).lower()
                                          or "data source" in str(e).lower()):
            raise RuntimeError("Delta is not installed in this session; write Parquet "
                               "or add the Delta package") from e
        raise


def publish_refined(df: DataFrame, path: str, add_metadata: bool = True, load_ts=None,
                    max_records_per_file: int | None = None, committed: bool = False) -> int:
    """Write a refined table: audit columns (overwriting old ones), Parquet, replace.

    Returns the number of rows written, counted by the write itself (no extra job). With
    ``committed`` the table is replaced by a commit (see ``replace_committed``): a failed write leaves
    the old rows, and ``df`` may read the table itself; readers go through ``read_parquet``.
    """
    out = add_audit_columns(df, load_ts) if add_metadata else df
    if committed:
        return replace_committed(out, path, max_records_per_file)
    out, obs = observe_rows(out, "published_rows")
    write_parquet(out, path, "overwrite", max_records_per_file=max_records_per_file, compression=LAYER_CODEC)
    return int(obs.get.get("n_rows", 0))


# --- warehouse --------------------------------------------------------------------------

def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite",
               properties: Mapping[str, str] | None = None, truncate: bool = False,
               batch_size: int | None = None, num_partitions: int | None = None) -> None:
    """Write a frame to a warehouse table; each partition opens its own connection.

    ``num_partitions`` caps concurrent connections (Spark coalesces to it);
    ``truncate`` keeps the table definition on overwrite.
    """
    if mode not in ("overwrite", "append", "error", "errorifexists", "ignore"):
        raise ValueError(f"unknown write mode {mode!r}")
    w = df.write.mode(mode).format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        w = w.option(k, str(v))
    if truncate:
        w = w.option("truncate", "true")
    if batch_size:
        w = w.option("batchsize", str(batch_size))
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.save()


def qualify_table(table: str, schema: str, source_schema: str = "public") -> str:
    """``public.t`` -> ``{schema}.t``; an unqualified name gets ``schema``."""
    if table.startswith(f"{source_schema}."):
        return f"{schema}.{table[len(source_schema) + 1:]}"
    return table if "." in table else f"{schema}.{table}"


def historical_backfill(df: DataFrame, url: str, table: str, schema: str = "dw",
                        properties: Mapping[str, str] | None = None,
                        num_partitions: int | None = None) -> None:
    """One-time seed of a warehouse table from a dump read as a table, appended into
    ``schema`` (the dump's ``public.`` prefix is rewritten)."""
    write_jdbc(df, url, qualify_table(table, schema), "append", properties,
               num_partitions=num_partitions)
