"""File sources: Parquet snapshots, CSV, JSON, XML, and file listing/selection by layout.

Reads go straight to Hadoop-FS paths from the executors (no download to the driver).
Listings use the ``binaryFile`` source with only ``path``/``length``/``modificationTime``
selected, so file contents are never read, and the listing itself is a distributed job.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestrata.fixed import RAW_FILE_TYPES
from lakestrata.functions.expressions import file_extension
from lakestrata.sinks.committed import resolve
from lakestrata.sources.snapshots import newest_indexed_day


def _paths(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_parquet(spark: SparkSession, paths: str | Sequence[str], view: str | None = None,
                 merge_schema: bool = False) -> DataFrame:
    """Read a Parquet snapshot (schema from the files); optionally register a view.

    A table kept by commits is read in its current version."""
    found = [resolve(spark, p) for p in _paths(paths)]
    df = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(*found)
    if view:
        df.createOrReplaceTempView(view)
    return df


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
             header: bool = True, **options: str) -> DataFrame:
    """Read CSV with a header. With no ``schema`` the types are inferred (one extra pass
    over the data); give a declared schema for large inputs."""
    reader = spark.read.option("header", str(header).lower()).options(**options)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    return reader.csv(_paths(paths))


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str | None = None,
              multi_line: bool = False, **options: str) -> DataFrame:
    """Read JSON. ``multi_line=True`` reads whole-file JSON arrays (one task per file);
    the default JSON Lines form splits large files across tasks."""
    reader = spark.read.option("multiLine", str(multi_line).lower()).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(_paths(paths))


def read_xml(spark: SparkSession, paths: str | Sequence[str], row_tag: str,
             schema: StructType | str | None = None, infer_types: bool = False,
             **options: str) -> DataFrame:
    """Read repeated ``row_tag`` elements (found at any depth) as rows.

    Nested elements become structs. Attributes and name-space prefixes are ignored (as SOAP
    responses carry them), unless ``excludeAttribute`` / ``ignoreNamespace`` say otherwise. Leaf
    values stay text unless ``infer_types``; an empty element is null.
    """
    reader = (spark.read.format("xml").option("rowTag", row_tag)
              .option("nullValue", "").option("inferSchema", str(infer_types).lower())
              .option("excludeAttribute", "true").option("ignoreNamespace", "true")
              .options(**options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(_paths(paths))


# --- listing and selection --------------------------------------------------------------

def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """All files under ``root`` (recursive): ``path, length, modified``.

    Hidden files (``_SUCCESS``, ``.crc``) are skipped by Spark's file index.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    try:
        files = reader.load(root)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"no such folder: {root}") from e
        raise
    return files.select(
        "path", "length", F.col("modificationTime").alias("modified"))


def relative_path(path_col: str, root: str):
    """Path relative to ``root``, whatever scheme/authority the listing adds."""
    root_path = urlparse(root).path if "://" in root or root.startswith("file:") else root
    root_path = root_path.rstrip("/")
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/]*)?" + re.escape(root_path) + r"/(.*)$"
    return F.regexp_extract(F.col(path_col), pattern, 1)


def _glob_part(value: str | None) -> str:
    if value is None:
        return "*"
    if re.search(r"[*?\[\]{}\\]", value):
        raise ValueError(f"layout part {value!r} contains glob characters")
    return value


def layout_files(spark: SparkSession, raw_root: str, date: str | None = None,
                 business_area: str | None = None) -> DataFrame:
    """Files of a raw/standardized bucket split into layout parts.

    A dataset is ``{area}/{system}/{endpoint}/{yyyyMMdd}/{name}`` where ``name`` is a file
    or a folder of part files written by Spark; deeper files belong to their dataset.
    ``date`` / ``business_area`` narrow the listing itself with a path glob
    (``{root}/{area|*}/*/*/{date|*}``), so only that day's folders are listed, not the
    whole bucket's history. Columns: ``business_area, source_system, endpoint,
    date_extraction, file_name, file_type, dataset_path, path``.
    """
    if date is None and business_area is None:
        files = list_files(spark, raw_root)
    else:
        glob = f"{raw_root.rstrip('/')}/{_glob_part(business_area)}/*/*/{_glob_part(date)}"
        try:
            files = list_files(spark, glob)
        except FileNotFoundError:  # nothing landed for that day/area
            files = spark.createDataFrame([], "path string, length bigint, modified timestamp")
    parts = F.split(relative_path("path", raw_root), "/")
    name = F.element_at(parts, 5)
    root = raw_root.rstrip("/")
    return (files
            .where(F.size(parts) >= 5)
            .select(
                F.element_at(parts, 1).alias("business_area"),
                F.element_at(parts, 2).alias("source_system"),
                F.element_at(parts, 3).alias("endpoint"),
                F.element_at(parts, 4).alias("date_extraction"),
                name.alias("file_name"),
                F.lower(file_extension(name)).alias("file_type"),
                F.concat_ws("/", F.lit(root), F.slice(parts, 1, 5)).alias("dataset_path"),
                "path",
            ))


def select_raw_files(spark: SparkSession, raw_root: str, file_type: str, ingestion_date: str,
                     business_area: str | None = None) -> DataFrame:
    """Datasets of one ingestion date and file type (optionally one business area).

    The type must be the dataset name's extension (not any substring of the path). Raises
    ``ValueError`` for a type outside the allowed set and ``FileNotFoundError`` when
    nothing matches (checked with a one-row job).
    """
    file_type = file_type.lower()
    if file_type not in RAW_FILE_TYPES:
        raise ValueError(f"file type {file_type!r} not allowed; valid: {list(RAW_FILE_TYPES)}")
    files = layout_files(spark, raw_root, ingestion_date, business_area).where(
        (F.col("file_type") == file_type) & (F.col("date_extraction") == ingestion_date))
    if business_area:
        files = files.where(F.col("business_area") == business_area)
    if files.isEmpty():
        raise FileNotFoundError(
            f"no {file_type} files for {ingestion_date} under {raw_root}"
            + (f" in area {business_area}" if business_area else ""))
    return files


def snapshot_days(spark: SparkSession, table_root: str, ext: str = "parquet") -> DataFrame:
    """``d``: the ``yyyyMMdd`` folders of a table that hold ``{table}_{d}.{ext}``, by listing."""
    table = table_root.rstrip("/").rsplit("/", 1)[-1]
    try:  # only days that hold the table's own snapshot
        files = list_files(spark, f"{table_root.rstrip('/')}/*/{_glob_part(table)}_*.{ext}")
    except FileNotFoundError as e:
        raise FileNotFoundError(f"no dated snapshot under {table_root}") from e
    day = F.element_at(F.split(relative_path("path", table_root), "/"), 1)
    return files.select(day.alias("d")).where(F.col("d").rlike(r"^[0-9]{8}$")).distinct()


def latest_snapshot_date(spark: SparkSession, table_root: str, ext: str = "parquet") -> str:
    """Newest complete day of a table: from its snapshot index (one aggregate over a small table), or where it
    has none, the newest ``yyyyMMdd`` folder that holds ``{table}_{d}.{ext}`` (by listing)."""
    indexed = newest_indexed_day(spark, table_root, ext)
    if indexed is not None:
        return indexed
    newest = snapshot_days(spark, table_root, ext).agg(F.max("d").alias("d")).first()
    if newest is None or newest["d"] is None:
        raise FileNotFoundError(f"no dated snapshot under {table_root}")
    return newest["d"]


def raw_pattern(raw_root: str, file_type: str, date: str, business_area: str | None = None) -> str:
    """Path pattern of the datasets that ``select_raw_files`` selects, for one read of them all
    without their paths on the driver."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" for c in file_type)
    return f"{raw_root.rstrip('/')}/{_glob_part(business_area)}/*/*/{_glob_part(date)}/*.{letters}"


def latest_snapshot_path(spark: SparkSession, table_root: str, ext: str = "parquet") -> str:
    """Path of the newest snapshot: ``{table_root}/{d}/{table}_{d}.{ext}``."""
    d = latest_snapshot_date(spark, table_root, ext)
    table = table_root.rstrip("/").rsplit("/", 1)[-1]
    return f"{table_root.rstrip('/')}/{d}/{table}_{d}.{ext}"


def read_latest_snapshot(spark: SparkSession, table_root: str, ext: str = "parquet") -> DataFrame:
    """Read the newest dated snapshot of a table (Parquet, JSON or CSV)."""
    path = latest_snapshot_path(spark, table_root, ext)
    if ext == "parquet":
        return read_parquet(spark, path)
    if ext == "json":
        return read_json(spark, path)
    if ext == "csv":
        return read_csv(spark, path)
    raise ValueError(f"unsupported snapshot type {ext!r}")
