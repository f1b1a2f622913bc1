"""Layer-to-layer pipelines: ingest landed responses, standardize raw snapshots, refine
dimensions and facts, publish to the warehouse.

Each pipeline is a handful of distributed jobs on the caller's session. The only values
that reach the driver are metadata bounded by the number of tables (which tables a run
touches, their status), never table rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestrata import fixed
from lakestrata.functions.expressions import quoted
from lakestrata.operators.quality import duplicate_files, integrity_check
from lakestrata.operators.relational import dedupe_keep_first, exclude_values
from lakestrata.operators.transforms import ConformSpec, add_audit_columns, conform
from lakestrata.plans.facts import (
    DEFAULT_SPEC,
    StarSpec,
    by_type_from_detail,
    by_unit_from_detail,
    stalled_cases_from_detail,
    stalled_detail,
)
from lakestrata.session import checkpoint_root, copies_removed, shuffles_freed, staged
from lakestrata.sinks.committed import path_exists
from lakestrata.sinks.writers import LAYER_CODEC, publish_refined, write_delta, write_jdbc, write_json, write_parquet
from lakestrata.sources.files import (
    read_latest_snapshot,
    read_parquet,
    read_xml,
    relative_path,
    select_raw_files,
    snapshot_days,
)
from lakestrata.sources.layout import LakeLayout, date_key
from lakestrata.sources.raw_files import read_raw_csv, read_raw_json
from lakestrata.sources.snapshots import record_snapshot, snapshot_index
from lakestrata.sources.split_xml import CORRUPT, SOURCE_FILE, SOURCE_POS, read_xml_split


# --- extract: landed XML responses -> raw JSON -----------------------------------------------

def lift_nested_ids(df: DataFrame, children: Mapping[str, str] = fixed.NESTED_ID_CHILDREN) -> DataFrame:
    """Replace each nested element by the text of its id child (null when absent)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    lifted: dict[str, Column] = {}
    for element, child in children.items():
        if element not in types:
            continue
        dtype = types[element]
        if isinstance(dtype, StructType) and child in dtype.fieldNames():
            lifted[element] = F.col(quoted(element, child)).cast("string")
        else:
            lifted[element] = F.lit(None).cast("string")
    return df.withColumns(lifted) if lifted else df


def read_responses(spark: SparkSession, paths: str | Sequence[str], row_tag: str,
                   schema: StructType | None = None,
                   request_key: tuple[str, str] | None = None,
                   split: bool = True, corrupt: Observation | None = None) -> DataFrame:
    """Landed response files -> rows of ``row_tag`` with their origin.

    ``request_key=(column, regex)`` adds the request key taken from each file's path (group
    1 of ``regex``), as the extractor added the key it asked for. Every row carries its
    file and position, which define "first" for keyed dedupe. Files are split over tasks
    (``split=False``: one task per file, for other encodings or prefixed row tags). An element that
    is cut off or malformed fails the job, unless ``corrupt`` is given: then such elements are left
    out and the observation's ``n_corrupt`` counts them.
    """
    if split:
        df = read_xml_split(spark, paths, row_tag, schema)
        if corrupt is not None:
            df = df.observe(corrupt, F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt")).where(F.col(CORRUPT).isNull())
        else:
            message = F.concat(F.lit("cannot parse an element of "), F.col(SOURCE_FILE), F.lit(": "), F.left(F.col(CORRUPT), F.lit(200)))
            df = df.where(F.when(F.col(CORRUPT).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
        df = df.drop(CORRUPT)
    else:
        df = read_xml(spark, paths, row_tag, schema=schema)
        df = df.withColumns({
            SOURCE_FILE: F.col("_metadata.file_path"),
            SOURCE_POS: F.monotonically_increasing_id(),
        })
    if request_key:
        column, regex = request_key
        # the file path is URI-encoded (a plus sign stands for itself)
        key = F.regexp_replace(F.regexp_extract(F.col(SOURCE_FILE), regex, 1), r"\+", "%2B")
        df = df.withColumn(column, F.try_url_decode(key))
    return df


def restrict_requests(df: DataFrame, column: str, wanted: DataFrame | None = None,
                      blocked: Sequence[Any] = ()) -> DataFrame:
    """Keep responses whose request key is in the driving key list (a DataFrame, e.g. a
    warehouse query, joined as a semi join, never collected) and not in ``blocked``."""
    if wanted is not None:
        # written once: the planner knows its size, and a short list is broadcast, so that a request with many rows isn't one task's
        keys = staged(wanted.select(F.col(wanted.columns[0]).alias("__req")).where("__req IS NOT NULL").distinct(), "request-keys")
        df = df.join(keys, F.col(column) == F.col("__req"), "left_semi")
    return exclude_values(df, column, list(blocked)) if blocked else df


def ingest_responses(spark: SparkSession, paths: str | Sequence[str], row_tag: str, key: str | None,
                     request_key: tuple[str, str] | None = None,
                     children: Mapping[str, str] = fixed.NESTED_ID_CHILDREN,
                     schema: StructType | None = None, keep_origin: bool = False,
                     wanted: DataFrame | None = None, blocked: Sequence[Any] = ()) -> DataFrame:
    """Responses -> flat rows, nested ids lifted, one row per ``key`` (first seen wins);
    ``key=None`` keeps every row (an endpoint without a key). With ``request_key``,
    ``wanted``/``blocked`` restrict the requests as the extractor's key list did."""
    df = lift_nested_ids(read_responses(spark, paths, row_tag, schema, request_key), children)
    if request_key and (wanted is not None or blocked):
        df = restrict_requests(df, request_key[0], wanted, blocked)
    out = dedupe_keep_first(df, key, [SOURCE_FILE, SOURCE_POS], ties=False) if key else df
    return out if keep_origin else out.drop(SOURCE_FILE, SOURCE_POS)


def entity_from_responses(responses: DataFrame, element: str, key: str | None = None) -> DataFrame:
    """Project a nested element of parsed responses out as its own table, one row per key
    (default key ``Id{element}``, first seen wins)."""
    key = key or f"Id{element}"
    ent = responses.select(f"{quoted(element)}.*", SOURCE_FILE, SOURCE_POS)
    return dedupe_keep_first(ent, key, [SOURCE_FILE, SOURCE_POS], ties=False).drop(SOURCE_FILE, SOURCE_POS)


def nested_entity(spark: SparkSession, paths: str | Sequence[str], row_tag: str, element: str,
                  key: str | None = None, schema: StructType | None = None) -> DataFrame:
    """Read responses and project one nested element out as its own table."""
    return entity_from_responses(read_responses(spark, paths, row_tag, schema), element, key)


def extract_responses(spark: SparkSession, paths: str | Sequence[str], row_tag: str, key: str | None,
                      entities: Mapping[str, str | None] | None = None,
                      request_key: tuple[str, str] | None = None,
                      children: Mapping[str, str] = fixed.NESTED_ID_CHILDREN,
                      schema: StructType | None = None) -> dict[str, DataFrame]:
    """Parse the responses once and derive the main table and the nested entity tables.

    When entity tables are asked for, the parsed rows are written once as Parquet to the shared
    checkpoint folder (XML parsing is the costly step) and ``"rows"`` (nested ids lifted, one row per ``key``) and one table per
    ``entities`` element (``{element: key or None}``) are projections of that one copy.
    """
    parsed = read_responses(spark, paths, row_tag, schema, request_key)
    if entities:
        parsed = staged(parsed, "responses", "zstd")
    rows = lift_nested_ids(parsed, children)
    rows = dedupe_keep_first(rows, key, [SOURCE_FILE, SOURCE_POS], ties=False) if key else rows
    out = {"rows": rows.drop(SOURCE_FILE, SOURCE_POS)}
    for element, ent_key in (entities or {}).items():
        out[element] = entity_from_responses(parsed, element, ent_key)
    return out


def land_raw(df: DataFrame, layout: LakeLayout, area: str, endpoint: str, day: Any = None,
             system: str = fixed.RAW_CONTEXT, max_records_per_file: int | None = None, compression: str = "none") -> str:
    """Write extracted rows as the raw JSON snapshot of ``day``; returns its path."""
    path = layout.raw(area, endpoint, day, "json", system)
    write_json(df, path, max_records_per_file=max_records_per_file, compression=compression)
    return path


# --- standardize: raw -> standardized -------------------------------------------------------

STATUS_SCHEMA = ("business_area string, source_system string, endpoint string, "
                 "date_extraction string, raw_path string, standardized_path string, "
                 "n_rows bigint, n_duplicates bigint, n_corrupt bigint, ok boolean, error string")


def _days_without_index(spark: SparkSession, table_root: str, ext: str) -> list[str]:
    """Days of a table that has no snapshot index yet (a name for each day)."""
    if snapshot_index(spark, table_root) is not None or not path_exists(spark, table_root):
        return []
    try:
        return [r.d for r in snapshot_days(spark, table_root, ext).collect()]
    except FileNotFoundError:
        return []


def _duplicates_by_file(raw: DataFrame, layout: LakeLayout) -> DataFrame:
    """``duplicate_files`` of raw rows; the part files of a dataset that Spark wrote are one file."""
    parts = F.split(relative_path(SOURCE_FILE, layout.raw_root), "/")
    return duplicate_files(raw.drop(CORRUPT).withColumn(SOURCE_FILE, F.array_join(F.slice(parts, 1, 5), "/")), SOURCE_FILE)


def duplicate_raw_files(spark: SparkSession, layout: LakeLayout, file_type: str, ingestion_date: Any,
                        business_area: str | None = None, schemas: Mapping[str, StructType] | None = None,
                        json_array: bool | None = None) -> DataFrame:
    """Raw files of one day and type that hold a row more than once.

    ``business_area source_system endpoint file n_rows n_distinct n_duplicates``, one row per offending file
    (its path below the raw bucket); rows are compared within their file. Stays a DataFrame.
    """
    day = date_key(ingestion_date)
    files = select_raw_files(spark, layout.raw_root, file_type, day, business_area)
    out = None
    for t in files.select("business_area", "source_system", "endpoint").distinct().orderBy("business_area", "source_system", "endpoint").collect():  # tables of the day
        raw = _raw_pattern(layout, t.business_area, t.source_system, t.endpoint, day, file_type)
        schema = (schemas or {}).get(t.endpoint)
        df = read_raw_csv(spark, raw, schema) if file_type == "csv" else read_raw_json(spark, raw, schema, json_array)
        found = _duplicates_by_file(df, layout).select(F.lit(t.business_area).alias("business_area"), F.lit(t.source_system).alias("source_system"),
                                                       F.lit(t.endpoint).alias("endpoint"), "file", "n_rows", "n_distinct", "n_duplicates")
        out = found if out is None else out.unionByName(found)
    return out


def _raw_pattern(layout: LakeLayout, area: str, system: str, endpoint: str, day: str, file_type: str) -> str:
    """A day's files of a table by pattern, so that their paths stay off the driver."""
    letters = "".join(f"[{c.lower()}{c.upper()}]" for c in file_type)
    return f"{layout.raw_root}/{area}/{system}/{endpoint}/{day}/*.{letters}"


def standardize(spark: SparkSession, layout: LakeLayout, file_type: str, ingestion_date: Any,
                business_area: str | None = None, check_integrity: bool = True,
                load_ts: Any = None, schemas: Mapping[str, StructType] | None = None,
                target: LakeLayout | None = None, output_format: str = "parquet",
                parallelism: int = 4, json_array: bool | None = None) -> DataFrame:
    """Standardize one day's raw files of one type into Parquet with audit columns.

    One read per table (all its files of the day, by path pattern), audit columns, an overwrite of
    ``standardized/{area}/{system}/{endpoint}/{day}/{endpoint}_{day}.parquet``, and an
    optional duplicate check on the written copy (rows repeated within one raw file; see
    ``duplicate_raw_files`` for which). A table that fails is reported
    and the run goes on. Returns one status row per table.
    ``target`` writes the standardized layer under another root (default: ``layout``).
    ``output_format="delta"`` writes Delta tables (needs the Delta package).
    ``parallelism`` tables are processed at the same time. ``json_array`` says whether raw
    JSON files are arrays (``True``) or JSON Lines (``False``); ``None`` finds the form of
    each file. CSV files are read under their own headers and united by name. What can't be read is
    counted in ``n_corrupt`` by the write itself, with or without ``check_integrity``, and ``ok`` is
    false: JSON records that are no JSON are left out, CSV rows keep the values their header names.
    A table's day is entered in its snapshot index once it is written.
    """
    if output_format not in ("parquet", "delta"):
        raise ValueError(f"unknown output format {output_format!r}")
    target = target or layout
    day = date_key(ingestion_date)
    files = select_raw_files(spark, layout.raw_root, file_type, day, business_area)
    tables = (files.groupBy("business_area", "source_system", "endpoint", "date_extraction")
                   .agg(F.count("*").alias("n_files"))
                   .orderBy("business_area", "source_system", "endpoint")
                   .collect())  # one row per table of the day: bounded metadata
    @copies_removed(spark)  # the staged lines are as large as the raw files
    def run(t) -> tuple:
        out_path = target.standardized(t.business_area, t.endpoint, day, t.source_system, output_format)
        n_rows = n_dup = n_corrupt = None
        ok, error = True, None
        raw = _raw_pattern(layout, t.business_area, t.source_system, t.endpoint, day, file_type)
        try:
            schema = (schemas or {}).get(t.endpoint)
            df = read_raw_csv(spark, raw, schema) if file_type == "csv" else read_raw_json(spark, raw, schema, json_array)
            bad = Observation(f"corrupt-{t.endpoint}-{uuid.uuid4().hex}")
            df = df.observe(bad, F.count_if(F.col(CORRUPT).isNotNull()).alias("n_corrupt"))
            names = [c for c in df.columns if c not in (CORRUPT, SOURCE_FILE)]
            lost = F.lit(file_type == "json") & F.col(CORRUPT).isNotNull()
            for c in names:  # a text without any field that could be read
                lost = lost & F.col(quoted(c)).isNull()
            writer = write_delta if output_format == "delta" else partial(write_parquet, compression=LAYER_CODEC)
            table_root = target.standardized_table(t.business_area, t.endpoint, t.source_system)
            earlier = _days_without_index(spark, table_root, output_format)
            writer(add_audit_columns(df.where(~lost).drop(CORRUPT, SOURCE_FILE), load_ts), out_path)
            record_snapshot(spark, table_root, day, output_format, earlier=earlier)
            n_corrupt = int(bad.get["n_corrupt"])
            ok = not n_corrupt
            if check_integrity:
                # Checked on the columnar copy just written (raw text is parsed only once).
                written = spark.read.format(output_format).load(out_path).select(*[quoted(c) for c in names])
                with shuffles_freed(spark):
                    report = integrity_check(written).first()
                n_rows, n_dup = report.n_rows, report.n_duplicates
                if n_dup:  # the same row in two files is none: look at each file by itself
                    n_dup = _duplicates_by_file(df.where(~lost), layout).agg(F.sum("n_duplicates")).first()[0] or 0
                ok = not n_dup and not n_corrupt
        except Exception as e:  # noqa: BLE001 - per-table failure is data, not a crash
            ok, error = False, f"{type(e).__name__}: {e}"
        return (t.business_area, t.source_system, t.endpoint, t.date_extraction,
                raw, out_path, n_rows, n_dup, n_corrupt, ok, error)

    # Tables are independent jobs; a few run at once so small tables do not leave the
    # cluster idle (Spark schedules jobs from several threads).
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(tables)))) as pool:
        status = list(pool.map(run, tables))
    return spark.createDataFrame(status, STATUS_SCHEMA)


# --- refine: standardized -> refined -------------------------------------------------------

def refine_dimension(spark: SparkSession, layout: LakeLayout, area: str, endpoint: str,
                     table: str, spec: ConformSpec | None = None, load_ts: Any = None,
                     system: str = fixed.RAW_CONTEXT, target: LakeLayout | None = None,
                     committed: bool = False) -> str:
    """Newest standardized snapshot -> optional transform chain -> refined table
    (under ``target``'s root when given; replaced by a commit if ``committed``)."""
    df = read_latest_snapshot(spark, layout.standardized_table(area, endpoint, system))
    if spec is not None:
        df = conform(df, spec)
    path = (target or layout).refined(area, table, system)
    publish_refined(df, path, load_ts=load_ts, committed=committed)
    return path


REFINE_STATUS_SCHEMA = "area string, endpoint string, table_name string, refined_path string, n_rows bigint, error string"


def refine_dimensions(spark: SparkSession, layout: LakeLayout,
                      tables: Sequence[tuple[str, str, str, ConformSpec | None]], load_ts: Any = None,
                      system: str = fixed.RAW_CONTEXT, target: LakeLayout | None = None,
                      parallelism: int = 4, committed: bool = False) -> DataFrame:
    """Refine several dimensions, ``(area, endpoint, table, spec)`` each, a few at a time.

    Each is ``refine_dimension``; a table that fails is reported and the others go on.
    Returns one status row per table (the row count comes from the write itself).
    """
    def run(item) -> tuple:
        area, endpoint, table, spec = item
        try:
            df = read_latest_snapshot(spark, layout.standardized_table(area, endpoint, system))
            if spec is not None:
                df = conform(df, spec)
            path = (target or layout).refined(area, table, system)
            n = publish_refined(df, path, load_ts=load_ts, committed=committed)
            return (area, endpoint, table, path, n, None)
        except Exception as e:  # noqa: BLE001 - per-table failure is data, not a crash
            return (area, endpoint, table, None, None, f"{type(e).__name__}: {e}")

    items = list(tables)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(items) or 1))) as pool:
        status = list(pool.map(run, items))
    return spark.createDataFrame(status, REFINE_STATUS_SCHEMA)


def refine_stalled_facts(spark: SparkSession, layout: LakeLayout,
                         dims: Mapping[str, tuple[str, str]], out_area: str,
                         spec: StarSpec = DEFAULT_SPEC, as_of: Any = None, load_ts: Any = None,
                         system: str = fixed.RAW_CONTEXT, committed: bool = False) -> dict[str, str]:
    """Build the three stalled-case facts from the refined dimensions.

    ``dims`` maps ``movements``, ``units``, ``cases``, ``case_types`` to (area, table) of
    refined tables. Writes ``stalled_cases``, ``stalled_by_unit`` and ``stalled_by_type`` under ``out_area`` and returns their paths.
    """
    frames = {role: read_parquet(spark, layout.refined(a, t, system)) for role, (a, t) in dims.items()}
    detail = stalled_detail(frames["movements"], frames["units"], frames["cases"],
                            frames["case_types"], spec)
    # One row per (unit, case) group: checkpointed once to the shared checkpoint folder,
    # then the three facts read it instead of recomputing the aggregation three times.
    checkpoint_root(spark)
    detail = detail.checkpoint(eager=True)
    outputs = {
        "stalled_cases": stalled_cases_from_detail(detail, as_of),
        "stalled_by_unit": by_unit_from_detail(detail),
        "stalled_by_type": by_type_from_detail(detail),
    }
    paths = {}
    for name, df in outputs.items():
        paths[name] = layout.refined(out_area, name, system)
        publish_refined(df, paths[name], load_ts=load_ts, committed=committed)
    return paths


# --- consume: refined -> warehouse ------------------------------------------------------------

def publish_to_warehouse(spark: SparkSession, layout: LakeLayout, area: str, table: str,
                         url: str, mode: str = "overwrite", schema: str = "dw",
                         properties: Mapping[str, str] | None = None,
                         context: str = fixed.RAW_CONTEXT, **write_options) -> None:
    """Copy a refined table into ``{schema}.{table}`` with mode overwrite or append."""
    df = read_parquet(spark, layout.refined(area, table, context))
    write_jdbc(df, url, f"{schema}.{table}", mode, properties, **write_options)
