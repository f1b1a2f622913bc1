from lakestrata.sources.files import (
    latest_snapshot_date,
    latest_snapshot_path,
    layout_files,
    list_files,
    read_csv,
    read_json,
    read_latest_snapshot,
    read_parquet,
    read_xml,
    relative_path,
    select_raw_files,
)
from lakestrata.sources.jdbc import jdbc_options, read_query, read_table
from lakestrata.sources.layout import LakeLayout, date_key

__all__ = [
    "LakeLayout",
    "date_key",
    "jdbc_options",
    "latest_snapshot_date",
    "latest_snapshot_path",
    "layout_files",
    "list_files",
    "read_csv",
    "read_json",
    "read_latest_snapshot",
    "read_parquet",
    "read_query",
    "read_table",
    "read_xml",
    "relative_path",
    "select_raw_files",
]
