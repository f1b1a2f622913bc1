from lakestrata.sinks.committed import drop_old_versions, read_current, replace_committed
from lakestrata.sinks.writers import (
    historical_backfill,
    publish_refined,
    qualify_table,
    write_csv,
    write_delta,
    write_jdbc,
    write_json,
    write_parquet,
    write_xml,
)

__all__ = [
    "drop_old_versions",
    "historical_backfill",
    "publish_refined",
    "qualify_table",
    "read_current",
    "replace_committed",
    "write_csv",
    "write_delta",
    "write_jdbc",
    "write_json",
    "write_parquet",
    "write_xml",
]
