from lakestrata.operators.quality import (
    duplicate_files,
    integrity_check,
    null_counts,
    null_profile,
    observe_rows,
    table_profile,
)
from lakestrata.operators.relational import (
    anti_join,
    broadcast_if_bounded,
    count_by,
    dedupe_keep_first,
    distinct_rows,
    exclude_values,
    join_dimension,
    latest_per_group,
    latest_per_group_join_back,
    max_by_group,
    preview_topn,
    register_views,
    replicate_rows,
    semi_join,
    sql_over_frames,
    union_by_name,
    union_positional,
)
from lakestrata.operators.transforms import (
    ConformSpec,
    add_audit_columns,
    add_surrogate_key,
    cast_columns,
    clean_string_columns,
    conform,
    conform_to_schema,
    drop_columns,
    map_column_values,
    rename_columns,
)

__all__ = [
    "ConformSpec",
    "add_audit_columns",
    "add_surrogate_key",
    "anti_join",
    "broadcast_if_bounded",
    "cast_columns",
    "clean_string_columns",
    "conform",
    "conform_to_schema",
    "count_by",
    "dedupe_keep_first",
    "distinct_rows",
    "drop_columns",
    "exclude_values",
    "duplicate_files",
    "integrity_check",
    "join_dimension",
    "latest_per_group",
    "latest_per_group_join_back",
    "map_column_values",
    "max_by_group",
    "null_counts",
    "null_profile",
    "observe_rows",
    "preview_topn",
    "register_views",
    "replicate_rows",
    "rename_columns",
    "semi_join",
    "sql_over_frames",
    "table_profile",
    "union_by_name",
    "union_positional",
]
