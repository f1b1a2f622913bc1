from lakestrata.functions.expressions import (
    as_of_date,
    clean_string,
    date_key,
    days_since,
    file_extension,
    local_time_text,
    map_values,
    null_like,
    parse_date_key,
    parse_event_time,
    path_part,
    swap_extension,
)

__all__ = [
    "as_of_date",
    "clean_string",
    "date_key",
    "days_since",
    "file_extension",
    "local_time_text",
    "map_values",
    "null_like",
    "parse_date_key",
    "parse_event_time",
    "path_part",
    "swap_extension",
]
