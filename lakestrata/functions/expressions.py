"""Column expressions (all JVM-side built-ins, so they stay inside whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt
import re
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from lakestrata.fixed import DATE_KEY_FORMAT, EVENT_TIME_FORMAT, NOT_INFORMED


def quoted(*parts: str) -> str:
    """A column reference for names that may hold dots, spaces or backticks."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: Pattern letters of fixed width that make up a local time.
_TIME_PARTS = ("yyyy", "MM", "dd", "HH", "mm", "ss")


def _rearranged(col: Column, fmt: str) -> Column | None:
    """``yyyy-MM-dd HH:mm:ss`` text of a text in ``fmt``, null where it has another shape;
    ``None`` if ``fmt`` isn't made of the six parts, once each, and separators."""
    at = {part: fmt.find(part) for part in _TIME_PARTS}
    rest = fmt
    for part in _TIME_PARTS:
        rest = rest.replace(part, "", 1)
    if min(at.values()) < 0 or re.search(r"[A-Za-z'\[\]{}#]", rest):
        return None
    shape = re.sub(r"[A-Za-z]", "[0-9]", "".join(c if c.isalpha() else re.escape(c) for c in fmt))
    part = {p: F.substring(col, at[p] + 1, len(p)) for p in _TIME_PARTS}
    day = F.concat_ws("-", part["yyyy"], part["MM"], part["dd"])
    iso = F.concat_ws(" ", day, F.concat_ws(":", part["HH"], part["mm"], part["ss"]))
    return F.when((F.length(col) == len(fmt)) & col.rlike(f"^{shape}$"), iso)


def parse_event_time(c: str | Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """Text -> local timestamp (``timestamp_ntz``): the wall-clock time as written, with no
    session time zone involved, so a time that falls in a daylight-saving gap is kept as
    written and day counts do not depend on the zone. Malformed text gives null, also
    with ANSI mode on. A format of fixed-width parts is parsed once, by a cast of the rearranged
    text; for any other the strict parse only runs where the lenient one succeeded."""
    col = _col(c)
    iso = _rearranged(col, fmt)
    if iso is not None:
        return iso.try_cast("timestamp_ntz")
    return F.when(F.try_to_timestamp(col, F.lit(fmt)).isNotNull(), F.to_timestamp_ntz(col, F.lit(fmt)))


def as_of_date(as_of: str | _dt.date | _dt.datetime | Column | None) -> Column:
    """The reference date for day counts; ``None`` means today (``current_date()``)."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return F.to_date(as_of)
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.date()
    return F.lit(str(as_of)).cast("date")


def days_since(ts: str | Column, as_of: Any = None) -> Column:
    """Whole calendar days from the date of ``ts`` to ``as_of``."""
    return F.datediff(as_of_date(as_of), F.to_date(_col(ts)))


def clean_string(c: str | Column, sentinel: str = NOT_INFORMED) -> Column:
    """Trim spaces, upper-case, and replace empty or null by ``sentinel``.

    ``trim`` removes the space character only (a tab stays), and a non-string column
    becomes a string, as in the reference.
    """
    t = F.upper(F.trim(_col(c).cast("string")))
    return F.when(t != F.lit(""), t).otherwise(F.lit(sentinel))


def null_like(c: str | Column) -> Column:
    """True for null, empty text, or text containing ``None`` or ``NULL`` (case-sensitive).

    The value is compared as text so numeric columns work under ANSI mode.
    """
    s = _col(c).cast("string")
    return s.isNull() | s.contains("None") | s.contains("NULL") | (s == F.lit(""))


def map_values(c: str | Column, pairs: Mapping[Any, Any] | Iterable[tuple[Any, Any]],
               dtype: DataType | str) -> Column:
    """Replace values pair by pair, in order; a later pair sees the earlier results.

    The result keeps the column type if every new value fits it; text in place of a number
    (codes to names) makes the column text. Old values are compared as the result type, and one
    that does not convert matches nothing.
    """
    items = list(pairs.items() if isinstance(pairs, Mapping) else pairs)
    kind = dtype if isinstance(dtype, str) else dtype.simpleString()
    numeric = kind.split("(")[0] in ("tinyint", "smallint", "int", "integer", "bigint", "long", "float", "double", "decimal")
    if numeric and any(isinstance(new, str) and not _is_number(new) for _, new in items):
        dtype = "string"
    out = _col(c).cast(dtype)
    for old, new in items:
        out = F.when(out == F.lit(old).try_cast(dtype), F.lit(new).cast(dtype)).otherwise(out)
    return out


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def date_key(c: str | Column) -> Column:
    """Date or timestamp -> ``yyyyMMdd`` text."""
    return F.date_format(_col(c), DATE_KEY_FORMAT)


def parse_date_key(c: str | Column) -> Column:
    """``yyyyMMdd`` text -> date, null when malformed."""
    return F.try_to_date(_col(c), DATE_KEY_FORMAT)


def path_part(path: str | Column, index: int) -> Column:
    """1-based part of a ``/``-separated path (negative counts from the end)."""
    return F.element_at(F.split(_col(path), "/"), index)


def file_extension(path: str | Column) -> Column:
    """Text after the last dot of the last path part ('' when there is none)."""
    name = F.substring_index(_col(path), "/", -1)
    return F.when(name.contains("."), F.substring_index(name, ".", -1)).otherwise(F.lit(""))


def swap_extension(path: str | Column, old: str, new: str) -> Column:
    """Replace a trailing ``.old`` by ``.new`` (only at the end of the path)."""
    return F.regexp_replace(_col(path), rf"\.{old}$", f".{new}")


def local_time_text(c: str | Column, fmt: str) -> Column:
    """Format a ``timestamp_ntz`` without any time-zone conversion (``date_format`` goes
    through the session zone). Supported: ``dd/MM/yyyy HH:mm:ss``, ``yyyy-MM-dd HH:mm:ss``,
    ``yyyy-MM-dd``, ``yyyyMMdd``, and ``01/MM/yyyy 00:00:00`` (month start)."""
    s = _col(c).cast("string")  # yyyy-MM-dd HH:mm:ss[.ffffff]
    y, mo, d, hms = F.substring(s, 1, 4), F.substring(s, 6, 2), F.substring(s, 9, 2), F.substring(s, 12, 8)
    parts = {
        "dd/MM/yyyy HH:mm:ss": [d, F.lit("/"), mo, F.lit("/"), y, F.lit(" "), hms],
        "yyyy-MM-dd HH:mm:ss": [F.substring(s, 1, 19)],
        "yyyy-MM-dd": [F.substring(s, 1, 10)],
        "yyyyMMdd": [y, mo, d],
        "01/MM/yyyy 00:00:00": [F.lit("01/"), mo, F.lit("/"), y, F.lit(" 00:00:00")],
    }
    if fmt not in parts:
        raise ValueError(f"unsupported local time format {fmt!r}")
    return F.concat(*parts[fmt])