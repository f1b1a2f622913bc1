"""Latest-event-per-group facts: stalled cases, and their counts by unit and by type.

Semantics (kept from the reference's SQL): among movements whose task is in a list and
whose case exists in ``cases``, take per (unit, case) the rows at the latest parsed
event time (all tied rows stay); join the unit (name must differ from an excluded
name), the case and its type (name must be in a list); report the case, unit name,
type name and whole days from the latest event to ``as_of``. Counts are rows after the
joins, not distinct cases.

Plan (``method="aggregate"``, the default; checked with ``explain``):

1. scan movements with the task filter pushed to Parquet, drop rows with a null unit or case and
   rows whose unit or case a bit map of the eligible keys rules out (a bounded broadcast, below
   the first shuffle), parse the time once (rows with a null time can never be a group's maximum:
   ``max`` skips them, and a group with no valid time is dropped after step 3);
2. count movements per (unit, case, time): partial aggregation before the shuffle, so
   copies of one movement collapse map-side however many there are;
3. per (unit, case) keep the latest time and the count at that time
   (``max`` + ``max_by``), again with partial aggregation: one row per group leaves
   each map task. No sort, no window, and no task ever holds a whole group;
4. join that one row per group to units and to cases x types (AQE broadcasts a side
   whose runtime size is under the threshold, else a sort-merge join with skew
   splitting);
5. the counts by unit / type are ``sum(count)``; only the detail fact turns counts back
   into rows, in bounded chunks spread over tasks (``replicate_rows``).

``method="window"`` (``rank() == 1`` with a map-side group limit) and
``method="join_back"`` (the reference's max + join back) give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestrata import fixed
from lakestrata.functions.expressions import days_since, parse_event_time
from lakestrata.operators.relational import latest_per_group, latest_per_group_join_back, might_match, replicate_rows


@dataclass(frozen=True)
class StarSpec:
    """Column names and literal filters of the movements/units/cases/types star."""

    move_case: str = fixed.MOVEMENT_CASE
    move_unit: str = fixed.MOVEMENT_UNIT
    move_task: str = fixed.MOVEMENT_TASK
    move_time: str = fixed.MOVEMENT_TIME
    unit_key: str = fixed.UNIT_KEY
    unit_name: str = fixed.UNIT_NAME
    case_code: str = fixed.CASE_CODE
    case_type: str = fixed.CASE_TYPE
    type_key: str = fixed.CASE_TYPE_KEY
    type_name: str = fixed.CASE_TYPE_NAME
    time_format: str = fixed.EVENT_TIME_FORMAT
    task_codes: Sequence[Any] = fixed.STALLED_TASK_CODES
    excluded_unit: str = fixed.EXCLUDED_UNIT
    case_types: Sequence[str] = fixed.STALLED_CASE_TYPES


DEFAULT_SPEC = StarSpec()


def _task_movements(movements: DataFrame, spec: StarSpec) -> DataFrame:
    return (movements
            .where(F.col(spec.move_task).isin(list(spec.task_codes)))
            .select(F.col(spec.move_unit).alias("__unit"),
                    F.col(spec.move_case).alias("__case"),
                    parse_event_time(spec.move_time, spec.time_format).alias("__ts")))


def latest_movements(movements: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                     method: str = "aggregate") -> DataFrame:
    """Per (unit, case) the latest event time and how many movements share it.

    Output columns: ``__unit, __case, __ts, __n`` (one row per group).
    """
    m = _task_movements(movements, spec).where(F.col("__unit").isNotNull() & F.col("__case").isNotNull())
    if method == "aggregate":
        # Null times are dropped after the aggregation (max/max_by skip them): a filter on
        # the parsed time before it would be pushed under the projection and parse twice.
        per_time = m.groupBy("__unit", "__case", "__ts").agg(F.count(F.lit(1)).alias("__n"))
        latest = per_time.groupBy("__unit", "__case").agg(
            F.max("__ts").alias("__ts"), F.max_by("__n", "__ts").alias("__n"))
        return latest.where(F.col("__ts").isNotNull())
    m = m.where(F.col("__ts").isNotNull())
    if method == "window":
        rows = latest_per_group(m, ["__unit", "__case"], "__ts", salts=1)
    elif method == "join_back":
        rows = latest_per_group_join_back(m, ["__unit", "__case"], "__ts")
    else:
        raise ValueError(f"unknown method {method!r}")
    return rows.groupBy("__unit", "__case", "__ts").agg(F.count(F.lit(1)).alias("__n"))


def _only_eligible(movements: DataFrame, units: DataFrame, cases: DataFrame, case_types: DataFrame, spec: StarSpec) -> DataFrame:
    """Movements whose unit and case may survive the joins, told by bit maps of the eligible keys."""
    out = might_match(movements, spec.move_case, _eligible_cases(cases, case_types, spec).select("__ccode"))
    return might_match(out, spec.move_unit, _eligible_units(units, spec).select("__ukey"))


def _eligible_units(units: DataFrame, spec: StarSpec) -> DataFrame:
    # `!=` drops a null name, as the SQL comparison does.
    return (units.where(F.col(spec.unit_name) != F.lit(spec.excluded_unit))
                 .select(F.col(spec.unit_key).alias("__ukey"), F.col(spec.unit_name).alias("__uname")))


def _eligible_cases(cases: DataFrame, case_types: DataFrame, spec: StarSpec) -> DataFrame:
    types = (case_types.where(F.col(spec.type_name).isin(list(spec.case_types)))
                       .select(F.col(spec.type_key).alias("__tkey"), F.col(spec.type_name).alias("__tname")))
    return (cases.select(F.col(spec.case_code).alias("__ccode"), F.col(spec.case_type).alias("__ctype"))
                 .join(types, F.col("__ctype") == F.col("__tkey"))
                 .select("__ccode", "__tname"))


def stalled_detail(movements: DataFrame, units: DataFrame, cases: DataFrame,
                   case_types: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                   method: str = "aggregate", prefilter: bool = True) -> DataFrame:
    """Latest movement of each group joined to its unit and case type.

    Columns: ``__case, __unit, __ts, __uname, __tname, __n``: one row per surviving join
    combination, ``__n`` the number of tied movements it stands for. With ``prefilter`` movements of
    other units and cases go before the first shuffle (see ``might_match``).
    """
    if prefilter:
        movements = _only_eligible(movements, units, cases, case_types, spec)
    return detail_from_latest(latest_movements(movements, spec, method), units, cases, case_types, spec)


def detail_from_latest(latest: DataFrame, units: DataFrame, cases: DataFrame, case_types: DataFrame, spec: StarSpec = DEFAULT_SPEC) -> DataFrame:
    """Rows of ``latest_movements`` (or of the state kept day by day) joined to unit and case type."""
    return (latest
            .join(_eligible_units(units, spec), F.col("__unit") == F.col("__ukey"))
            .join(_eligible_cases(cases, case_types, spec), F.col("__case") == F.col("__ccode"))
            .select("__case", "__unit", "__ts", "__uname", "__tname", "__n"))


def stalled_cases_from_detail(detail: DataFrame, as_of: Any = None,
                              sort_latest_first: bool = False) -> DataFrame:
    """The detail fact: one row per tied movement, as the reference's join back gives.

    Copies are made after one shuffle of the per-group rows: hash-spread, or
    range-partitioned on (latest time, case, unit, copy number) when the output is sorted, so
    neither many groups nor many copies at one time meet in one task.
    """
    if sort_latest_first:
        rows = replicate_rows(detail, "__n", sort_by=[F.col("__ts").desc(), F.col("__case"), F.col("__unit")])
    else:
        rows = replicate_rows(detail, "__n", spread_by=["__case", "__unit"])
    return rows.select(
        F.col("__case").alias(fixed.FACT_CASE),
        F.col("__uname").alias(fixed.FACT_UNIT),
        F.col("__tname").alias(fixed.FACT_TYPE),
        days_since("__ts", as_of).alias(fixed.FACT_DAYS),
    )


def stalled_cases(movements: DataFrame, units: DataFrame, cases: DataFrame,
                  case_types: DataFrame, spec: StarSpec = DEFAULT_SPEC, as_of: Any = None,
                  sort_latest_first: bool = False, method: str = "aggregate") -> DataFrame:
    """The stalled-cases fact: case, unit name, type name, days without movement.

    ``as_of`` is the date the days count up to (default: today). ``sort_latest_first``
    adds the reference's global ``ORDER BY latest DESC`` (a range shuffle; Parquet
    readers do not keep the order, so it is off by default).
    """
    detail = stalled_detail(movements, units, cases, case_types, spec, method)
    return stalled_cases_from_detail(detail, as_of, sort_latest_first)


def by_unit_from_detail(detail: DataFrame) -> DataFrame:
    return detail.groupBy(F.col("__uname").alias(fixed.FACT_BY_UNIT)).agg(
        F.sum("__n").cast("bigint").alias(fixed.FACT_COUNT))


def by_type_from_detail(detail: DataFrame) -> DataFrame:
    return detail.groupBy(F.col("__tname").alias(fixed.FACT_TYPE)).agg(
        F.sum("__n").cast("bigint").alias(fixed.FACT_COUNT))


def stalled_by_unit(movements: DataFrame, units: DataFrame, cases: DataFrame,
                    case_types: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                    method: str = "aggregate") -> DataFrame:
    """Stalled-case rows counted per unit name (``Setor, qtd``)."""
    return by_unit_from_detail(stalled_detail(movements, units, cases, case_types, spec, method))


def stalled_by_type(movements: DataFrame, units: DataFrame, cases: DataFrame,
                    case_types: DataFrame, spec: StarSpec = DEFAULT_SPEC,
                    method: str = "aggregate") -> DataFrame:
    """Stalled-case rows counted per case type name (``tipo, qtd``)."""
    return by_type_from_detail(stalled_detail(movements, units, cases, case_types, spec, method))
