from lakestrata.plans.facts import (
    DEFAULT_SPEC,
    StarSpec,
    latest_movements,
    stalled_by_type,
    stalled_by_unit,
    stalled_cases,
    stalled_detail,
)
from lakestrata.plans.layers import (
    entity_from_responses,
    extract_responses,
    ingest_responses,
    land_raw,
    lift_nested_ids,
    nested_entity,
    publish_to_warehouse,
    read_responses,
    refine_dimension,
    refine_dimensions,
    refine_stalled_facts,
    restrict_requests,
    standardize,
)

__all__ = [
    "DEFAULT_SPEC",
    "StarSpec",
    "entity_from_responses",
    "extract_responses",
    "ingest_responses",
    "land_raw",
    "latest_movements",
    "lift_nested_ids",
    "nested_entity",
    "publish_to_warehouse",
    "read_responses",
    "refine_dimension",
    "refine_dimensions",
    "refine_stalled_facts",
    "restrict_requests",
    "stalled_by_type",
    "stalled_by_unit",
    "stalled_cases",
    "stalled_detail",
    "standardize",
]
