"""Reusable DataFrame operators (event log, intervals, top-1, joins)."""

from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.event_log import (
    latest_setting,
    mapping_events,
    mapping_history_collapsed,
    mapping_history_flat,
)
from accrualkit.operators.joins import mark_members, not_superseded, union_distinct
from accrualkit.operators.ordinal import occurrence_number
from accrualkit.operators.temporal import as_of, between_inclusive, currently_active, in_period, valid_at

__all__ = [
    "top1_per_group",
    "latest_setting",
    "mapping_events",
    "mapping_history_collapsed",
    "mapping_history_flat",
    "mark_members",
    "not_superseded",
    "union_distinct",
    "occurrence_number",
    "as_of",
    "between_inclusive",
    "currently_active",
    "in_period",
    "valid_at",
]
