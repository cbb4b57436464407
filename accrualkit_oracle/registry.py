"""Oracle SQL per query name (DuckDB; base tables pre-registered as views)."""

from __future__ import annotations

from accrualkit_oracle import reports_sql as R
from accrualkit_oracle.composites_sql import COMPOSITE_SQL
from accrualkit_oracle.operators_sql import OPERATOR_SQL
from accrualkit_oracle.fixtures_sql import with_fixtures

REPORT_SQL: dict[str, str] = {
    "report_api_practices_allscripts": R.r1_api_practices(["AllScriptsAPI"]),
    "report_api_practices_athena": R.r1_api_practices(["Athena", "AthenaAPI"]),
    "report_api_practices_prognocis": R.r1_api_practices(["CAPI_PrognoCIS"]),
    "report_active_locations_denticon": R.r2_active_locations("2024-03-01", "p.app = 'Denticon'", "day"),
    "report_active_locations_denticon_early": R.r2_active_locations("2024-01-01", "p.app = 'Denticon'", "day"),
    "report_active_locations_eaglesoft": R.r2_active_locations("2024-03-01", "p.pms_id in (11, 12)", "day"),
    "report_active_locations_nextech": R.r2_active_locations("2024-03-01", "p.pms_id = 10", "month"),
    "report_synced_addresses": R.r3_synced_addresses("2023-12-01", "2023-12-31", ["Dentrix", "DentrixG5"]),
    "report_provider_roster": R.r4_provider_roster("is_bookable_legacy", with_npi=False),
    "report_provider_roster_npi": R.r4_provider_roster("is_bookable", with_npi=True),
    "report_parent_entities": R.r5_parent_entities(["CernerMillenniumAPI", "CernerMillenniumR4"]),
    "report_bookings_np": R.r6_bookings("2024-01-01", "2024-02-01", "%raintree%"),
    "report_bookings_ep": R.r6_bookings("2024-01-01", "2024-01-31", "%raintree%"),
    "report_no_availability": R.r7_no_availability("2023-12-01", "%raintree%", ["P3", "P27", "P105", ""]),
}


# DATE-typed output columns per query.  The driver contract delivers them as
# midnight TIMESTAMPs on both sides (see __spark_entry__); a test checks this
# list against the Spark schemas.
DATE_COLUMNS: dict[str, tuple[str, ...]] = {
    "latest_snapshot_per_key": ("snapshot_date_est",),
    "param_from_query": ("last_day",),
    "report_active_locations_of_months": ("report_month",),
    "project_predicate": ("snapshot_date_est",),
    "lateral_alias_window": ("snapshot_date_eastern",),
    "filter_not_in": ("snapshot_date_eastern",),
    "filter_not_in_relation": ("snapshot_date_eastern",),
    "filter_not_equal": ("snapshot_date_eastern",),
    "filter_numeric_gt": ("snapshot_month_eastern",),
    "filter_period_eq": ("snapshot_month_eastern",),
    "filter_open_range": ("snapshot_date_eastern",),
    "filter_and_or": ("snapshot_date_est",),
    "filter_null_rejecting_after_outer": ("snapshot_date_est",),
    "join_inner_multikey": ("snapshot_month_eastern",),
    "win_row_number_desc": ("snapshot_date_est",),
    "qualify_alias": ("snapshot_date_eastern",),
    "qualify_and_predicate": ("snapshot_date_est",),
    "sort_multi_mixed": ("snapshot_date_eastern",),
    "fn_cast_date": ("event_date",),
    "fn_last_day": ("month_end",),
    "fn_day": ("month_start",),
    "fn_add_months": ("snapshot_month_eastern", "next_month"),
    "fn_dateadd_day": ("snapshot_date_est", "next_day"),
    "fn_case_pms": ("snapshot_date_est",),
    "fn_case_sync_type": ("snapshot_date_est",),
}


def dates_as_timestamps(name: str, sql: str) -> str:
    cols = DATE_COLUMNS.get(name)
    if not cols:
        return sql
    replace = ", ".join(f"cast({c} as timestamp) as {c}" for c in cols)
    return f"select * replace ({replace}) from (\n{sql}\n) as q"


def all_sql(raw_dates: bool = False) -> dict[str, str]:
    out = {}
    out.update(REPORT_SQL)
    out.update(COMPOSITE_SQL)
    out.update(OPERATOR_SQL)
    full = {k: with_fixtures(v) for k, v in out.items()}
    if raw_dates:
        return full
    return {k: dates_as_timestamps(k, v) for k, v in full.items()}
