"""The month-end run: every report of the accrual process for one month.

Six of the runs (API practices ×3, active locations ×3) read the same
event-log derivations: the mapping history (flat and collapsed) and the
latest PMS per sync database.  Run one by one, each re-numbers the whole
location-mapping log.  The two roster runs both reduce the whole explorer
and opportunity snapshot history to the latest row per provider.  Here
those intermediates are derived once, written as Parquet to the shared folder, and
handed to every run that needs them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from accrualkit.constants import CERNER_APPLICATIONS, DENTRIX_PMS
from accrualkit.operators.event_log import latest_setting, mapping_history_collapsed, mapping_history_flat
from accrualkit.params import DateWindow, PmsSelector, ReportMonth
from accrualkit.plans import reports as R
from accrualkit.plans import roster as RO
from accrualkit.plans.materialize import reuse, run_scope
from accrualkit.sources.catalog import SourceCatalog

# The report runs of one month-end, per script family.
API_PRACTICE_RUNS = {
    "api_practices_allscripts": ("AllScriptsAPI",),
    "api_practices_athena": ("Athena", "AthenaAPI"),
    "api_practices_prognocis": ("CAPI_PrognoCIS",),
}
ACTIVE_LOCATION_RUNS = {
    "active_locations_denticon": (PmsSelector.by_name("Denticon"), "day"),
    "active_locations_eaglesoft": (PmsSelector.by_id(11, 12), "day"),
    "active_locations_nextech": (PmsSelector.by_id(10), "month"),
}


class Shared:
    """Intermediates shared by the runs of one month, each derived (and
    written) on first use only."""

    def __init__(self, cat: SourceCatalog):
        self.cat = cat

    @cached_property
    def history_flat(self) -> DataFrame:
        return reuse(mapping_history_flat(self.cat("setting")))

    @cached_property
    def history_collapsed(self) -> DataFrame:
        return reuse(mapping_history_collapsed(self.cat("setting")))

    @cached_property
    def pms_latest_int(self) -> DataFrame:
        return reuse(latest_setting(self.cat("setting"), self.cat("practice_management_software"), value_type="int"))

    @cached_property
    def pms_latest_bigint(self) -> DataFrame:
        return reuse(latest_setting(self.cat("setting"), self.cat("practice_management_software"), value_type="bigint"))

    @cached_property
    def explorer_latest(self) -> DataFrame:
        return reuse(RO.latest_explorer_row(self.cat))

    @cached_property
    def opportunity_latest(self) -> DataFrame:
        return reuse(RO.latest_active_opportunity_row(self.cat))


def month_end_runs(cat: SourceCatalog, month: dt.date | str) -> dict[str, Callable[[], DataFrame]]:
    """Named report builders for ``month``.

    Calling a builder derives the shared intermediates that it needs and are
    not there yet (Spark jobs); the DataFrame that it returns is lazy.
    """
    m = ReportMonth.of(month)
    sh = Shared(cat)
    runs: dict[str, Callable[[], DataFrame]] = {}
    for name, apps in API_PRACTICE_RUNS.items():
        runs[name] = lambda apps=apps: R.report_api_practices(
            cat, apps, history=sh.history_collapsed, pms_latest=sh.pms_latest_bigint
        )
    for name, (sel, activity) in ACTIVE_LOCATION_RUNS.items():
        runs[name] = lambda sel=sel, activity=activity: R.report_active_locations(
            cat, m.start, sel, activity, history=sh.history_flat, pms_latest=sh.pms_latest_int
        )
    runs["synced_addresses"] = lambda: R.report_synced_addresses(cat, DateWindow(m.start, m.last_day), DENTRIX_PMS)
    runs["provider_roster"] = lambda: R.report_provider_roster(
        cat, "is_bookable_legacy", False, sh.explorer_latest, sh.opportunity_latest
    )
    runs["provider_roster_npi"] = lambda: R.report_provider_roster(
        cat, "is_bookable", True, sh.explorer_latest, sh.opportunity_latest
    )
    runs["parent_entities"] = lambda: R.report_parent_entities(cat, CERNER_APPLICATIONS)
    runs["bookings_np"] = lambda: R.report_bookings(cat, m.start, m.next_start)
    runs["bookings_ep"] = lambda: R.report_bookings(cat, m.start, m.last_day)
    runs["no_availability"] = lambda: R.report_no_availability(cat, m.start)
    return runs


def run_month_end(
    cat: SourceCatalog, month: dt.date | str, out: str, fmt: str = "parquet", only: list[str] | None = None
) -> dict[str, str]:
    """Build and write every report of the month under ``out/<report>``.

    The shared intermediates and session views are removed at the end.
    """
    written = {}
    with run_scope(cat.spark):
        for name, build in month_end_runs(cat, month).items():
            if only and name not in only:
                continue
            path = f"{out.rstrip('/')}/{name}"
            writer = build().write.mode("overwrite")
            if fmt == "csv":
                writer.option("header", "true").csv(path)
            else:
                writer.format(fmt).save(path)
            written[name] = path
    return written
