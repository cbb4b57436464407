"""Named queries: every report variant, composite and elementary operator.

Each entry is ``(spark, sf_dir) -> DataFrame`` over the test-data catalog.
Report-run parameters live in ``registry_params.py``; the composite and
elementary queries in ``composite_queries.py`` and ``operator_queries.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accrualkit.plans import reports as RP
from accrualkit.plans.composite_queries import COMPOSITES
from accrualkit.plans.operator_queries import OPERATOR_QUERIES
from accrualkit.plans.registry_params import (
    ACTIVE_MONTH,
    ACTIVE_MONTH_EARLY,
    ADDRESS_WINDOW,
    ALLSCRIPTS_APPS,
    ATHENA_APPS,
    BOOKING_END_LAST_DAY,
    BOOKING_END_NEXT_MONTH,
    BOOKING_START,
    DENTICON,
    EAGLESOFT,
    NEXTECH,
    NO_AVAILABILITY_EXCLUDED,
    NO_AVAILABILITY_SINCE,
    PROGNOCIS_APPS,
)
from accrualkit.sources.catalog import SourceCatalog

QueryFn = Callable[[SparkSession, str], DataFrame]

def _cat(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return SourceCatalog.from_testdata(spark, sf_dir)


REPORTS: dict[str, QueryFn] = {
    "report_api_practices_allscripts": lambda s, d: RP.report_api_practices(_cat(s, d), ALLSCRIPTS_APPS),
    "report_api_practices_athena": lambda s, d: RP.report_api_practices(_cat(s, d), ATHENA_APPS),
    "report_api_practices_prognocis": lambda s, d: RP.report_api_practices(_cat(s, d), PROGNOCIS_APPS),
    "report_active_locations_denticon": lambda s, d: RP.report_active_locations(_cat(s, d), ACTIVE_MONTH, DENTICON, "day"),
    "report_active_locations_denticon_early": lambda s, d: RP.report_active_locations(
        _cat(s, d), ACTIVE_MONTH_EARLY, DENTICON, "day"
    ),
    "report_active_locations_eaglesoft": lambda s, d: RP.report_active_locations(_cat(s, d), ACTIVE_MONTH, EAGLESOFT, "day"),
    "report_active_locations_nextech": lambda s, d: RP.report_active_locations(_cat(s, d), ACTIVE_MONTH, NEXTECH, "month"),
    "report_synced_addresses": lambda s, d: RP.report_synced_addresses(_cat(s, d), ADDRESS_WINDOW),
    "report_provider_roster": lambda s, d: RP.report_provider_roster(_cat(s, d), "is_bookable_legacy", with_npi=False),
    "report_provider_roster_npi": lambda s, d: RP.report_provider_roster(_cat(s, d), "is_bookable", with_npi=True),
    "report_parent_entities": lambda s, d: RP.report_parent_entities(_cat(s, d)),
    "report_bookings_np": lambda s, d: RP.report_bookings(_cat(s, d), BOOKING_START, BOOKING_END_NEXT_MONTH),
    "report_bookings_ep": lambda s, d: RP.report_bookings(_cat(s, d), BOOKING_START, BOOKING_END_LAST_DAY),
    "report_no_availability": lambda s, d: RP.report_no_availability(
        _cat(s, d), NO_AVAILABILITY_SINCE, excluded_provider_ids=NO_AVAILABILITY_EXCLUDED
    ),
}


def all_queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {}
    out.update(REPORTS)
    out.update(COMPOSITES)
    out.update(OPERATOR_QUERIES)
    return out
