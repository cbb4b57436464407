"""Queries exposing each composite operator of the reports on its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.functions.dates import at_midnight
from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.event_log import (
    DELETED,
    latest_setting,
    location_events,
    mapping_history_collapsed,
    mapping_history_flat,
    pair_events,
    store_location_events,
)
from accrualkit.operators.temporal import as_of_each
from accrualkit.params import PmsSelector, ReportMonth
from accrualkit.plans import reports as RP
from accrualkit.plans import roster as R
from accrualkit.plans import syncs as S
from accrualkit.plans.mapping_state import MappingState
from accrualkit.plans.materialize import reuse
from accrualkit.plans.months import report_active_locations_of_months
from accrualkit.plans.registry_params import (
    ACTIVE_MONTH,
    ACTIVE_MONTH_EARLY,
    ATHENA_APPS,
    BOOKING_END_LAST_DAY,
    DENTICON,
    NO_AVAILABILITY_SINCE,
)
from accrualkit.session import checkpoint_dir
from accrualkit.sources.catalog import SourceCatalog

LOG_BUCKETS = 16
#: When the second and third delivery of the mapping log begin, and how late deletes arrive.
DELIVERIES = ("2023-07-01", "2024-01-01")
DELETES_DELAY_DAYS = 40

# Parameters that distinguish the composite runs from the
# report runs.
ALL_SYNC_OVERVIEW_APPS = ("CernerMillenniumAPI", "CernerMillenniumR4", "Other")
SECOND_DAY = "2024-01-02"


def _cat(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return SourceCatalog.from_testdata(spark, sf_dir)


def _syncs(cat: SourceCatalog) -> DataFrame:
    m = ReportMonth.of(ACTIVE_MONTH)
    return S.active_syncs_as_of(cat, mapping_history_flat(cat("setting")), DENTICON, at_midnight(m.next_start))


def q_latest_setting(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return latest_setting(cat("setting"), cat("practice_management_software"))


def q_mapping_history_flat(spark, sf_dir):
    return mapping_history_flat(_cat(spark, sf_dir)("setting"))


def q_mapping_history_collapsed(spark, sf_dir):
    return mapping_history_collapsed(_cat(spark, sf_dir)("setting"))


def q_mapping_history_bucketed(spark, sf_dir):
    """The flat history from the log stored in buckets of (sync DB, location): no shuffle."""
    cat = _cat(spark, sf_dir)
    table = f"mapping_log_{cat.token}"
    log = store_location_events(cat("setting"), table, LOG_BUCKETS, f"{checkpoint_dir(spark).rstrip('/')}/{table}")
    return pair_events(log, placed=True).drop("occurrence")


def q_mapping_history_incremental(spark, sf_dir):
    """The flat history merged from three deliveries; deletes arrive weeks after they happened."""
    cat = _cat(spark, sf_dir)
    log = location_events(cat("setting"))
    arrived = F.col("ts") + F.when(F.col("event_type") == DELETED, F.expr(f"INTERVAL {DELETES_DELAY_DAYS} DAYS")).otherwise(F.expr("INTERVAL 0 DAYS"))
    number = F.coalesce(sum((arrived >= at_midnight(d)).cast("int") for d in DELIVERIES), F.lit(0))
    deliveries = log.withColumn("delivery", number)
    part = lambda i: deliveries.filter(F.col("delivery") == i).drop("delivery")
    state = MappingState.start(part(0), f"{checkpoint_dir(spark).rstrip('/')}/mapping-state-{cat.token}")
    for i in range(1, len(DELIVERIES) + 1):
        state = state.merge(part(i), deliveries.filter(F.col("delivery") <= i).drop("delivery"))
    return state.history()


def q_filter_as_of_each(spark, sf_dir):
    """Mappings valid at each month start of the monthly snapshots, by a binned interval join."""
    cat = _cat(spark, sf_dir)
    months = cat("practice_snapshot_summary_month").select(F.col("snapshot_month_eastern").cast("timestamp_ntz").alias("boundary"))
    return as_of_each(mapping_history_flat(cat("setting")), "created_date_utc", "deleted_date_utc", months, "boundary")


def q_report_active_locations_of_months(spark, sf_dir):
    return report_active_locations_of_months(_cat(spark, sf_dir), (ACTIVE_MONTH_EARLY, ACTIVE_MONTH), DENTICON, "day")


def q_active_syncs_as_of(spark, sf_dir):
    return _syncs(_cat(spark, sf_dir))


def q_active_practices_day(spark, sf_dir):
    return S.active_practices(_cat(spark, sf_dir), ReportMonth.of(ACTIVE_MONTH), "day")


def q_active_practices_month(spark, sf_dir):
    return S.active_practices(_cat(spark, sf_dir), ReportMonth.of(ACTIVE_MONTH), "month")


def q_live_aggregate_mappings(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return S.live_aggregate_mappings(cat, _syncs(cat))


def q_active_provider_locations(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return S.active_provider_locations(cat, ReportMonth.of(ACTIVE_MONTH), S.live_aggregate_mappings(cat, _syncs(cat)))


def q_providers_per_location(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    live = S.live_aggregate_mappings(cat, _syncs(cat))
    return S.providers_per_location(S.active_provider_locations(cat, ReportMonth.of(ACTIVE_MONTH), live))


def q_primary_location_contact(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return S.primary_location_contact(cat, _syncs(cat))


def _athena_dbs(cat: SourceCatalog) -> DataFrame:
    return S.selected_sync_dbs(cat, PmsSelector.by_name(*ATHENA_APPS)).select("sync_db_id").distinct()


def q_still_synced_locations(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    return S.still_synced_locations(mapping_history_collapsed(cat("setting")), _athena_dbs(cat))


def q_desync_date(spark, sf_dir):
    """Per selected sync DB: open locations and, once none is open, the last delete."""
    cat = _cat(spark, sf_dir)
    history = mapping_history_collapsed(cat("setting"))
    dbs = _athena_dbs(cat).withColumnRenamed("sync_db_id", "_db")
    rows = history.join(dbs, history["sync_db_id"] == dbs["_db"])
    agg = rows.groupBy("sync_db_id").agg(
        F.count_distinct(F.when(F.col("deleted_date_utc").isNull(), F.col("location_id"))).alias("num_locations_still_synced"),
        F.max("deleted_date_utc").alias("_last"),
    )
    return agg.select(
        "sync_db_id",
        "num_locations_still_synced",
        S.desync_date(F.col("num_locations_still_synced"), F.col("_last")).alias("desync_date"),
    )


def q_latest_snapshot_per_key(spark, sf_dir):
    """Latest opportunity-index row per provider (no activity filter)."""
    oi = _cat(spark, sf_dir)("opportunity_index").select(
        "provider_id", "snapshot_date_est", "main_specialty", "sync_type", "is_active"
    )
    return top1_per_group(oi, ["provider_id"], ["snapshot_date_est"])


def q_bookable_provider_roster(spark, sf_dir):
    return R.bookable_provider_roster(_cat(spark, sf_dir), "is_bookable_legacy")


def q_provider_enrichment(spark, sf_dir):
    """Roster ⟕ latest explorer ⟕ latest active opportunity ⟕ CRM contacts."""
    cat = _cat(spark, sf_dir)
    enriched = reuse(R.provider_enrichment(cat, R.bookable_provider_roster(cat, "is_bookable")))
    return R.with_contacts(cat, enriched).distinct()


def q_npi_lookup(spark, sf_dir):
    cat = _cat(spark, sf_dir)
    roster = R.bookable_provider_roster(cat, "is_bookable")
    npi = R.npi_lookup(cat)
    return roster.join(npi, roster["docter_id"] == npi["_npi_prof"]).select("c_docter_id", "docter_id", "npi", "practice_name")


def q_parent_entity_rollup(spark, sf_dir):
    return RP.report_parent_entities(_cat(spark, sf_dir), ALL_SYNC_OVERVIEW_APPS)


def q_booking_bucket(spark, sf_dir):
    return RP.report_bookings(_cat(spark, sf_dir), SECOND_DAY, BOOKING_END_LAST_DAY)


def q_no_availability_bucket(spark, sf_dir):
    """No-availability bucket minus providers who already had appointments."""
    cat = _cat(spark, sf_dir)
    booked = cat("appointment_summary").select("provider_id")
    return RP.report_no_availability(cat, NO_AVAILABILITY_SINCE, excluded_provider_ids=booked)


COMPOSITES = {
    "latest_setting": q_latest_setting,
    "mapping_history_flat": q_mapping_history_flat,
    "mapping_history_collapsed": q_mapping_history_collapsed,
    "mapping_history_bucketed": q_mapping_history_bucketed,
    "mapping_history_incremental": q_mapping_history_incremental,
    "filter_as_of_each": q_filter_as_of_each,
    "report_active_locations_of_months": q_report_active_locations_of_months,
    "active_syncs_as_of": q_active_syncs_as_of,
    "active_practices_day": q_active_practices_day,
    "active_practices_month": q_active_practices_month,
    "live_aggregate_mappings": q_live_aggregate_mappings,
    "active_provider_locations": q_active_provider_locations,
    "providers_per_location": q_providers_per_location,
    "primary_location_contact": q_primary_location_contact,
    "still_synced_locations": q_still_synced_locations,
    "desync_date": q_desync_date,
    "latest_snapshot_per_key": q_latest_snapshot_per_key,
    "bookable_provider_roster": q_bookable_provider_roster,
    "provider_enrichment": q_provider_enrichment,
    "npi_lookup": q_npi_lookup,
    "parent_entity_rollup": q_parent_entity_rollup,
    "booking_bucket": q_booking_bucket,
    "no_availability_bucket": q_no_availability_bucket,
}
