"""Building blocks of the sync-based reports (API practices, active locations)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import AGG_CREATE_TYPES, AGG_UPDATE_TYPES
from accrualkit.functions.dates import date_lit
from accrualkit.operators.event_log import latest_setting
from accrualkit.operators.joins import not_superseded, union_distinct
from accrualkit.operators.temporal import in_period, valid_at
from accrualkit.params import PmsSelector, ReportMonth
from accrualkit.sources.catalog import SourceCatalog


def selected_sync_dbs(cat: SourceCatalog, pms: PmsSelector, value_type: str = "bigint") -> DataFrame:
    """Latest PMS per sync DB, restricted to the selected PMS."""
    latest = latest_setting(cat("setting"), cat("practice_management_software"), value_type=value_type)
    return latest.filter(pms_predicate(pms))


def pms_predicate(pms: PmsSelector) -> Column:
    if pms.names:
        return F.col("pms_application").isin(*pms.names)
    return F.col("pms_id").isin(*pms.ids)


def active_syncs_as_of(
    cat: SourceCatalog,
    history: DataFrame,
    pms: PmsSelector,
    boundary: Column,
    value_type: str = "int",
    pms_latest: DataFrame | None = None,
) -> DataFrame:
    """Sync DB ↔ location mappings of the selected PMS valid at ``boundary``.

    DISTINCT ``(sync_db_id, location_id, cloud_location_id, cloud_practice_id,
    monolith_practice_id, created_date_utc, deleted_date_utc)`` — both the
    monolith location id of the log and the cloud ids of the dimensions.
    The PMS condition is a semi join: it filters, it never multiplies rows.
    ``pms_latest`` may pass a precomputed ``latest_setting`` table.
    """
    if pms_latest is None:
        pms_latest = latest_setting(cat("setting"), cat("practice_management_software"), value_type=value_type)
    dbs = pms_latest.filter(pms_predicate(pms)).select(F.col("sync_db_id").alias("_sel_db"))
    live = history.filter(valid_at("created_date_utc", "deleted_date_utc", boundary))
    live = live.join(dbs, live["sync_db_id"] == dbs["_sel_db"], "left_semi")
    loc = cat("location").select(
        F.col("monolith_provider_location_id").alias("_loc_mono"),
        F.col("location_id").alias("cloud_location_id"),
        F.col("practice_id").alias("_loc_practice"),
    )
    pt = cat("practice").select(
        F.col("practice_id").alias("cloud_practice_id"), F.col("monolith_provider_id").alias("monolith_practice_id")
    )
    return (
        live.join(loc, live["location_id"] == loc["_loc_mono"])
        .join(pt, F.col("_loc_practice") == pt["cloud_practice_id"])
        .select(
            "sync_db_id",
            "location_id",
            "cloud_location_id",
            "cloud_practice_id",
            "monolith_practice_id",
            "created_date_utc",
            "deleted_date_utc",
        )
        .distinct()
    )


def active_practices(cat: SourceCatalog, month: ReportMonth, activity: str = "day") -> DataFrame:
    """Practices with activity in the reported month.

    ``activity='day'``: a daily snapshot row dated on the month start.
    ``activity='month'``: a monthly snapshot row for the month with
    ``days_in_month_active > 0``.  DISTINCT ``(practice_id, name,
    monolith_provider_id)``; the snapshot is a semi join.
    """
    if activity == "day":
        snap = cat("practice_snapshot_summary_day").filter(in_period("snapshot_date_eastern", date_lit(month.start)))
    elif activity == "month":
        snap = cat("practice_snapshot_summary_month").filter(
            in_period("snapshot_month_eastern", date_lit(month.start)) & (F.col("days_in_month_active") > 0)
        )
    else:
        raise ValueError("activity must be 'day' or 'month'")
    pt = cat("practice")
    return (
        pt.join(snap.select(F.col("practice_id").alias("_snap_practice")), pt["practice_id"] == F.col("_snap_practice"), "left_semi")
        .select("practice_id", "name", "monolith_provider_id")
        .distinct()
    )


def live_aggregate_mappings(cat: SourceCatalog, syncs: DataFrame) -> DataFrame:
    """Aggregate → source location mappings still in force.

    Create events (normal or back-fill) with no later update/delete of the
    same (aggregate, source) pair, whose source location is an actively
    synced cloud location.  ``(aggregate_location_id, source_location_id,
    created_timestamp_utc)``, one row per surviving create event.
    """
    log = cat("aggregate_location_mapping_update")
    keys = ["aggregate_location_id", "source_location_id"]
    creates = log.filter(F.col("event_update_type").isin(*AGG_CREATE_TYPES)).select(*keys, "created_timestamp_utc")
    updates = log.filter(F.col("event_update_type").isin(*AGG_UPDATE_TYPES)).select(*keys, "deleted_timestamp_utc")
    live = not_superseded(creates, updates, keys, "created_timestamp_utc", "deleted_timestamp_utc")
    synced = syncs.select(F.col("cloud_location_id").alias("_synced_loc"))
    return live.join(synced, live["source_location_id"] == synced["_synced_loc"], "left_semi")


def active_provider_locations(cat: SourceCatalog, month: ReportMonth, live_mappings: DataFrame) -> DataFrame:
    """Providers active at the start of the next month, per location.

    Direct provider-location rows plus rows of aggregate locations mapped
    back to their source locations; SQL ``UNION`` (distinct) of
    ``(provider_id, location_id)``.
    """
    snap = cat("provider_location_snapshot_summary_month").filter(
        in_period("snapshot_month_eastern", date_lit(month.next_start)) & F.col("is_active_beginning_of_month")
    )
    direct = snap.select("provider_id", "location_id")
    pairs = live_mappings.select(
        F.col("aggregate_location_id").alias("_agg_loc"), F.col("source_location_id").alias("_src_loc")
    ).distinct()
    via_aggregate = snap.join(pairs, snap["location_id"] == pairs["_agg_loc"]).select(
        "provider_id", F.col("_src_loc").alias("location_id")
    )
    return union_distinct(direct, via_aggregate)


def providers_per_location(provider_locations: DataFrame) -> DataFrame:
    """``(location_id, total_num_of_providers)`` from DISTINCT pairs.

    The input pairs are already distinct, so a plain count equals the
    distinct provider count and needs one shuffle (by location) instead of two.
    """
    return provider_locations.groupBy("location_id").agg(F.count("provider_id").alias("total_num_of_providers"))


def primary_location_contact(cat: SourceCatalog, syncs: DataFrame) -> DataFrame:
    """Phone and fax of each practice's primary location.

    The primary location is the smallest monolith location id (text order)
    among the practice's active syncs.
    """
    primary = syncs.groupBy("cloud_practice_id").agg(F.min("location_id").alias("_primary"))
    loc = cat("location").select(
        F.col("monolith_provider_location_id").alias("_mono"),
        F.col("phone").alias("telephone_number"),
        F.col("fax").alias("fax_number"),
    )
    return primary.join(loc, primary["_primary"] == loc["_mono"]).select(
        "cloud_practice_id", "telephone_number", "fax_number"
    )


def still_synced_locations(history: DataFrame, dbs: DataFrame) -> DataFrame:
    """DISTINCT locations with an undeleted mapping to one of ``dbs``."""
    sel = dbs.select(F.col("sync_db_id").alias("_sel_db"))
    open_rows = history.filter(F.col("deleted_date_utc").isNull())
    return open_rows.join(sel, open_rows["sync_db_id"] == sel["_sel_db"], "left_semi").select("location_id").distinct()


def desync_date(num_still_synced: Column, last_delete: Column) -> Column:
    """NULL while any location is still synced, else the last delete."""
    return F.when(num_still_synced == 0, last_delete)
