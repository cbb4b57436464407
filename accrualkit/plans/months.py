"""Active synced locations of several months in one pass over the logs.

``report_active_locations`` asks every input about one month.  Here each input
is read once for all months and carries the month along as a column, so the
mapping log is numbered once and the as-of condition is a binned interval join.
The months are a small table of literals (one row each), which is broadcast.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import AGG_CREATE_TYPES, AGG_UPDATE_TYPES
from accrualkit.operators.event_log import latest_setting, mapping_history_flat
from accrualkit.operators.joins import not_superseded, union_distinct
from accrualkit.operators.temporal import as_of_each
from accrualkit.params import PmsSelector, ReportMonth
from accrualkit.plans import syncs as S
from accrualkit.plans.materialize import reuse
from accrualkit.sources.catalog import SourceCatalog

MONTH = "report_month"


def month_table(cat: SourceCatalog, months: Sequence[dt.date | str]) -> DataFrame:
    """report_month, next_month and boundary (midnight of the next month) of each month."""
    rows = sorted({(m.start.isoformat(), m.next_start.isoformat()) for m in map(ReportMonth.of, months)})
    text = cat.spark.createDataFrame(rows, "first string, next string")
    return text.select(
        F.col("first").cast("date").alias(MONTH), F.col("next").cast("date").alias("next_month"),
        F.col("next").cast("date").cast("timestamp_ntz").alias("boundary"),
    )


def active_syncs_of_months(cat: SourceCatalog, history: DataFrame, months: DataFrame) -> DataFrame:
    """DISTINCT mappings (as ``active_syncs_as_of``) with the month at whose end they are valid."""
    live = as_of_each(history, "created_date_utc", "deleted_date_utc", months.select("boundary"), "boundary")
    live = live.join(F.broadcast(months.select(MONTH, "boundary")), "boundary")
    loc = cat("location").select(
        F.col("monolith_provider_location_id").alias("location_id"), F.col("location_id").alias("cloud_location_id"), "practice_id"
    )
    known = cat("practice").select("practice_id")
    return (
        live.join(loc, "location_id").join(known, "practice_id")
        .select(MONTH, "sync_db_id", "location_id", "cloud_location_id", F.col("practice_id").alias("cloud_practice_id"), "created_date_utc")
        .distinct()
    )


def active_practices_of_months(cat: SourceCatalog, months: DataFrame, activity: str) -> DataFrame:
    """DISTINCT practices with the month of their snapshot activity."""
    if activity == "day":
        snap = cat("practice_snapshot_summary_day").select("practice_id", F.col("snapshot_date_eastern").alias(MONTH))
    elif activity == "month":
        snap = cat("practice_snapshot_summary_month").filter(F.col("days_in_month_active") > 0)
        snap = snap.select("practice_id", F.col("snapshot_month_eastern").alias(MONTH))
    else:
        raise ValueError("activity must be 'day' or 'month'")
    of_months = snap.join(F.broadcast(months.select(MONTH)), MONTH, "left_semi")
    return of_months.join(cat("practice"), "practice_id").select(MONTH, "practice_id", "name", "monolith_provider_id").distinct()


def providers_of_months(cat: SourceCatalog, syncs: DataFrame, months: DataFrame) -> DataFrame:
    """(month, cloud location, providers active at the start of the next month), also by way of aggregate locations."""
    log = cat("aggregate_location_mapping_update")
    keys = ["aggregate_location_id", "source_location_id"]
    creates = log.filter(F.col("event_update_type").isin(*AGG_CREATE_TYPES)).select(*keys, "created_timestamp_utc")
    updates = log.filter(F.col("event_update_type").isin(*AGG_UPDATE_TYPES)).select(*keys, "deleted_timestamp_utc")
    live = not_superseded(creates, updates, keys, "created_timestamp_utc", "deleted_timestamp_utc").select(*keys).distinct()
    synced = syncs.select(MONTH, F.col("cloud_location_id").alias("source_location_id")).distinct()
    sources = live.join(synced, "source_location_id").withColumnRenamed("aggregate_location_id", "location_id")
    snap = cat("provider_location_snapshot_summary_month").filter("is_active_beginning_of_month")
    next_months = F.broadcast(months.select(MONTH, F.col("next_month").alias("snapshot_month_eastern")))
    direct = snap.join(next_months, "snapshot_month_eastern").select(MONTH, "provider_id", "location_id")
    via = direct.join(sources, [MONTH, "location_id"]).select(MONTH, "provider_id", F.col("source_location_id").alias("location_id"))
    return union_distinct(direct, via).groupBy(MONTH, "location_id").agg(F.count("provider_id").alias("total_num_of_providers"))


def report_active_locations_of_months(
    cat: SourceCatalog, months: Sequence[dt.date | str], pms: PmsSelector, activity: str = "day", history: DataFrame | None = None
) -> DataFrame:
    """The rows of ``report_active_locations`` for each of ``months``, with ``report_month``.

    Building runs Spark jobs: the chosen databases and the active syncs of all
    months are written once, as they are read several times.
    """
    calendar = month_table(cat, months)
    latest = latest_setting(cat("setting"), cat("practice_management_software"), value_type="int")
    chosen = reuse(latest.filter(S.pms_predicate(pms)))
    if history is None:
        history = mapping_history_flat(cat("setting"), sync_dbs=chosen)
    else:
        history = history.join(chosen.select("sync_db_id"), "sync_db_id", "left_semi")
    syncs = reuse(active_syncs_of_months(cat, history, calendar))
    practices = active_practices_of_months(cat, calendar, activity)
    per_location = providers_of_months(cat, syncs, calendar).withColumnRenamed("location_id", "_cloud_loc")
    loc = cat("location")
    primary = syncs.groupBy(MONTH, "cloud_practice_id").agg(F.min("location_id").alias("_primary"))
    phones = loc.select(
        F.col("monolith_provider_location_id").alias("_primary"), F.col("phone").alias("telephone_number"), F.col("fax").alias("fax_number")
    )
    contact = primary.join(phones, "_primary").select(MONTH, F.col("cloud_practice_id").alias("practice_id"), "telephone_number", "fax_number")
    sites = loc.filter(~F.col("is_virtual")).select(
        F.col("location_id").alias("_cloud_loc"), F.col("monolith_provider_location_id").alias("location_id"),
        F.col("address1").alias("address"), "city", "state", "zip_code",
    )
    mapped = syncs.select(MONTH, F.col("cloud_practice_id").alias("practice_id"), "location_id", "created_date_utc")
    body = (
        practices.join(mapped, [MONTH, "practice_id"]).join(sites, "location_id")
        .join(per_location, [MONTH, "_cloud_loc"]).join(contact, [MONTH, "practice_id"], "left")
    )
    return body.groupBy(
        MONTH, "practice_id", F.col("monolith_provider_id").alias("monolith_practice_id"), "name", "address", "city", "state",
        "zip_code", "telephone_number", "fax_number",
    ).agg(F.min("created_date_utc").alias("synced_date"), F.max("total_num_of_providers").alias("num_of_providers"))
