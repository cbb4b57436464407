"""Stand-ins for the reporting warehouse, derived from the test data.

The reports read twenty warehouse relations (event log, dimensions,
snapshots).  Those are not available here, so each one is derived with
DataFrame code from the generated TPC-H-ish tables, deterministically and
with the edge cases the reports must handle (malformed setting values,
deletes before creates, superseded mappings, NULL sync types, several
contacts per professional, ...).  ``accrualkit_oracle/fixtures_sql.py`` holds the
same derivations as portable SQL for the DuckDB cross-check.

Every derivation is a narrow projection/filter/aggregate over a whole base
table, so its size grows with the scale factor like the real tables.  The
modulo expressions derive attributes: event types that the operators have to
skip, malformed values, keys without a partner.  Where a stand-in takes some
event types of ``events`` only, another stand-in or key takes the others.  Two
stand-ins have no row for some base rows, since a missing partner is what they
are for: practices without a daily row and professionals without a contact.
Snapshot tables are fanned out over a handful of snapshot dates with
``explode`` (a generator, not a join).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import AGG_CREATE_TYPES, AGG_UPDATE_TYPES
from accrualkit.sources.testdata import BaseTables

# Fixed values of the stand-in data: snapshot months and days.
SNAPSHOT_MONTHS = (
    dt.date(2024, 1, 1),
    dt.date(2024, 2, 1),
    dt.date(2024, 3, 1),
    dt.date(2024, 4, 1),
    dt.date(2024, 5, 1),
)
SNAPSHOT_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3))

# Fixed values of the stand-in PMS dimension (ids and application names).
PMS_ROWS = (
    (10, "Nextech"),
    (11, "Eaglesoft"),
    (12, "EaglesoftCloud"),
    (13, "Denticon"),
    (14, "AllScriptsAPI"),
    (15, "Athena"),
    (16, "AthenaAPI"),
    (17, "CAPI_PrognoCIS"),
)

CREATE, BACKFILL_CREATE = AGG_CREATE_TYPES
UPDATE = AGG_UPDATE_TYPES[0]
#: Event types that no report reads.
OTHER_SETTING_EVENT, OTHER_MAPPING_EVENT = "Viewed", "review"


def _s(c: Column) -> Column:
    return c.cast("string")


def _ts(text: str) -> Column:
    """A TIMESTAMP_NTZ literal (the Parquet timestamps are zone-less)."""
    return F.lit(text).cast("timestamp_ntz")


def _floor_div(c: str | Column, d: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c / F.lit(d)).cast("bigint")


def _explode_dates(values) -> Column:
    return F.explode(F.array(*[F.lit(v) for v in values]))


def setting(b: BaseTables, fx) -> DataFrame:
    ev = b.events
    db = _floor_div("user_id", 3)
    location_events = ev.filter(F.col("event_type").isin("view", "click", "error")).select(
        F.lit(16).alias("setting_key_id"),
        _s(F.col("user_id")).alias("entity_id"),
        F.when(F.col("event_id") % 97 == 0, F.lit("n/a"))
        .otherwise(_s(_floor_div("user_id", 3)))
        .alias("setting_value"),
        F.when(F.col("event_type") == "view", "Added")
        .when(F.col("event_type") == "click", "Updated")
        .when(F.col("user_id") % 4 < 3, "Deleted")
        .otherwise(OTHER_SETTING_EVENT)
        .alias("event_type"),
        (F.col("ts") + F.make_dt_interval(days=(F.col("event_id") % 120).cast("int"))).alias("event_timestamp_utc"),
    )
    pms_events = ev.filter(F.col("event_type").isin("signup", "purchase")).select(
        F.lit(18).alias("setting_key_id"),
        _s(db).alias("entity_id"),
        F.when(F.col("event_id") % 89 == 0, F.lit("n/a")).otherwise(_s(F.lit(10) + F.col("event_id") % 8)).alias("setting_value"),
        F.when(F.col("event_type") == "signup", "Added").otherwise("Updated").alias("event_type"),
        # some databases log whole days only, so their latest events tie
        F.when(db % 5 == 0, F.date_trunc("day", "ts").cast("timestamp_ntz")).otherwise(F.col("ts")).alias("event_timestamp_utc"),
    )
    return location_events.unionByName(pms_events)


def practice_management_software(b: BaseTables, fx) -> DataFrame:
    return b.spark.createDataFrame(list(PMS_ROWS), "pms_id int, pms_application string")


def practice(b: BaseTables, fx) -> DataFrame:
    s = b.supplier
    return s.select(
        _s(F.col("s_suppkey")).alias("practice_id"),
        F.col("s_suppkey").alias("monolith_provider_id"),
        F.col("s_name").alias("name"),
        (F.col("s_suppkey") % 25 == 24).alias("is_test"),
    )


def location(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")
    geo = b.nation.join(b.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return b.customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("L"), _s(c)).alias("location_id"),
        _s(c).alias("monolith_provider_location_id"),
        _s(_floor_div(c * 2, 3)).alias("practice_id"),
        F.concat(F.lit("addr "), F.col("c_name")).alias("address1"),
        F.lit(None).cast("string").alias("address2"),
        F.lit(None).cast("string").alias("address3"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        _s(F.lit(10000) + c % 90000).alias("zip_code"),
        F.concat(F.lit("T"), _s(c)).alias("phone"),
        F.when(c % 3 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("F"), _s(c))).alias("fax"),
        F.when(c % 3 == 0, F.lit("RainTree v2")).when(c % 3 == 1, F.lit("other")).alias("software"),
        (c % 11 == 10).alias("is_virtual"),
    )


def provider(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")
    return b.customer.select(
        F.concat(F.lit("P"), _s(c)).alias("provider_id"),
        # some professionals are unknown, some are listed twice
        F.when(c % 13 == 5, F.lit(None).cast("bigint")).when(c % 17 == 3, c - 1).otherwise(c).alias("monolith_professional_id"),
        _s(_floor_div(c, 15)).alias("practice_id"),
        _floor_div(c, 15).alias("monolith_provider_id"),
        F.concat(F.lit("F"), _s(c)).alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.when(c % 2 == 0, "MD").otherwise("DDS").alias("title"),
        _s(F.lit(1000000000) + c).alias("npi"),
        F.concat(F.lit("Practice "), _s(_floor_div(c, 15))).alias("practice_name"),
        F.when(c % 7 == 0, _ts(None)).otherwise(_ts("2023-01-01 00:00:00")).alias("latest_activation_start_timestamp_utc"),
        # in every ninth practice all providers have ended
        F.when((c % 5 == 0) | (_floor_div(c, 15) % 9 == 4), _ts("2024-03-15 00:00:00"))
        .otherwise(_ts(None))
        .alias("latest_activation_end_timestamp_utc"),
        (c % 40 == 39).alias("is_resource"),
        (c % 50 == 49).alias("is_test"),
        F.when(c % 10 == 3, "LiteProfile").otherwise("FullProfile").alias("profile_type"),
        F.when(c % 9 == 1, "Pending").otherwise("Approved Application").alias("status"),
        (c % 4 != 1).alias("is_bookable"),
        (c % 4 != 2).alias("is_bookable_legacy"),
    )


def practice_snapshot_summary_month(b: BaseTables, fx) -> DataFrame:
    return b.supplier.select(
        _s(F.col("s_suppkey")).alias("practice_id"), _explode_dates(SNAPSHOT_MONTHS).alias("snapshot_month_eastern"), "s_suppkey"
    ).select(
        "practice_id",
        "snapshot_month_eastern",
        ((F.col("s_suppkey") + F.month("snapshot_month_eastern")) % 6).cast("int").alias("days_in_month_active"),
    )


def provider_location_snapshot_summary_month(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")
    return b.customer.select(c, _explode_dates(SNAPSHOT_MONTHS).alias("m")).select(
        F.concat(F.lit("P"), _s(c)).alias("provider_id"),
        F.concat(F.when(c % 4 == 0, F.lit("A")).otherwise(F.lit("L")), _s(_floor_div(c, 10))).alias("location_id"),
        F.col("m").alias("snapshot_month_eastern"),
        ((c + F.month("m")) % 3 != 0).alias("is_active_beginning_of_month"),
    )


def aggregate_location_mapping_update(b: BaseTables, fx) -> DataFrame:
    ev = b.events
    u = F.col("user_id")
    creates = ev.filter(F.col("event_type") == "signup").select(
        F.concat(F.lit("A"), _s(u)).alias("aggregate_location_id"),
        F.concat(F.lit("L"), _s(u)).alias("source_location_id"),
        F.when(u % 2 == 1, OTHER_MAPPING_EVENT)
        .when(F.col("event_id") % 5 == 0, BACKFILL_CREATE)
        .otherwise(CREATE)
        .alias("event_update_type"),
        F.col("ts").alias("created_timestamp_utc"),
        _ts(None).alias("deleted_timestamp_utc"),
    )
    updates = ev.filter(F.col("event_type") == "purchase").select(
        F.concat(F.lit("A"), _s(u)).alias("aggregate_location_id"),
        F.concat(F.lit("L"), _s(u)).alias("source_location_id"),
        F.when(u % 4 == 0, UPDATE).otherwise(OTHER_MAPPING_EVENT).alias("event_update_type"),
        _ts(None).alias("created_timestamp_utc"),
        F.col("ts").alias("deleted_timestamp_utc"),
    )
    return creates.unionByName(updates)


def practice_snapshot_summary_day(b: BaseTables, fx) -> DataFrame:
    return (
        fx("practice_snapshot_summary_month")
        # the daily table has no row where a practice had no day yet: the reports' semi join must drop those
        .filter(F.col("days_in_month_active") != 1)
        .select("practice_id", F.col("snapshot_month_eastern").alias("snapshot_date_eastern"))
    )


def provider_explorer_day_week_vw(b: BaseTables, fx) -> DataFrame:
    top = F.col("max_key")
    return (
        b.orders.groupBy(F.col("o_custkey"), F.col("o_orderdate").cast("date").alias("snapshot_date_eastern"))
        .agg(F.max("o_orderkey").alias("max_key"), F.min("o_orderkey").alias("min_key"))
        .select(
            F.concat(F.lit("P"), _s(F.col("o_custkey"))).alias("provider_id"),
            "snapshot_date_eastern",
            F.when(top % 2 == 0, "Read/Write").otherwise("Read Only").alias("sync_type"),
            F.concat(F.lit("seg"), _s(top % 3)).alias("account_segment"),
            F.concat(F.lit("cur"), _s(top % 4)).alias("current_account_segment"),
            (top % 2 == 0).alias("bookable_status"),
            (top % 5 != 0).alias("bookable_status_beginning_of_week"),
            (F.col("min_key") % 2 == 0).alias("was_ever_previously_mp_bookable"),
            (top % 60).alias("provider_tenure_months"),
        )
    )


def opportunity_index(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")
    d = F.col("d")
    return b.customer.select(c, "c_mktsegment", _explode_dates(SNAPSHOT_DAYS).alias("d")).select(
        d.alias("snapshot_date_est"),
        _s(_floor_div(c, 15)).alias("practice_id"),
        _floor_div(c, 15).alias("monolith_practice_id"),
        F.concat(F.lit("P"), _s(c)).alias("provider_id"),
        c.alias("monolith_professional_id"),
        F.col("c_mktsegment").alias("main_specialty"),
        ((c + F.dayofmonth(d)) % 5 != 0).alias("is_active"),
        (c % 6 != 0).alias("is_currently_synced"),
        F.when(c % 7 == 0, _ts(None)).otherwise(_ts("2023-01-01 00:00:00")).alias("latest_activation_start_timestamp_utc"),
        F.when(c % 5 == 0, _ts("2024-03-15 00:00:00")).otherwise(_ts(None)).alias("latest_activation_end_timestamp_utc"),
        F.when(c % 6 == 0, F.lit(None).cast("bigint")).otherwise(c).alias("sync_id"),
        F.when(c % 6 == 1, "Read/Write")
        .when(c % 6 == 2, "Read/Write/Track")
        .when(c % 6 == 3, "Read Only")
        .when(c % 6 == 4, "Manual")
        .alias("sync_type"),
        F.when((c % 6).isin(0, 5), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("pms"), _s(c % 3)))
        .alias("synced_practice_management_system"),
        F.concat(F.lit("listed"), _s(c % 4)).alias("practice_management_system_listed_on_dsp"),
        ((c * 7 + F.dayofmonth(d)) % 30).alias("number_of_new_patient_timeslots_28_days"),
        ((c * 3 + F.dayofmonth(d)) % 30).alias("number_of_existing_patient_timeslots_28_days"),
    )


def contact_vw(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")

    def contacts(pred: Column, prefix: str) -> DataFrame:
        return b.customer.filter(pred).select(
            c.alias("professional_id__c"),
            _floor_div(c, 15).alias("provider_id__c"),
            F.concat(F.lit("F"), _s(c)).alias("firstname"),
            F.col("c_name").alias("lastname"),
            F.concat(F.lit(prefix), _s(c), F.lit("@x.example")).alias("email"),
            F.concat(F.lit("ph"), _s(c)).alias("phone"),
            F.when(c % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("mob"), _s(c))).alias("mobilephone"),
        )

    # two thirds of the professionals have a contact, some two: the left join must keep the others
    return contacts(c % 3 != 0, "a").unionByName(contacts(c % 10 == 1, "b"))


def sync_overview_vw(b: BaseTables, fx) -> DataFrame:
    m = F.col("monolith_provider_location_id").try_cast("bigint")
    return fx("location").select(
        "location_id",
        F.when(m % 4 == 0, "CernerMillenniumAPI").when(m % 4 == 1, "CernerMillenniumR4").otherwise("Other").alias("pms_application"),
        F.when(m % 2 == 0, "Read/Write").otherwise("Manual").alias("sync_type"),
        (_ts("2024-01-01 00:00:00") + F.make_dt_interval(hours=m.cast("int"))).alias("most_recent_sync_timestamp_utc"),
    )


def provider_location_mapping(b: BaseTables, fx) -> DataFrame:
    c = F.col("c_custkey")
    return b.customer.select(
        F.concat(F.lit("P"), _s(c)).alias("provider_id"),
        F.concat(F.lit("L"), _s(_floor_div(c, 10))).alias("location_id"),
        (c % 8 != 7).alias("is_active"),
        F.when(c % 6 == 5, "Pending").otherwise("Approved").alias("approval_status"),
    )


def practice_parent_entity_mapping_vw(b: BaseTables, fx) -> DataFrame:
    return b.supplier.select(
        _s(F.col("s_suppkey")).alias("practice_id"),
        F.concat(F.lit("Entity "), _s(F.col("s_nationkey"))).alias("parent_entity_name"),
    )


def appointment_summary(b: BaseTables, fx) -> DataFrame:
    e = F.col("event_id")
    # spread over the turn of the month, some exactly at midnight: the reports' bounds differ there
    at = F.col("ts") + F.make_dt_interval(days=(e % 4).cast("int"))
    at = F.when(e % 7 == 0, F.date_trunc("day", at).cast("timestamp_ntz")).otherwise(at)
    return b.events.filter(F.col("event_type").isin("purchase", "click")).select(
        e.alias("appointment_id"),
        F.concat(F.lit("P"), _s(F.col("user_id") * 10 + e % 10)).alias("provider_id"),
        at.alias("appointment_created_timestamp_local"),
        (e % 2 == 0).alias("is_premium_booking"),
    )


def _provider_key() -> Column:
    return F.substr(F.col("provider_id"), F.lit(2)).try_cast("bigint")


def provider_location_availability_summary_day(b: BaseTables, fx) -> DataFrame:
    return fx("provider").select("provider_id", "practice_id", _explode_dates(SNAPSHOT_DAYS).alias("snapshot_date_eastern")).select(
        "provider_id",
        "practice_id",
        "snapshot_date_eastern",
        (_provider_key() % 3 != 0).alias("has_availability"),
        F.concat(F.lit("spec"), _s(_provider_key() % 5)).alias("main_specialty"),
    )


def provider_location_sync_summary_day_vw(b: BaseTables, fx) -> DataFrame:
    return fx("provider").select("provider_id", _explode_dates(SNAPSHOT_DAYS).alias("snapshot_date_eastern")).select(
        "provider_id",
        "snapshot_date_eastern",
        F.when(_provider_key() % 3 == 0, "Read/Write").when(_provider_key() % 3 == 1, "Manual").alias("sync_type"),
    )


def provider_location_sync_snapshot_day_new(b: BaseTables, fx) -> DataFrame:
    k = F.col("o_orderkey") % 40
    mix = _floor_div("o_custkey", 15) + k
    return b.orders.select(
        F.concat(F.lit("P"), _s(F.col("o_custkey"))).alias("provider_id"),
        F.date_add(F.lit(dt.date(2023, 12, 1)), k.cast("int")).alias("snapshot_date_eastern"),
        F.when(mix % 3 == 0, "Dentrix").when(mix % 3 == 1, "DentrixG5").otherwise("Nextech").alias("sync_pms"),
        F.when(mix % 2 == 0, "Read/Write").otherwise("Read Only").alias("sync_type"),
    )


def practice_derived_metrics(b: BaseTables, fx) -> DataFrame:
    s = F.col("s_suppkey")
    return b.supplier.select(
        _s(s).alias("practice_id"),
        F.col("s_name").alias("practice_name"),
        F.concat(F.lit("L"), _s(_floor_div(s * 3, 2))).alias("first_location_id"),
        F.concat(F.lit("seg"), _s(s % 4)).alias("account_segment"),
    )


FIXTURES: dict[str, Callable[[BaseTables, Callable[[str], DataFrame]], DataFrame]] = {
    "setting": setting,
    "practice_management_software": practice_management_software,
    "practice": practice,
    "location": location,
    "provider": provider,
    "practice_snapshot_summary_month": practice_snapshot_summary_month,
    "provider_location_snapshot_summary_month": provider_location_snapshot_summary_month,
    "aggregate_location_mapping_update": aggregate_location_mapping_update,
    "practice_snapshot_summary_day": practice_snapshot_summary_day,
    "provider_explorer_day_week_vw": provider_explorer_day_week_vw,
    "opportunity_index": opportunity_index,
    "contact_vw": contact_vw,
    "sync_overview_vw": sync_overview_vw,
    "provider_location_mapping": provider_location_mapping,
    "practice_parent_entity_mapping_vw": practice_parent_entity_mapping_vw,
    "appointment_summary": appointment_summary,
    "provider_location_availability_summary_day": provider_location_availability_summary_day,
    "provider_location_sync_summary_day_vw": provider_location_sync_summary_day_vw,
    "provider_location_sync_snapshot_day_new": provider_location_sync_snapshot_day_new,
    "practice_derived_metrics": practice_derived_metrics,
}
