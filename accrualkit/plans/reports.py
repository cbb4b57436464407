"""The seven sync-accrual reports.

Each report is a function ``(catalog, parameters) -> DataFrame``.  The plan
is declarative; where the original query shape multiplies rows before an
aggregate (a star join feeding COUNT DISTINCT / MAX), the report reduces
each input to what it contributes *before* joining.  Results are the same;
intermediate sizes grow with the inputs instead of with their product.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import (  # noqa: F401  (re-exported for callers)
    APPROVED,
    BOOKING_BUCKET,
    CERNER_APPLICATIONS,
    DENTRIX_PMS,
    MANUAL_SYNC,
    NO_AVAILABILITY_BUCKET,
    RAINTREE_PATTERN,
)
from accrualkit.functions.dates import at_midnight, date_lit
from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.event_log import latest_setting, mapping_history_collapsed, mapping_history_flat
from accrualkit.operators.joins import mark_members
from accrualkit.operators.temporal import currently_active, valid_at
from accrualkit.params import DateWindow, PmsSelector, ReportMonth, as_date
from accrualkit.plans import roster as R
from accrualkit.plans import syncs as S
from accrualkit.plans.materialize import reuse
from accrualkit.sources.catalog import SourceCatalog


# --------------------------------------------------------------------- R1
def report_api_practices(
    cat: SourceCatalog,
    pms_applications: Sequence[str],
    history: DataFrame | None = None,
    pms_latest: DataFrame | None = None,
) -> DataFrame:
    """Practices synced through the given API PMS applications.

    One row per (practice, PMS application): active providers, first sync,
    locations still synced and — once none is — the desync date.

    The provider count is computed per practice on its own and joined to
    the per-practice aggregate, instead of joining every provider to every
    mapping row before counting.  ``history`` (collapsed mapping history)
    and ``pms_latest`` (``latest_setting`` with BIGINT values) may be passed
    precomputed, e.g. shared by all runs of a month.

    Building runs Spark jobs: the chosen databases and the mapping rows of the
    report are written once, as they are read several times.
    """
    setting = cat("setting")
    if pms_latest is None:
        pms_latest = latest_setting(setting, cat("practice_management_software"), value_type="bigint")
    dbs = reuse(
        pms_latest.filter(F.col("pms_application").isin(*pms_applications))
        .select(F.col("sync_db_id").alias("_db"), "pms_application")
        .distinct()
    )
    if history is None:
        history = mapping_history_collapsed(setting, dbs.select(F.col("_db").alias("sync_db_id")))
    # Mapping rows of the selected PMS: read twice (rows to report and the
    # still-synced location set), so materialised once.
    mapped = reuse(
        history.join(dbs, history["sync_db_id"] == dbs["_db"]).select(
            "sync_db_id", "location_id", "created_date_utc", "deleted_date_utc", "pms_application"
        )
    )
    loc = cat("location").select(
        F.col("monolith_provider_location_id").alias("_mono"), F.col("practice_id").alias("_loc_practice")
    )
    pt = cat("practice").filter(~F.col("is_test")).select(
        "practice_id", F.col("monolith_provider_id").alias("monolith_practice_id"), F.col("name").alias("practice_name")
    )
    base = mapped.join(loc, mapped["location_id"] == loc["_mono"]).join(pt, F.col("_loc_practice") == pt["practice_id"])
    still = mapped.filter(F.col("deleted_date_utc").isNull()).select("location_id")
    marked = mark_members(base, still, "location_id", "location_id", "_still_loc")
    per_practice = marked.groupBy("practice_id", "monolith_practice_id", "practice_name", "pms_application").agg(
        F.min("created_date_utc").alias("initial_synced_date"),
        F.count_distinct("_still_loc").alias("num_locations_still_synced"),
        F.max("deleted_date_utc").alias("_last_delete"),
    )
    providers = (
        cat("provider")
        .filter(currently_active("latest_activation_start_timestamp_utc", "latest_activation_end_timestamp_utc"))
        .groupBy(F.col("practice_id").alias("_pv_practice"))
        .agg(F.count_distinct("provider_id").alias("_n_providers"))
    )
    out = per_practice.join(providers, per_practice["practice_id"] == providers["_pv_practice"], "left")
    return out.select(
        "practice_id",
        "monolith_practice_id",
        "practice_name",
        "pms_application",
        F.coalesce("_n_providers", F.lit(0)).alias("num_active_providers"),
        "initial_synced_date",
        "num_locations_still_synced",
        S.desync_date(F.col("num_locations_still_synced"), F.col("_last_delete")).alias("desync_date"),
    ).orderBy(F.col("initial_synced_date").desc())


# --------------------------------------------------------------------- R2
def report_active_locations(
    cat: SourceCatalog,
    month: dt.date | str,
    pms: PmsSelector,
    activity: str = "day",
    history: DataFrame | None = None,
    pms_latest: DataFrame | None = None,
) -> DataFrame:
    """Actively synced, non-virtual locations of active practices for a month.

    Practice activity is tested on the month start, sync and provider
    activity at the start of the next month.  One row per practice and
    location address, with phone/fax of the practice's primary location,
    the first sync date and the number of active providers at the location.
    ``history`` (flat mapping history) and ``pms_latest`` (``latest_setting``
    with INT values) may be passed precomputed.

    Building runs Spark jobs: the chosen databases and the active syncs are
    written once, as they are read several times.
    """
    m = ReportMonth.of(month)
    boundary = at_midnight(m.next_start)
    if history is None:
        if pms_latest is None:
            pms_latest = latest_setting(cat("setting"), cat("practice_management_software"), value_type="int")
        pms_latest = reuse(pms_latest.filter(S.pms_predicate(pms)))
        history = mapping_history_flat(cat("setting"), sync_dbs=pms_latest)
    # Read three times (report rows, live aggregate mappings, primary
    # location), so materialised once.
    syncs = reuse(S.active_syncs_as_of(cat, history, pms, boundary, pms_latest=pms_latest))
    practices = S.active_practices(cat, m, activity)
    live = S.live_aggregate_mappings(cat, syncs)
    per_location = S.providers_per_location(S.active_provider_locations(cat, m, live))
    contact = S.primary_location_contact(cat, syncs)
    loc = cat("location").filter(~F.col("is_virtual")).select(
        F.col("location_id").alias("_cloud_loc"),
        F.col("monolith_provider_location_id").alias("_mono"),
        F.col("address1").alias("address"),
        "city",
        "state",
        "zip_code",
    )
    body = (
        practices.join(syncs.select("cloud_practice_id", "location_id", "created_date_utc"),
                       practices["practice_id"] == F.col("cloud_practice_id"))
        .join(loc, F.col("location_id") == loc["_mono"])
        .join(per_location.withColumnRenamed("location_id", "_apl_loc"), F.col("_cloud_loc") == F.col("_apl_loc"))
        .join(contact.withColumnRenamed("cloud_practice_id", "_contact_practice"),
              F.col("practice_id") == F.col("_contact_practice"), "left")
    )
    return body.groupBy(
        "practice_id",
        F.col("monolith_provider_id").alias("monolith_practice_id"),
        "name",
        "address",
        "city",
        "state",
        "zip_code",
        "telephone_number",
        "fax_number",
    ).agg(
        F.min("created_date_utc").alias("synced_date"),
        F.max("total_num_of_providers").alias("num_of_providers"),
    )


# --------------------------------------------------------------------- R3
def latest_synced_pms_per_practice(
    cat: SourceCatalog, window: DateWindow, pms_names: Sequence[str] = DENTRIX_PMS
) -> DataFrame:
    """Latest daily sync snapshot per practice within ``window`` for the PMS."""
    snap = cat("provider_location_sync_snapshot_day_new").filter(
        F.col("snapshot_date_eastern").between(date_lit(window.start), date_lit(window.end))
        & F.col("sync_pms").isin(*pms_names)
    )
    pv = cat("provider").select(F.col("provider_id").alias("_pv"), "practice_id")
    rows = snap.join(pv, snap["provider_id"] == pv["_pv"]).select(
        "practice_id", "snapshot_date_eastern", "sync_pms", "sync_type"
    )
    return top1_per_group(rows, ["practice_id"], ["snapshot_date_eastern"], ["sync_pms", "sync_type"]).drop(
        "snapshot_date_eastern"
    )


def report_synced_addresses(
    cat: SourceCatalog, window: DateWindow, pms_names: Sequence[str] = DENTRIX_PMS, latest: DataFrame | None = None
) -> DataFrame:
    """Address and segment of each practice synced to the PMS in ``window``.

    ``latest`` may pass a materialised latest-sync table (the reference
    builds it as a session temp table first); by default it is planned inline.
    """
    if latest is None:
        latest = latest_synced_pms_per_practice(cat, window, pms_names)
    pdm = cat("practice_derived_metrics").select(
        F.col("practice_id").alias("_pdm_practice"), "practice_name", "first_location_id", "account_segment"
    )
    loc = cat("location").select("location_id", "address1", "address2", "address3", "city", "state", "zip_code", "phone")
    return (
        latest.join(pdm, latest["practice_id"] == pdm["_pdm_practice"])
        .join(loc, pdm["first_location_id"] == loc["location_id"])
        .select(
            "practice_id",
            "practice_name",
            "address1",
            "address2",
            "address3",
            "city",
            "state",
            "zip_code",
            "phone",
            "account_segment",
            "sync_pms",
            "sync_type",
        )
    )


# --------------------------------------------------------------------- R4
def report_provider_roster(
    cat: SourceCatalog,
    bookable_flag: str = "is_bookable_legacy",
    with_npi: bool = False,
    explorer: DataFrame | None = None,
    opportunity: DataFrame | None = None,
) -> DataFrame:
    """Bookable provider roster with segment, opportunity and CRM contacts.

    Contacts are a left join (several contacts per professional fan out;
    written fan-out-safe, see ``fanout_left_join``); ``with_npi`` adds NPI
    and practice name through an *inner* lookup.  ``explorer`` /
    ``opportunity`` may pass the precomputed latest snapshot rows.
    """
    # One row per roster provider: materialised once, read by both halves of
    # the fan-out-safe contact join.
    enriched = reuse(
        R.provider_enrichment(cat, R.bookable_provider_roster(cat, bookable_flag), explorer, opportunity)
    )
    rows = R.with_contacts(cat, enriched, include_crm_practice_id=with_npi)
    if with_npi:
        npi = R.npi_lookup(cat)
        rows = rows.join(npi, rows["docter_id"] == npi["_npi_prof"]).drop("_npi_prof")
    return R.roster_labels(rows.distinct())


# --------------------------------------------------------------------- R5
def report_parent_entities(cat: SourceCatalog, pms_applications: Sequence[str] = CERNER_APPLICATIONS) -> DataFrame:
    """First sync and active provider count per parent entity and PMS."""
    so = cat("sync_overview_vw").filter(F.col("pms_application").isin(*pms_applications)).select(
        F.col("location_id").alias("_so_loc"), "pms_application", "most_recent_sync_timestamp_utc"
    )
    plm = cat("provider_location_mapping").filter(
        F.col("is_active") & (F.col("approval_status") == APPROVED)
    ).select(F.col("location_id").alias("_plm_loc"), F.col("provider_id").alias("_plm_provider"))
    pv = cat("provider").filter(
        ~F.col("is_test") & currently_active("latest_activation_start_timestamp_utc", "latest_activation_end_timestamp_utc")
    ).select("provider_id", F.col("practice_id").alias("_pv_practice"))
    ent = cat("practice_parent_entity_mapping_vw").select(F.col("practice_id").alias("_ent_practice"), "parent_entity_name")
    return (
        so.join(plm, so["_so_loc"] == plm["_plm_loc"])
        .join(pv, plm["_plm_provider"] == pv["provider_id"])
        .join(ent, pv["_pv_practice"] == ent["_ent_practice"])
        .groupBy("parent_entity_name", "pms_application")
        .agg(
            F.min("most_recent_sync_timestamp_utc").alias("initial_synced_date"),
            F.count_distinct("provider_id").alias("active_providers_on_sync"),
        )
    )


# --------------------------------------------------------------------- R6
def report_bookings(
    cat: SourceCatalog, month_start: dt.date | str, month_end: dt.date | str, software_pattern: str = RAINTREE_PATTERN
) -> DataFrame:
    """Providers of matching-software locations with premium bookings.

    Bookings are counted between the two bounds (both at midnight, so the
    last day itself is excluded after 00:00), slot peaks are taken over the
    opportunity snapshots of the first two days of the month.

    Each fact source is aggregated on its own join key first (slots per
    professional, bookings per provider) and only the per-provider results
    meet the location/practice/sync rows — the original star join multiplied
    every booking by every snapshot row and every location before counting.
    """
    start, end = as_date(month_start), as_date(month_end)
    end_ts = at_midnight(end)
    pl = cat("location").filter(F.col("software").ilike(software_pattern)).select("location_id")
    plm = cat("provider_location_mapping").select(F.col("location_id").alias("_plm_loc"), F.col("provider_id").alias("_plm_provider"))
    pp = cat("provider").filter(valid_at("latest_activation_start_timestamp_utc", "latest_activation_end_timestamp_utc", end_ts)).select(
        "provider_id", "first_name", "last_name", F.col("practice_id").alias("_pp_practice"), "monolith_professional_id"
    )
    pr = cat("practice").select(F.col("practice_id").alias("_pr_practice"), "name")
    so = cat("sync_overview_vw").select(F.col("location_id").alias("_so_loc"), "sync_type")
    providers = (
        pl.join(plm, pl["location_id"] == plm["_plm_loc"])
        .join(pp, plm["_plm_provider"] == pp["provider_id"])
        .join(pr, pp["_pp_practice"] == pr["_pr_practice"])
        .join(so, pl["location_id"] == so["_so_loc"])
        .select("provider_id", "first_name", "last_name", "name", "sync_type", "monolith_professional_id")
        .distinct()
    )
    slots = (
        cat("opportunity_index")
        .filter(F.col("snapshot_date_est").between(date_lit(start), F.date_add(date_lit(start), 1)))
        .groupBy(F.col("monolith_professional_id").alias("_oi_prof"))
        .agg(
            F.max("number_of_new_patient_timeslots_28_days").alias("_np"),
            F.max("number_of_existing_patient_timeslots_28_days").alias("_ep"),
        )
    )
    bookings = (
        cat("appointment_summary")
        .filter(
            F.col("appointment_created_timestamp_local").between(at_midnight(start), end_ts)
            & (F.col("is_premium_booking") == F.lit(True))
        )
        .groupBy(F.col("provider_id").alias("_app_provider"))
        .agg(F.count_distinct("appointment_id").alias("_n_bookings"))
    )
    return (
        providers.join(slots, providers["monolith_professional_id"] == slots["_oi_prof"])
        .join(bookings, providers["provider_id"] == bookings["_app_provider"])
        .groupBy("provider_id", "first_name", "last_name", "name", "sync_type")
        .agg(
            F.max("_np").alias("npslots"),
            F.max("_ep").alias("epslots"),
            F.max("_n_bookings").alias("npbookingcount"),
        )
        .withColumn("bucket", F.lit(BOOKING_BUCKET))
        .orderBy(F.col("provider_id").desc())
    )


# --------------------------------------------------------------------- R7
def report_no_availability(
    cat: SourceCatalog,
    since: dt.date | str,
    software_pattern: str = RAINTREE_PATTERN,
    excluded_provider_ids: Sequence[str | int] | DataFrame | None = None,
) -> DataFrame:
    """Integrated (non-manual sync) providers without availability.

    ``excluded_provider_ids`` is either a short literal list (NOT IN, compared
    as text; empty strings and None exclude nothing) or a
    DataFrame with a ``provider_id`` column (anti join; e.g. the providers
    who already had appointments).

    The original joins every availability day to every location of the
    practice and to every sync-summary day of the provider, then DISTINCTs.
    Here each input is first reduced to the DISTINCT columns it contributes
    (matching practices, per-provider sync types), then joined.
    """
    asd = (
        cat("provider_location_availability_summary_day")
        .filter((F.col("snapshot_date_eastern") > date_lit(since)) & ~F.col("has_availability"))
        .select("provider_id", "practice_id", "main_specialty")
        .distinct()
    )
    practices = (
        cat("location")
        .filter(F.col("software").ilike(software_pattern))
        .select(F.col("practice_id").alias("_pl_practice"))
        .distinct()
    )
    asd = asd.join(practices, asd["practice_id"] == practices["_pl_practice"], "left_semi")
    pp = cat("provider").select(
        F.col("provider_id").alias("_pp"), "first_name", "last_name", "title", "npi", "practice_name"
    )
    ssd = (
        cat("provider_location_sync_summary_day_vw")
        .filter(F.col("sync_type") != MANUAL_SYNC)
        .select(F.col("provider_id").alias("_ssd"), "sync_type")
        .distinct()
    )
    rows = asd.join(pp, asd["provider_id"] == pp["_pp"]).join(ssd, asd["provider_id"] == ssd["_ssd"])
    if isinstance(excluded_provider_ids, DataFrame):
        # distinct keys first: a partial aggregation shrinks the excluded side
        # (e.g. one row per booked provider, not per booking) before the shuffle
        ex = excluded_provider_ids.select(F.col("provider_id").alias("_ex")).distinct()
        rows = rows.join(ex, rows["provider_id"] == ex["_ex"], "left_anti")
    else:
        listed = [str(x) for x in excluded_provider_ids or () if x is not None and x != ""]
        if listed:
            rows = rows.filter(~F.col("provider_id").cast("string").isin(*listed))
    return rows.select(
        "provider_id",
        "practice_id",
        "first_name",
        "last_name",
        "title",
        "npi",
        "main_specialty",
        "practice_name",
        F.lit(NO_AVAILABILITY_BUCKET).alias("bucket"),
        "sync_type",
    ).distinct()
