"""Building blocks of the provider roster report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.constants import APPROVED_STATUSES, FULL_PROFILE
from accrualkit.functions.labels import resolve_pms, sync_type_label
from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.joins import fanout_left_join
from accrualkit.operators.temporal import currently_active
from accrualkit.sources.catalog import SourceCatalog


def bookable_provider_roster(cat: SourceCatalog, bookable_flag: str = "is_bookable_legacy") -> DataFrame:
    """Active, non-resource, non-test, full-profile, approved, bookable providers.

    ``bookable_flag`` names the flag column that decides bookability
    (``is_bookable_legacy`` or ``is_bookable``).  Output uses the roster's
    column names.
    """
    pv = cat("provider")
    eligible = (
        currently_active("latest_activation_start_timestamp_utc", "latest_activation_end_timestamp_utc")
        & ~F.col("is_resource")
        & ~F.col("is_test")
        & (F.col("profile_type") == FULL_PROFILE)
        & F.col("status").isin(*APPROVED_STATUSES)
        & F.col(bookable_flag)
    )
    return pv.filter(eligible).select(
        F.col("provider_id").alias("c_docter_id"),
        F.col("monolith_professional_id").alias("docter_id"),
        "status",
        F.col("monolith_provider_id").alias("d_practice_id"),
        F.col("practice_id").alias("c_practice_id"),
        "first_name",
        "last_name",
        "title",
        "latest_activation_start_timestamp_utc",
        "latest_activation_end_timestamp_utc",
    )


def latest_explorer_row(cat: SourceCatalog) -> DataFrame:
    """Latest provider-explorer snapshot per provider."""
    ex = cat("provider_explorer_day_week_vw").select(
        "snapshot_date_eastern",
        F.col("provider_id").alias("c_docter_id"),
        "sync_type",
        "account_segment",
        "current_account_segment",
        "bookable_status",
        "provider_tenure_months",
        "bookable_status_beginning_of_week",
        "was_ever_previously_mp_bookable",
    )
    return top1_per_group(ex, ["c_docter_id"], ["snapshot_date_eastern"], rank_col="rownum")


def latest_active_opportunity_row(cat: SourceCatalog) -> DataFrame:
    """Latest opportunity-index row per provider, kept only if that row is active.

    The activity flag is tested *after* ranking: a provider whose latest row
    is inactive disappears rather than falling back to an older active row.
    """
    oi = cat("opportunity_index").select(
        "snapshot_date_est",
        "practice_id",
        "monolith_practice_id",
        "provider_id",
        "monolith_professional_id",
        "main_specialty",
        "is_active",
        "is_currently_synced",
        "latest_activation_start_timestamp_utc",
        F.col("latest_activation_end_timestamp_utc").isNull().alias("activation_open"),
        "sync_id",
        "sync_type",
        "practice_management_system_listed_on_dsp",
        "synced_practice_management_system",
    )
    latest = top1_per_group(oi, ["provider_id"], ["snapshot_date_est"], rank_col="rownum")
    return latest.filter(F.col("is_active"))


def provider_enrichment(
    cat: SourceCatalog, roster: DataFrame, explorer: DataFrame | None = None, opportunity: DataFrame | None = None
) -> DataFrame:
    """Roster ⟕ latest explorer row ⟕ latest active opportunity row.

    Both right sides hold one row per provider, so nothing is multiplied and
    a DISTINCT belongs only at the end of the report.

    ``explorer`` / ``opportunity`` may pass precomputed results of
    ``latest_explorer_row`` / ``latest_active_opportunity_row`` (one row per
    provider), e.g. shared by both roster runs of a month.
    """
    ex = explorer if explorer is not None else latest_explorer_row(cat)
    with_segment = roster.join(ex, "c_docter_id", "left").select(
        "c_docter_id",
        "docter_id",
        "d_practice_id",
        "c_practice_id",
        "first_name",
        "last_name",
        "title",
        "current_account_segment",
        "account_segment",
        "bookable_status",
        "provider_tenure_months",
        "bookable_status_beginning_of_week",
        "was_ever_previously_mp_bookable",
    )
    ov = opportunity if opportunity is not None else latest_active_opportunity_row(cat)
    return (
        with_segment.join(ov, with_segment["c_docter_id"] == ov["provider_id"], "left")
        .select(
            "c_docter_id",
            "docter_id",
            "d_practice_id",
            "c_practice_id",
            "first_name",
            "last_name",
            "title",
            "current_account_segment",
            "main_specialty",
            "is_active",
            "is_currently_synced",
            "sync_id",
            "sync_type",
            "practice_management_system_listed_on_dsp",
            "synced_practice_management_system",
            "bookable_status",
            "provider_tenure_months",
            "bookable_status_beginning_of_week",
            "was_ever_previously_mp_bookable",
        )
    )


def crm_contacts(cat: SourceCatalog) -> DataFrame:
    return cat("contact_vw").select(
        F.col("provider_id__c").alias("contact_practice_id"),
        "professional_id__c",
        "firstname",
        "lastname",
        "email",
        "phone",
        "mobilephone",
        "provider_id__c",
    )


CONTACT_ROW_HEAD = (
    "c_docter_id",
    "docter_id",
    "d_practice_id",
    "c_practice_id",
    "first_name",
    "last_name",
    "title",
    "email",
    "phone",
    "mobilephone",
)
CONTACT_ROW_TAIL = (
    "current_account_segment",
    "main_specialty",
    "is_active",
    "is_currently_synced",
    "sync_id",
    "sync_type",
    "practice_management_system_listed_on_dsp",
    "synced_practice_management_system",
    "bookable_status",
    "provider_tenure_months",
    "bookable_status_beginning_of_week",
    "was_ever_previously_mp_bookable",
)


def with_contacts(cat: SourceCatalog, enriched: DataFrame, include_crm_practice_id: bool = False) -> DataFrame:
    """Enriched roster ⟕ CRM contacts by professional id (not distinct).

    Several contacts per professional fan out (one row each).  The join is
    fan-out-safe (``fanout_left_join``), so a professional with a huge
    number of contacts does not land on one task.  ``enriched`` is read
    twice by that join: pass a materialised one.
    """
    joined = fanout_left_join(enriched, crm_contacts(cat), "docter_id", "professional_id__c")
    middle = ("provider_id__c",) if include_crm_practice_id else ()
    return joined.select(*CONTACT_ROW_HEAD, *middle, *CONTACT_ROW_TAIL)


def npi_lookup(cat: SourceCatalog) -> DataFrame:
    """NPI and practice name by monolith professional id."""
    return cat("provider").select(
        "npi", F.col("monolith_professional_id").alias("_npi_prof"), "practice_name"
    )


def roster_labels(df: DataFrame) -> DataFrame:
    """Append the reported PMS and the sync-direction label."""
    return df.withColumns(
        {
            "pms": resolve_pms(
                F.col("sync_id"),
                F.col("sync_type"),
                F.col("synced_practice_management_system"),
                F.col("practice_management_system_listed_on_dsp"),
            ),
            "f_sync_type": sync_type_label(F.col("sync_type")),
        }
    )
