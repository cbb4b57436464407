"""Fixed values.

Every literal the reports must match exactly (setting keys, event names,
status values, labels, default selectors and the warehouse relation names),
kept in one place.  Modules import these names instead of repeating the
literals.
"""

# --- Fixed values: sync settings event log -------------------------------
PMS_SETTING_KEY = 18  # entity = sync database id, value = PMS id
LOCATION_SETTING_KEY = 16  # entity = location (monolith id), value = sync database id
ADDED = "Added"
UPDATED = "Updated"
DELETED = "Deleted"

# --- Fixed values: aggregate-location mapping log ------------------------
AGG_CREATE_TYPES = ("create", "PROD_manual_backfill_20201119_create")
AGG_UPDATE_TYPES = ("update", "PROD_manual_backfill_20201119_update")

# --- Fixed values: provider roster eligibility and labels ----------------
FULL_PROFILE = "FullProfile"
APPROVED_STATUSES = ("Approved Application",)
APPROVED = "Approved"
TWO_WAY_SYNC_TYPES = ("Read/Write", "Read/Write/Track")
ONE_WAY_SYNC_TYPE = "Read Only"
TWO_WAY_LABEL = "Two Way"
ONE_WAY_LABEL = "One Way"
MANUAL_LABEL = "Manual"
MANUAL_SYNC = "Manual"

# --- Fixed values: report buckets and default selectors ------------------
BOOKING_BUCKET = "HadNPBooking"
NO_AVAILABILITY_BUCKET = "IntegratedButNoAvailability"
CERNER_APPLICATIONS = ("CernerMillenniumAPI", "CernerMillenniumR4")
DENTRIX_PMS = ("Dentrix", "DentrixG5")
RAINTREE_PATTERN = "%raintree%"

# --- Fixed values: warehouse relation of each logical name ---------------
WAREHOUSE_NAMES = {
    "setting": "sync.setting",
    "practice_management_software": "sync.practice_management_software",
    "sync_overview_vw": "sync.sync_overview_vw",
    "location": "provider.location",
    "practice": "provider.practice",
    "provider": "provider.provider",
    "provider_location_mapping": "provider.provider_location_mapping",
    "practice_derived_metrics": "provider.practice_derived_metrics",
    "practice_snapshot_summary_day": "provider_analytics.practice_snapshot_summary_day",
    "practice_snapshot_summary_month": "provider_analytics.practice_snapshot_summary_month",
    "provider_location_snapshot_summary_month": "provider_analytics.provider_location_snapshot_summary_month",
    "practice_parent_entity_mapping_vw": "provider_analytics.practice_parent_entity_mapping_vw",
    "opportunity_index": "provider_analytics.opportunity_index",
    "provider_location_availability_summary_day": "provider_analytics.provider_location_availability_summary_day",
    "provider_location_sync_summary_day_vw": "provider_analytics.provider_location_sync_summary_day_vw",
    "aggregate_location_mapping_update": "provider_raw.aggregate_location_mapping_update",
    "provider_explorer_day_week_vw": "visualization.provider_explorer_day_week_vw",
    "contact_vw": "salesforce.contact_vw",
    "appointment_summary": "appointment.appointment_summary",
    "provider_location_sync_snapshot_day_new": "experimental.provider_location_sync_snapshot_day_new",
}
