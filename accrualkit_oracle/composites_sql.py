"""DuckDB oracle SQL for the composite operators."""

from __future__ import annotations

from accrualkit_oracle import reports_sql as R

DENTICON_SEL = "p.app = 'Denticon'"
MONTH = "2024-03-01"
ATHENA = ["Athena", "AthenaAPI"]


def _r2_prefix(*extra: str) -> str:
    parts = [R.r2_syncs_ctes(MONTH, DENTICON_SEL)] + list(extra)
    return "with " + ",\n".join(parts)


_SPANS = """
spans as (select db, loc, min(created) as first_created, max(deleted) as last_deleted from pairs group by db, loc)"""

_ATHENA_DBS = f"""
athena_dbs as (select distinct db from pms_now where app in ({R._list(ATHENA)}))"""

COMPOSITE_SQL: dict[str, str] = {
    "latest_setting": f"""
with {R._latest_pms('bigint')}
select db as sync_db_id, app as pms_application, pms_id from pms_now
""",
    "mapping_history_flat": f"""
with {R._history("'Added'")}
select db as sync_db_id, loc as location_id, created as created_date_utc, deleted as deleted_date_utc from pairs
""",
    "mapping_history_bucketed": f"""
with {R._history("'Added'")}
select db as sync_db_id, loc as location_id, created as created_date_utc, deleted as deleted_date_utc from pairs
""",
    "mapping_history_incremental": f"""
with {R._history("'Added'")}
select db as sync_db_id, loc as location_id, created as created_date_utc, deleted as deleted_date_utc from pairs
""",
    "filter_as_of_each": f"""
with {R._history("'Added'")},
bounds as (select distinct cast(snapshot_month_eastern as timestamp) as boundary from practice_snapshot_summary_month)
select db as sync_db_id, loc as location_id, created as created_date_utc, deleted as deleted_date_utc, boundary
from pairs, bounds where created < boundary and coalesce(deleted > boundary, true)
""",
    "report_active_locations_of_months": f"""
select date '2024-01-01' as report_month, * from ({R.r2_active_locations("2024-01-01", "p.app = 'Denticon'", "day")}) early
union all
select date '2024-03-01' as report_month, * from ({R.r2_active_locations("2024-03-01", "p.app = 'Denticon'", "day")}) late
""",
    "mapping_history_collapsed": f"""
with {R._history("'Added', 'Updated'")}
select db as sync_db_id, loc as location_id, min(created) as created_date_utc, max(deleted) as deleted_date_utc
from pairs group by db, loc
""",
    "active_syncs_as_of": _r2_prefix() + "\nselect * from syncs",
    "active_practices_day": "with " + R.r2_active_practices_cte(MONTH, "day") + "\nselect * from act",
    "active_practices_month": "with " + R.r2_active_practices_cte(MONTH, "month") + "\nselect * from act",
    "live_aggregate_mappings": _r2_prefix(R.r2_live_maps_cte()) + "\nselect * from live_maps",
    "active_provider_locations": _r2_prefix(R.r2_live_maps_cte(), R.r2_prov_locs_cte(MONTH))
    + "\nselect provider_id, location_id from prov_locs",
    "providers_per_location": _r2_prefix(R.r2_live_maps_cte(), R.r2_prov_locs_cte(MONTH))
    + "\nselect location_id, count(distinct provider_id) as total_num_of_providers from prov_locs group by location_id",
    "primary_location_contact": _r2_prefix()
    + """
select f.cloud_practice_id, l.phone as telephone_number, l.fax as fax_number
from (select cloud_practice_id, min(location_id) as loc from syncs group by cloud_practice_id) f
join location l on l.monolith_provider_location_id = f.loc
""",
    "still_synced_locations": f"""
with {R._latest_pms('bigint')},
{R._history("'Added', 'Updated'")},
{_SPANS},
{_ATHENA_DBS}
select distinct sp.loc as location_id from spans sp
where sp.last_deleted is null and sp.db in (select db from athena_dbs)
""",
    "desync_date": f"""
with {R._latest_pms('bigint')},
{R._history("'Added', 'Updated'")},
{_SPANS},
{_ATHENA_DBS}
select sp.db as sync_db_id,
       count(distinct case when sp.last_deleted is null then sp.loc end) as num_locations_still_synced,
       case when count(distinct case when sp.last_deleted is null then sp.loc end) = 0
            then max(sp.last_deleted) end as desync_date
from spans sp join athena_dbs a on a.db = sp.db
group by sp.db
""",
    "latest_snapshot_per_key": """
select provider_id, snapshot_date_est, main_specialty, sync_type, is_active from (
  select provider_id, snapshot_date_est, main_specialty, sync_type, is_active,
         row_number() over (partition by provider_id order by snapshot_date_est desc nulls last,
                            main_specialty desc nulls last, sync_type desc nulls last, is_active desc nulls last) as rn
  from opportunity_index) z
where rn = 1
""",
    "bookable_provider_roster": """
select provider_id as c_docter_id, monolith_professional_id as docter_id, status, monolith_provider_id as d_practice_id,
       practice_id as c_practice_id, first_name, last_name, title,
       latest_activation_start_timestamp_utc, latest_activation_end_timestamp_utc
from provider
where latest_activation_start_timestamp_utc is not null and latest_activation_end_timestamp_utc is null
  and not is_resource and not is_test and profile_type = 'FullProfile' and status = 'Approved Application'
  and is_bookable_legacy
""",
    "provider_enrichment": R.r4_contact_rows("is_bookable"),
    "npi_lookup": "with "
    + R.r4_roster_ctes("is_bookable")
    + """
select r.c_docter_id, r.docter_id, n.npi, n.practice_name
from roster r join provider n on n.monolith_professional_id = r.docter_id
""",
    "parent_entity_rollup": R.r5_parent_entities(["CernerMillenniumAPI", "CernerMillenniumR4", "Other"]),
    "booking_bucket": R.r6_bookings("2024-01-02", "2024-01-31", "%raintree%"),
    "no_availability_bucket": R.r7_no_availability(
        "2023-12-01", "%raintree%", [""],
        exclusion_sql="select 1 from appointment_summary b where b.provider_id = a.provider_id",
    ),
}
