"""Portable SQL for the warehouse stand-ins (DuckDB oracle side).

Same derivations as ``accrualkit/sources/fixtures.py``, written as SQL over
the base test tables.  ``with_fixtures(body)`` prepends exactly the CTEs a
query body references (plus their dependencies).
"""

from __future__ import annotations

import re

FIXTURE_SQL: dict[str, str] = {}

FIXTURE_SQL["fx_months"] = """
select * from (values (date '2024-01-01'),(date '2024-02-01'),(date '2024-03-01'),(date '2024-04-01'),(date '2024-05-01')) t(m)
"""

FIXTURE_SQL["fx_days"] = """
select * from (values (date '2024-01-01'),(date '2024-01-02'),(date '2024-01-03')) t(d)
"""

FIXTURE_SQL["setting"] = """
select * from (
 select 16 as setting_key_id, cast(user_id as varchar) as entity_id,
  case when event_id % 97 = 0 then 'n/a' else cast(cast(floor(user_id/3.0) as bigint) as varchar) end as setting_value,
  case when event_type = 'view' then 'Added' when event_type = 'click' then 'Updated'
       when user_id % 4 < 3 then 'Deleted' else 'Viewed' end as event_type,
  ts + interval '1' day * cast(event_id % 120 as int) as event_timestamp_utc
 from events where event_type in ('view','click','error')
 union all
 select 18, cast(cast(floor(user_id/3.0) as bigint) as varchar),
  case when event_id % 89 = 0 then 'n/a' else cast(10 + event_id % 8 as varchar) end,
  case event_type when 'signup' then 'Added' else 'Updated' end,
  case when cast(floor(user_id/3.0) as bigint) % 5 = 0 then cast(date_trunc('day', ts) as timestamp) else ts end
 from events where event_type in ('signup','purchase')) s
"""

FIXTURE_SQL["practice_management_software"] = """
select * from (values (10,'Nextech'),(11,'Eaglesoft'),(12,'EaglesoftCloud'),(13,'Denticon'),(14,'AllScriptsAPI'),
 (15,'Athena'),(16,'AthenaAPI'),(17,'CAPI_PrognoCIS')) t(pms_id,pms_application)
"""

FIXTURE_SQL["practice"] = """
select cast(s_suppkey as varchar) as practice_id, s_suppkey as monolith_provider_id, s_name as name,
 s_suppkey % 25 = 24 as is_test from supplier
"""

FIXTURE_SQL["location"] = """
select 'L' || cast(c_custkey as varchar) as location_id, cast(c_custkey as varchar) as monolith_provider_location_id,
 cast(cast(floor(c_custkey*2/3.0) as bigint) as varchar) as practice_id, 'addr ' || c_name as address1,
 cast(null as varchar) as address2, cast(null as varchar) as address3, n_name as city, r_name as state,
 cast(10000 + c_custkey % 90000 as varchar) as zip_code, 'T' || cast(c_custkey as varchar) as phone,
 case when c_custkey % 3 = 0 then null else 'F' || cast(c_custkey as varchar) end as fax,
 case when c_custkey % 3 = 0 then 'RainTree v2' when c_custkey % 3 = 1 then 'other' end as software,
 c_custkey % 11 = 10 as is_virtual
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
"""

FIXTURE_SQL["provider"] = """
select 'P' || cast(c_custkey as varchar) as provider_id,
 case when c_custkey % 13 = 5 then null when c_custkey % 17 = 3 then c_custkey - 1 else c_custkey end as monolith_professional_id,
 cast(cast(floor(c_custkey/15.0) as bigint) as varchar) as practice_id, cast(floor(c_custkey/15.0) as bigint) as monolith_provider_id,
 'F' || cast(c_custkey as varchar) as first_name, c_name as last_name, case when c_custkey % 2 = 0 then 'MD' else 'DDS' end as title,
 cast(1000000000 + c_custkey as varchar) as npi, 'Practice ' || cast(cast(floor(c_custkey/15.0) as bigint) as varchar) as practice_name,
 case when c_custkey % 7 = 0 then null else timestamp '2023-01-01 00:00:00' end as latest_activation_start_timestamp_utc,
 case when c_custkey % 5 = 0 or cast(floor(c_custkey/15.0) as bigint) % 9 = 4
      then timestamp '2024-03-15 00:00:00' end as latest_activation_end_timestamp_utc,
 c_custkey % 40 = 39 as is_resource, c_custkey % 50 = 49 as is_test,
 case when c_custkey % 10 = 3 then 'LiteProfile' else 'FullProfile' end as profile_type,
 case when c_custkey % 9 = 1 then 'Pending' else 'Approved Application' end as status,
 c_custkey % 4 <> 1 as is_bookable, c_custkey % 4 <> 2 as is_bookable_legacy
from customer
"""

FIXTURE_SQL["practice_snapshot_summary_month"] = """
select cast(s_suppkey as varchar) as practice_id, m as snapshot_month_eastern,
 cast((s_suppkey + month(m)) % 6 as int) as days_in_month_active
from supplier cross join fx_months
"""

FIXTURE_SQL["provider_location_snapshot_summary_month"] = """
select 'P' || cast(c_custkey as varchar) as provider_id,
 case when c_custkey % 4 = 0 then 'A' else 'L' end || cast(cast(floor(c_custkey/10.0) as bigint) as varchar) as location_id,
 m as snapshot_month_eastern, (c_custkey + month(m)) % 3 <> 0 as is_active_beginning_of_month
from customer cross join fx_months
"""

FIXTURE_SQL["aggregate_location_mapping_update"] = """
select * from (
 select 'A' || cast(user_id as varchar) as aggregate_location_id, 'L' || cast(user_id as varchar) as source_location_id,
  case when user_id % 2 = 1 then 'review' when event_id % 5 = 0 then 'PROD_manual_backfill_20201119_create' else 'create' end as event_update_type,
  ts as created_timestamp_utc, cast(null as timestamp) as deleted_timestamp_utc
 from events where event_type = 'signup'
 union all
 select 'A' || cast(user_id as varchar), 'L' || cast(user_id as varchar),
  case when user_id % 4 = 0 then 'update' else 'review' end, cast(null as timestamp), ts
 from events where event_type = 'purchase') u
"""

FIXTURE_SQL["practice_snapshot_summary_day"] = """
select practice_id, snapshot_month_eastern as snapshot_date_eastern
from practice_snapshot_summary_month where days_in_month_active <> 1
"""

FIXTURE_SQL["provider_explorer_day_week_vw"] = """
select 'P' || cast(o_custkey as varchar) as provider_id, cast(o_orderdate as date) as snapshot_date_eastern,
 case when max(o_orderkey) % 2 = 0 then 'Read/Write' else 'Read Only' end as sync_type,
 'seg' || cast(max(o_orderkey) % 3 as varchar) as account_segment,
 'cur' || cast(max(o_orderkey) % 4 as varchar) as current_account_segment,
 max(o_orderkey) % 2 = 0 as bookable_status,
 max(o_orderkey) % 5 <> 0 as bookable_status_beginning_of_week,
 min(o_orderkey) % 2 = 0 as was_ever_previously_mp_bookable,
 max(o_orderkey) % 60 as provider_tenure_months
from orders group by o_custkey, cast(o_orderdate as date)
"""

FIXTURE_SQL["opportunity_index"] = """
select d as snapshot_date_est, cast(cast(floor(c_custkey/15.0) as bigint) as varchar) as practice_id,
 cast(floor(c_custkey/15.0) as bigint) as monolith_practice_id,
 'P' || cast(c_custkey as varchar) as provider_id, c_custkey as monolith_professional_id, c_mktsegment as main_specialty,
 (c_custkey + day(d)) % 5 <> 0 as is_active, c_custkey % 6 <> 0 as is_currently_synced,
 case when c_custkey % 7 = 0 then null else timestamp '2023-01-01 00:00:00' end as latest_activation_start_timestamp_utc,
 case when c_custkey % 5 = 0 then timestamp '2024-03-15 00:00:00' end as latest_activation_end_timestamp_utc,
 case when c_custkey % 6 = 0 then null else c_custkey end as sync_id,
 case c_custkey % 6 when 1 then 'Read/Write' when 2 then 'Read/Write/Track' when 3 then 'Read Only' when 4 then 'Manual' end as sync_type,
 case when c_custkey % 6 in (0, 5) then null else 'pms' || cast(c_custkey % 3 as varchar) end as synced_practice_management_system,
 'listed' || cast(c_custkey % 4 as varchar) as practice_management_system_listed_on_dsp,
 (c_custkey * 7 + day(d)) % 30 as number_of_new_patient_timeslots_28_days,
 (c_custkey * 3 + day(d)) % 30 as number_of_existing_patient_timeslots_28_days
from customer cross join fx_days
"""

FIXTURE_SQL["contact_vw"] = """
select c_custkey as professional_id__c, cast(floor(c_custkey/15.0) as bigint) as provider_id__c,
 'F' || cast(c_custkey as varchar) as firstname, c_name as lastname,
 'a' || cast(c_custkey as varchar) || '@x.example' as email, 'ph' || cast(c_custkey as varchar) as phone,
 case when c_custkey % 4 = 0 then null else 'mob' || cast(c_custkey as varchar) end as mobilephone
from customer where c_custkey % 3 <> 0
union all
select c_custkey, cast(floor(c_custkey/15.0) as bigint), 'F' || cast(c_custkey as varchar), c_name,
 'b' || cast(c_custkey as varchar) || '@x.example', 'ph' || cast(c_custkey as varchar),
 case when c_custkey % 4 = 0 then null else 'mob' || cast(c_custkey as varchar) end
from customer where c_custkey % 10 = 1
"""

FIXTURE_SQL["sync_overview_vw"] = """
select location_id,
 case cast(monolith_provider_location_id as bigint) % 4 when 0 then 'CernerMillenniumAPI' when 1 then 'CernerMillenniumR4' else 'Other' end as pms_application,
 case cast(monolith_provider_location_id as bigint) % 2 when 0 then 'Read/Write' else 'Manual' end as sync_type,
 timestamp '2024-01-01 00:00:00' + interval '1' hour * cast(cast(monolith_provider_location_id as bigint) as int) as most_recent_sync_timestamp_utc
from location
"""

FIXTURE_SQL["provider_location_mapping"] = """
select 'P' || cast(c_custkey as varchar) as provider_id,
 'L' || cast(cast(floor(c_custkey/10.0) as bigint) as varchar) as location_id,
 c_custkey % 8 <> 7 as is_active,
 case when c_custkey % 6 = 5 then 'Pending' else 'Approved' end as approval_status
from customer
"""

FIXTURE_SQL["practice_parent_entity_mapping_vw"] = """
select cast(s_suppkey as varchar) as practice_id, 'Entity ' || cast(s_nationkey as varchar) as parent_entity_name from supplier
"""

FIXTURE_SQL["appointment_summary"] = """
select event_id as appointment_id, 'P' || cast(user_id * 10 + event_id % 10 as varchar) as provider_id,
 case when event_id % 7 = 0 then cast(date_trunc('day', ts + interval '1' day * cast(event_id % 4 as int)) as timestamp)
      else ts + interval '1' day * cast(event_id % 4 as int) end as appointment_created_timestamp_local, event_id % 2 = 0 as is_premium_booking
from events where event_type in ('purchase','click')
"""

FIXTURE_SQL["provider_location_availability_summary_day"] = """
select provider_id, practice_id, d as snapshot_date_eastern,
 cast(substr(provider_id, 2) as bigint) % 3 <> 0 as has_availability,
 'spec' || cast(cast(substr(provider_id, 2) as bigint) % 5 as varchar) as main_specialty
from provider cross join fx_days
"""

FIXTURE_SQL["provider_location_sync_summary_day_vw"] = """
select provider_id, d as snapshot_date_eastern,
 case cast(substr(provider_id, 2) as bigint) % 3 when 0 then 'Read/Write' when 1 then 'Manual' end as sync_type
from provider cross join fx_days
"""

FIXTURE_SQL["provider_location_sync_snapshot_day_new"] = """
select 'P' || cast(o_custkey as varchar) as provider_id, date '2023-12-01' + cast(o_orderkey % 40 as int) as snapshot_date_eastern,
 case (cast(floor(o_custkey/15.0) as bigint) + o_orderkey % 40) % 3 when 0 then 'Dentrix' when 1 then 'DentrixG5' else 'Nextech' end as sync_pms,
 case (cast(floor(o_custkey/15.0) as bigint) + o_orderkey % 40) % 2 when 0 then 'Read/Write' else 'Read Only' end as sync_type
from orders
"""

FIXTURE_SQL["practice_derived_metrics"] = """
select cast(s_suppkey as varchar) as practice_id, s_name as practice_name,
 'L' || cast(cast(floor(s_suppkey*3/2.0) as bigint) as varchar) as first_location_id,
 'seg' || cast(s_suppkey % 4 as varchar) as account_segment
from supplier
"""

# Definition order (dependencies first).
ORDER = list(FIXTURE_SQL)


def _refs(sql: str) -> set[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql.lower()))
    return {name for name in FIXTURE_SQL if name in words}


def _closure(names: set[str]) -> set[str]:
    out: set[str] = set()
    todo = list(names)
    while todo:
        n = todo.pop()
        if n in out:
            continue
        out.add(n)
        todo.extend(_refs(FIXTURE_SQL[n]) - {n})
    return out


def with_fixtures(body: str) -> str:
    """Prefix ``body`` (one SELECT, may start with its own WITH) with fixture CTEs."""
    needed = _closure(_refs(body))
    ctes = [f"{n} as ({FIXTURE_SQL[n].strip()})" for n in ORDER if n in needed]
    body = body.strip()
    if not ctes:
        return body
    prefix = "with " + ",\n".join(ctes)
    if body.lower().startswith("with "):
        return prefix + ",\n" + body[5:]
    return prefix + "\n" + body
