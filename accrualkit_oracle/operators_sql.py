"""DuckDB oracle SQL for the elementary operator queries."""

from __future__ import annotations

from accrualkit_oracle import reports_sql as R

_ATHENA = R._list(["Athena", "AthenaAPI"])

_SPANS = """
spans as (select db, loc, min(created) as first_created, max(deleted) as last_deleted from pairs group by db, loc)"""

_ACTIVE = "latest_activation_start_timestamp_utc is not null and latest_activation_end_timestamp_utc is null"

OPERATOR_SQL: dict[str, str] = {
    # 2.1 scans and query structure
    "scan_table": "select * from setting",
    "scan_qualified_quoted": "select * from provider",
    "scan_view": "select * from sync_overview_vw",
    "temp_table": "with "
    + R.r3_latest_sync_cte("2023-12-01", "2023-12-31", ["Dentrix", "DentrixG5"])
    + "\nselect practice_id, sync_pms, sync_type from ranked where rn = 1",
    "cte": f"""
select practice_id, count(distinct provider_id) as num_active_providers
from provider where {_ACTIVE} group by practice_id
""",
    "cte_shared": f"""
with {R._latest_pms('bigint')},
{R._history("'Added', 'Updated'")},
{_SPANS},
athena_dbs as (select distinct db from pms_now where app in ({_ATHENA})),
open_locs as (select distinct loc from spans where last_deleted is null and db in (select db from athena_dbs))
select sp.db as sync_db_id, sp.loc as location_id, sp.first_created as created_date_utc,
       sp.last_deleted as deleted_date_utc, o.loc is not null as still_synced
from spans sp left join open_locs o on o.loc = sp.loc
where sp.db in (select db from athena_dbs)
""",
    "derived_table": """
select l.location_id, l.practice_id, c.n_providers
from location l
join (select location_id, count(distinct provider_id) as n_providers from provider_location_mapping group by location_id) c
  on c.location_id = l.location_id
""",
    "param_scalar": """
select distinct pt.practice_id, pt.name, pt.monolith_provider_id
from practice pt join practice_snapshot_summary_day s on s.practice_id = pt.practice_id
where s.snapshot_date_eastern = date '2024-02-01'
""",
    "param_tuple": """
select provider_id, count(distinct appointment_id) as n_bookings from appointment_summary
where appointment_created_timestamp_local between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-15 00:00:00'
group by provider_id
""",
    "param_from_query": """
with m as (select min(snapshot_month_eastern) as first_day from practice_snapshot_summary_month)
select provider_id, last_day(first_day) as last_day, cast(day(last_day(first_day)) as integer) as total_days_in_month,
       count(distinct appointment_id) as n_bookings
from appointment_summary, m
where cast(appointment_created_timestamp_local as date) between first_day and last_day(first_day)
group by all
""",
    "result_set": R.r5_parent_entities(["CernerMillenniumAPI", "CernerMillenniumR4"]),
    # 2.2 projections
    "project_alias": """
select provider_id as c_docter_id, monolith_professional_id as docter_id, status,
       monolith_provider_id as d_practice_id, practice_id as c_practice_id
from provider
""",
    "project_star": "select * from practice_derived_metrics",
    "project_qualified_star": "with "
    + R.r4_roster_ctes("is_bookable_legacy")
    + ",\nfinal_rows as (select * from enriched)\n"
    + R.ROSTER_TAIL,
    "project_literal": """
select provider_id, appointment_id, 'HadNPBooking' as bucket from appointment_summary where is_premium_booking
""",
    "project_predicate": """
select provider_id, snapshot_date_est, latest_activation_end_timestamp_utc is null as activation_open
from opportunity_index
""",
    "project_duplicate": "select professional_id__c, provider_id__c as practice_id, provider_id__c from contact_vw",
    "lateral_alias_agg": """
select practice_id,
       count(distinct case when latest_activation_end_timestamp_utc is null then provider_id end) as num_active,
       case when count(distinct case when latest_activation_end_timestamp_utc is null then provider_id end) = 0
            then max(latest_activation_end_timestamp_utc) end as deactivated_at
from provider group by practice_id
""",
    "lateral_alias_window": """
select provider_id as c_docter_id, snapshot_date_eastern,
       row_number() over (partition by provider_id order by snapshot_date_eastern desc) as rownum
from provider_explorer_day_week_vw
""",
    "unqualified_resolution": """
select distinct a.provider_id, p.title, p.npi, a.main_specialty, s.sync_type
from provider_location_availability_summary_day a
join provider p on p.provider_id = a.provider_id
join provider_location_sync_summary_day_vw s on s.provider_id = a.provider_id
""",
    "select_distinct": "select distinct pms_application, sync_type from sync_overview_vw",
    # 2.3 filters
    "filter_eq_const": "select * from setting where setting_key_id = 16 and event_type = 'Added'",
    "filter_in_strings": "select * from setting where event_type in ('Added', 'Updated')",
    "filter_in_ints": f"""
with {R._latest_pms('integer')}
select db as sync_db_id, app as pms_application, pms_id from pms_now where pms_id in (11, 12)
""",
    "filter_not_in": """
select provider_id, practice_id, snapshot_date_eastern from provider_location_availability_summary_day
where provider_id not in ('P3', 'P27', 'P105', '')
""",
    "filter_not_in_relation": """
select a.provider_id, a.practice_id, a.snapshot_date_eastern
from provider_location_availability_summary_day a
where not exists (select 1 from appointment_summary b where b.provider_id = a.provider_id)
""",
    "filter_not_equal": "select * from provider_location_sync_summary_day_vw where sync_type <> 'Manual'",
    "filter_null_check": "select location_id, software from location where fax is null and software is not null",
    "filter_bool": "select * from provider_location_mapping where is_active",
    "filter_bool_text": "select provider_id from provider where is_bookable_legacy",
    "filter_numeric_gt": "select * from practice_snapshot_summary_month where days_in_month_active > 0",
    "filter_period_eq": """
select * from provider_location_snapshot_summary_month where snapshot_month_eastern = date '2024-04-01'
""",
    "filter_open_range": """
select * from provider_location_availability_summary_day where snapshot_date_eastern > date '2024-01-01'
""",
    "filter_between": """
select * from appointment_summary
where appointment_created_timestamp_local between timestamp '2024-01-01 00:00:00' and timestamp '2024-01-31 00:00:00'
""",
    "filter_ilike": "select location_id, software from location where software ilike '%raintree%'",
    "filter_as_of_interval": f"""
with {R._history("'Added'")}
select db as sync_db_id, loc as location_id, created as created_date_utc, deleted as deleted_date_utc from pairs
where created < timestamp '2024-04-01 00:00:00' and (deleted is null or deleted > timestamp '2024-04-01 00:00:00')
""",
    "filter_currently_active": f"select provider_id, practice_id from provider where {_ACTIVE}",
    "filter_and_or": """
select provider_id, snapshot_date_est, sync_type from opportunity_index
where (sync_type = 'Read/Write' or sync_type = 'Read/Write/Track') and is_active
""",
    "filter_tautology": "select * from contact_vw where 1 = 1",
    "filter_null_rejecting_after_outer": """
select pp.provider_id, oi.snapshot_date_est, oi.number_of_new_patient_timeslots_28_days
from provider pp left join opportunity_index oi on oi.monolith_professional_id = pp.monolith_professional_id
where oi.snapshot_date_est between date '2024-01-01' and date '2024-01-02'
""",
    # 2.4 joins
    "join_inner_equi": """
select l.location_id, l.practice_id, p.name from location l join practice p on p.practice_id = l.practice_id
""",
    "join_inner_multikey": """
select s.provider_id, s.location_id, s.snapshot_month_eastern, m.approval_status
from provider_location_snapshot_summary_month s
join provider_location_mapping m on m.provider_id = s.provider_id and m.location_id = s.location_id
""",
    "join_inner_on_filter": """
select m.provider_id, m.location_id, p.practice_id
from provider_location_mapping m
join provider p on p.provider_id = m.provider_id and m.is_active and m.approval_status = 'Approved' and not p.is_test
""",
    "join_cast_key": """
select s.entity_id, s.event_timestamp_utc, p.pms_application
from setting s join practice_management_software p on p.pms_id = try_cast(s.setting_value as integer)
where s.setting_key_id = 18
""",
    "join_left_equi": """
select p.provider_id, c.email from provider p left join contact_vw c on c.professional_id__c = p.monolith_professional_id
""",
    "join_left_on_filter": f"""
select pt.practice_id, pv.provider_id
from practice pt left join provider pv on pv.practice_id = pt.practice_id
  and pv.latest_activation_start_timestamp_utc is not null and pv.latest_activation_end_timestamp_utc is null
""",
    "join_left_multikey_ordinal": f"""
with {R._history("'Added', 'Updated'")}
select db as sync_db_id, loc as location_id, k as occurrence, created as created_date_utc,
       deleted as deleted_date_utc
from pairs
""",
    "join_left_anti_range": """
select o.o_orderkey, o.o_custkey, o.o_orderdate from orders o
where not exists (select 1 from orders x where x.o_custkey = o.o_custkey and x.o_orderdate > o.o_orderdate)
""",
    "join_non_equi_residual": """
select l.l_orderkey, l.l_linenumber, o.o_orderdate, l.l_shipdate
from lineitem l join orders o on o.o_orderkey = l.l_orderkey and l.l_shipdate > o.o_orderdate + interval 90 day
""",
    "join_mark": f"""
with {R._history("'Added', 'Updated'")},
{_SPANS}
select l.location_id, l.monolith_provider_location_id, o.loc as open_mapping_location
from location l left join (select distinct loc from spans where last_deleted is null) o
  on o.loc = l.monolith_provider_location_id
""",
    "join_preaggregated": f"""
select pt.practice_id, pt.name, a.num_active_providers
from practice pt left join (
  select practice_id, count(distinct provider_id) as num_active_providers from provider where {_ACTIVE} group by practice_id) a
  on a.practice_id = pt.practice_id
""",
    "join_self": """
select a.provider_id, b.npi, b.practice_name
from provider a join provider b on b.monolith_professional_id = a.monolith_professional_id
""",
    "join_star": """
select e.parent_entity_name, so.pms_application, pv.provider_id, so.location_id
from sync_overview_vw so
join provider_location_mapping m on m.location_id = so.location_id
join provider pv on pv.provider_id = m.provider_id
join practice_parent_entity_mapping_vw e on e.practice_id = pv.practice_id
""",
    "join_bridge": """
select l.location_id, p.provider_id, p.practice_id
from location l join provider_location_mapping m on m.location_id = l.location_id
join provider p on p.provider_id = m.provider_id
""",
    "join_fanout_distinct": """
select distinct a.provider_id, l.software
from provider_location_availability_summary_day a join location l on l.practice_id = a.practice_id
""",
    "join_inner_drops_unmatched": """
select c.professional_id__c, c.email, p.npi from contact_vw c join provider p on p.monolith_professional_id = c.professional_id__c
""",
    # 2.5 aggregations
    "group_by_ordinal": """
select parent_entity_name, count(distinct practice_id) as num_practices from practice_parent_entity_mapping_vw group by 1
""",
    "group_by_named": """
select pms_application, sync_type, min(most_recent_sync_timestamp_utc) as first_sync
from sync_overview_vw group by pms_application, sync_type
""",
    "agg_min": """
select entity_id as location_id, min(event_timestamp_utc) as first_created from setting
where setting_key_id = 16 and event_type in ('Added', 'Updated') group by entity_id
""",
    "agg_max": """
select entity_id, max(event_timestamp_utc) as most_recent_created_or_updated_event from setting
where setting_key_id = 18 and event_type in ('Added', 'Updated') group by entity_id
""",
    "agg_count_distinct": """
select location_id, count(distinct provider_id) as num_providers from provider_location_mapping group by location_id
""",
    "agg_count_distinct_integer": """
select provider_id, count(distinct appointment_id) as num_appointments from appointment_summary group by provider_id
""",
    "join_semi_bloom": """
select l_orderkey, l_linenumber, l_quantity from lineitem
where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'O')
""",
    "agg_multi_distinct": """
select l_returnflag, count(distinct l_partkey) as num_parts, count(distinct l_suppkey) as num_suppliers
from lineitem group by l_returnflag
""",
    "agg_mixed_distinct": """
select l_returnflag, l_linestatus, count(distinct l_orderkey) as num_orders, min(l_shipdate) as first_ship,
       max(l_shipdate) as last_ship
from lineitem group by l_returnflag, l_linestatus
""",
    "agg_conditional_result": """
select o_custkey, count(distinct case when o_orderstatus = 'O' then o_orderkey end) as open_orders,
       case when count(distinct case when o_orderstatus = 'O' then o_orderkey end) = 0 then max(o_orderdate) end
         as last_order_date
from orders group by o_custkey
""",
    "agg_latest_event_join": """
select entity_id, setting_value, event_type, event_timestamp_utc from (
  select *, max(case when event_type in ('Added', 'Updated') then event_timestamp_utc end)
              over (partition by entity_id) as newest
  from setting where setting_key_id = 18) s
where event_timestamp_utc = newest
""",
    "agg_with_literal": """
select provider_id, count(distinct appointment_id) as npbookingcount, 'HadNPBooking' as bucket
from appointment_summary where is_premium_booking group by provider_id
""",
    "agg_of_agg": """
select l.practice_id, max(c.n) as max_providers_per_location
from location l join (select location_id, count(distinct provider_id) as n from provider_location_mapping group by location_id) c
  on c.location_id = l.location_id
group by l.practice_id
""",
    "agg_distinct_redundant": """
select pms_application, count(distinct location_id) as num_locations from sync_overview_vw group by pms_application
""",
    # 2.6 windows
    "win_row_number_asc": f"""
select try_cast(setting_value as bigint) as sync_db_id, entity_id as location_id, event_timestamp_utc as ts,
       row_number() over (partition by try_cast(setting_value as bigint), entity_id order by event_timestamp_utc) as occurrence
from setting where setting_key_id = 16 and event_type = 'Added'
""",
    "win_partition_expr": f"""
select try_cast(setting_value as bigint) as sync_db_id, entity_id as location_id, event_timestamp_utc as ts,
       row_number() over (partition by try_cast(setting_value as bigint), entity_id order by event_timestamp_utc) as occurrence
from setting where setting_key_id = 16 and event_type = 'Deleted'
""",
    "win_row_number_hot": "select event_type, ts, row_number() over (partition by event_type order by ts) as occurrence from events",
    "win_row_number_desc": """
select provider_id, snapshot_date_est,
       row_number() over (partition by provider_id order by snapshot_date_est desc) as rownum
from opportunity_index
""",
    "qualify_inline": "with "
    + R.r3_latest_sync_cte("2023-12-01", "2023-12-31", ["Dentrix", "DentrixG5"])
    + "\nselect practice_id, sync_pms, sync_type from ranked where rn = 1",
    "qualify_alias": """
select * from (
  select snapshot_date_eastern, provider_id as c_docter_id, sync_type, account_segment, current_account_segment,
         bookable_status, provider_tenure_months, bookable_status_beginning_of_week, was_ever_previously_mp_bookable,
         cast(row_number() over (partition by provider_id order by snapshot_date_eastern desc) as integer) as rownum
  from provider_explorer_day_week_vw) z
where rownum = 1
""",
    "qualify_and_predicate": """
select * from (
  select snapshot_date_est, practice_id, monolith_practice_id, provider_id, monolith_professional_id, main_specialty,
         is_active, is_currently_synced, latest_activation_start_timestamp_utc,
         latest_activation_end_timestamp_utc is null as activation_open, sync_id, sync_type,
         practice_management_system_listed_on_dsp, synced_practice_management_system,
         cast(row_number() over (partition by provider_id order by snapshot_date_est desc) as integer) as rownum
  from opportunity_index) z
where rownum = 1 and is_active
""",
    "qualify_distinct": """
select distinct c_docter_id, account_segment, rownum from (
  select provider_id as c_docter_id, account_segment,
         cast(row_number() over (partition by provider_id order by snapshot_date_eastern desc) as integer) as rownum
  from provider_explorer_day_week_vw) z
where rownum = 1
""",
    # 2.7 sorts, top-k, set operations
    "sort_result_desc": """
select provider_id, count(distinct appointment_id) as n_appointments from appointment_summary
group by provider_id order by provider_id desc
""",
    "sort_multi_mixed": """
select provider_id, snapshot_date_eastern, account_segment from provider_explorer_day_week_vw
order by provider_id, snapshot_date_eastern desc
""",
    "sort_in_subquery": """
select r.c_docter_id, c.email
from (select provider_id as c_docter_id, monolith_professional_id as docter_id, last_name from provider
      where latest_activation_start_timestamp_utc is not null and latest_activation_end_timestamp_utc is null
        and not is_resource and not is_test and profile_type = 'FullProfile' and status = 'Approved Application'
        and is_bookable_legacy
      order by last_name) r
left join contact_vw c on c.professional_id__c = r.docter_id
""",
    "top1_per_group": """
select o_custkey, o_orderdate, o_orderkey, o_totalprice from (
  select o_custkey, o_orderdate, o_orderkey, o_totalprice,
         row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey desc nulls last) as rn
  from orders) z
where rn = 1
""",
    "union_distinct": "select c_nationkey as nationkey from customer union select s_nationkey from supplier",
    # 2.8 scalar functions
    "fn_try_cast_bigint": """
select distinct setting_value, try_cast(setting_value as bigint) as sync_db_id from setting where setting_key_id = 16
""",
    "fn_try_cast_int": """
select distinct setting_value, try_cast(setting_value as integer) as pms_id from setting where setting_key_id = 18
""",
    "fn_try_cast_noop": """
select distinct entity_id, try_cast(try_cast(setting_value as bigint) as bigint) as sync_db_id
from setting where setting_key_id = 16
""",
    "fn_cast_date": "select distinct cast(strftime(ts, '%Y-%m-%d') as date) as event_date from events",
    "fn_last_day": "select distinct last_day(o_orderdate) as month_end from orders",
    "fn_day": """
select distinct cast(date_trunc('month', o_orderdate) as date) as month_start,
       cast(day(last_day(o_orderdate)) as integer) as days_in_month
from orders
""",
    "fn_add_months": """
select distinct snapshot_month_eastern, cast(snapshot_month_eastern + interval 1 month as date) as next_month
from practice_snapshot_summary_month
""",
    "fn_dateadd_day": """
select distinct snapshot_date_est, snapshot_date_est + 1 as next_day from opportunity_index
""",
    "fn_case_pms": """
select provider_id, snapshot_date_est,
       case when sync_id is null and sync_type is null and synced_practice_management_system is null
            then practice_management_system_listed_on_dsp else synced_practice_management_system end as pms
from opportunity_index
""",
    "fn_case_sync_type": """
select provider_id, snapshot_date_est, sync_type,
       case when sync_type in ('Read/Write', 'Read/Write/Track') then 'Two Way'
            when sync_type = 'Read Only' then 'One Way' else 'Manual' end as f_sync_type
from opportunity_index
""",
    "fn_implicit_coercion": """
select provider_id, latest_activation_end_timestamp_utc from provider
where latest_activation_end_timestamp_utc > date '2024-03-01'
""",
}
