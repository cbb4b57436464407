"""Cross-check against statistics of the stand-in data computed independently
(DuckDB over the same base tables, sf0.01): the operators must reproduce them exactly."""

from pyspark.sql import functions as F

from accrualkit.constants import AGG_CREATE_TYPES, AGG_UPDATE_TYPES
from accrualkit.operators.event_log import mapping_history_flat
from accrualkit.operators.joins import not_superseded
from accrualkit.sources.catalog import SourceCatalog

SF = "/root/testdata/sf0.01"


def test_flat_history_statistics(spark):
    cat = SourceCatalog.from_testdata(spark, SF)
    assert cat("setting").count() == 10000
    h = mapping_history_flat(cat("setting"))
    b = F.lit("2024-04-01 00:00:00").cast("timestamp_ntz")
    d, c = F.col("deleted_date_utc"), F.col("created_date_utc")
    r = h.agg(
        F.count("*").alias("rows"),
        F.sum(d.isNull().cast("int")).alias("open"),
        F.sum((d <= b).cast("int")).alias("closed_before"),
        F.sum((d > b).cast("int")).alias("closed_after"),
        F.sum((d < c).cast("int")).alias("delete_first"),
    ).first()
    assert (r.rows, r.open, r.closed_before, r.closed_after, r.delete_first) == (1982, 731, 917, 334, 641)


def test_live_aggregate_mapping_count(spark):
    log = SourceCatalog.from_testdata(spark, SF)("aggregate_location_mapping_update")
    keys = ["aggregate_location_id", "source_location_id"]
    creates = log.filter(F.col("event_update_type").isin(*AGG_CREATE_TYPES)).select(*keys, "created_timestamp_utc")
    updates = log.filter(F.col("event_update_type").isin(*AGG_UPDATE_TYPES)).select(*keys, "deleted_timestamp_utc")
    assert not_superseded(creates, updates, keys, "created_timestamp_utc", "deleted_timestamp_utc").count() == 536


def test_report_row_counts_match_independent_prototypes(spark):
    import __spark_entry__ as E

    expected = {  # row counts at sf0.01, computed independently
        "report_api_practices_allscripts": 18,
        "report_api_practices_athena": 27,
        "report_api_practices_prognocis": 13,
        "report_active_locations_nextech": 13,
        "report_active_locations_denticon": 14,
        "report_active_locations_eaglesoft": 17,
        "report_synced_addresses": 100,
        "report_provider_roster": 522,
        "report_provider_roster_npi": 574,
        "report_parent_entities": 45,
        "report_bookings_ep": 186,
        "report_no_availability": 249,
    }
    q = E.queries()
    assert {n: q[n](spark, SF).count() for n in expected} == expected


def test_no_base_row_is_lost(spark):
    cat = SourceCatalog.from_testdata(spark, SF)
    types = {r["event_type"]: r["count"] for r in cat.base.events.groupBy("event_type").count().collect()}
    assert cat("setting").count() == sum(types.values())
    assert cat("aggregate_location_mapping_update").count() == types["signup"] + types["purchase"]
    assert cat("location").count() == cat.base.customer.count()


def test_registered_rows_tell_operators_from_their_naive_variants(spark):
    """Each case holds rows that the naive variant would get wrong."""
    import __spark_entry__ as E

    q, cat = E.queries(), SourceCatalog.from_testdata(spark, SF)
    frame = lambda name: q[name](spark, SF)
    assert frame("join_inner_drops_unmatched").count() < cat("contact_vw").count()
    assert frame("join_left_on_filter").filter("provider_id is null").count() > 0
    assert frame("join_preaggregated").filter("num_active_providers is null").count() > 0
    assert frame("lateral_alias_agg").filter("num_active = 0 and deactivated_at is not null").count() > 0
    assert frame("fn_try_cast_int").filter("setting_value = 'n/a' and pms_id is null").count() == 1
    assert frame("latest_setting").groupBy("sync_db_id").count().filter("count > 1").count() > 0
    assert frame("report_api_practices_athena").filter("num_active_providers = 0").count() > 0
    assert frame("report_bookings_np").exceptAll(frame("report_bookings_ep")).count() > 0
    assert frame("filter_not_in").count() < cat("provider_location_availability_summary_day").count()
    # the inner NPI lookup drops unknown professionals and repeats those listed twice
    roster = {r["c_docter_id"]: 0 for r in cat("provider").select(F.col("provider_id").alias("c_docter_id")).collect()}
    for r in frame("npi_lookup").collect():
        roster[r["c_docter_id"]] += 1
    assert max(roster.values()) > 1 and roster["P5"] == 0


def test_bookings_at_the_last_midnight_are_inside(spark):
    import datetime as dt

    from accrualkit.plans import reports as RP

    cat = SourceCatalog.from_testdata(spark, SF)
    reported = {r["provider_id"] for r in RP.report_bookings(cat, "2024-01-01", "2024-01-31").collect()}
    booked = {}
    for r in cat("appointment_summary").filter("is_premium_booking").collect():
        if r["provider_id"] in reported:
            booked.setdefault(r["provider_id"], set()).add((r["appointment_created_timestamp_local"], r["appointment_id"]))
    midnight = dt.time()
    who, end = min((p, t) for p, rows in booked.items() for t, _ in rows if t.time() == midnight and t.day > 2)
    start = dt.datetime(2024, 1, 1)
    want = sum(start <= t <= end for t, _ in booked[who])
    assert want > sum(start <= t < end for t, _ in booked[who])
    got = RP.report_bookings(cat, "2024-01-01", end.date()).filter(F.col("provider_id") == who).collect()
    assert {r["npbookingcount"] for r in got} == {want}


def test_order_of_the_sorted_results(spark):
    import __spark_entry__ as E

    q = E.queries()
    ids = [r["provider_id"] for r in q["sort_result_desc"](spark, SF).collect()]
    assert ids == sorted(ids, reverse=True) and len(set(ids)) > 100
    rows = [(r["provider_id"], r["snapshot_date_eastern"]) for r in q["sort_multi_mixed"](spark, SF).collect()]
    assert all(a[0] < b[0] or a[0] == b[0] and a[1] >= b[1] for a, b in zip(rows, rows[1:]))
    assert any(a[0] == b[0] and a[1] > b[1] for a, b in zip(rows, rows[1:]))
