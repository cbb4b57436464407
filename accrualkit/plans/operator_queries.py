"""One query per elementary operator of the report scripts.

Each query runs one operator (scan, projection, filter, join, aggregate,
window, sort, set operation, scalar function) over whole tables — the
warehouse stand-ins or the base test tables — through the library's own
operators where one exists.  Several use the SQL API (``spark.sql`` over
catalog temp views) where the operator *is* a piece of SQL syntax (CTE,
GROUP BY ordinal, lateral alias, bound parameters, unqualified names).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accrualkit.functions.casts import try_bigint, try_int
from accrualkit.functions.dates import at_midnight, date_lit, days_in_month
from accrualkit.functions.labels import resolve_pms, sync_type_label
from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.bloom import choose
from accrualkit.operators.distinct import count_distinct_each, count_distinct_integers
from accrualkit.operators.event_log import (
    ADDED,
    DELETED,
    UPDATED,
    latest_setting,
    mapping_events,
    mapping_history_collapsed,
    mapping_history_flat,
    paired_occurrences,
    rows_at_latest,
)
from accrualkit.operators.joins import fanout_left_join, mark_members, not_superseded, union_distinct
from accrualkit.operators.ordinal import occurrence_number
from accrualkit.operators.temporal import as_of, currently_active
from accrualkit.params import DateWindow, PmsSelector
from accrualkit.plans import reports as RP
from accrualkit.plans import roster as R
from accrualkit.plans import syncs as S
from accrualkit.plans.materialize import reuse, temp_table, write_result
from accrualkit.plans.registry_params import ADDRESS_WINDOW, ATHENA_APPS, NO_AVAILABILITY_EXCLUDED
from accrualkit.sources.catalog import SourceCatalog, normalise_flags

# Operator-query parameters (dates inside the generated data).
AS_OF_BOUNDARY = "2024-04-01"
PERIOD_MONTH = dt.date(2024, 4, 1)
PARAM_MONTH = dt.date(2024, 2, 1)
OPEN_RANGE_FROM = "2024-01-01"
BOOKING_WINDOW = DateWindow.of("2024-01-01", "2024-01-31")
PARAM_WINDOW = DateWindow.of("2024-01-01", "2024-01-15")
OI_WINDOW = DateWindow.of("2024-01-01", "2024-01-02")
LATE_SHIP_DAYS = 90
COERCION_BOUND = "2024-03-01"
#: Rows above which a key counts as hot in the query that shows it.
BLOOM_WORDS = 1 << 14
HOT_ROWS = 300

OPERATOR_QUERIES: dict = {}


def query(name: str):
    def register(fn):
        OPERATOR_QUERIES[name] = fn
        return fn

    return register


def _cat(spark: SparkSession, sf_dir: str) -> SourceCatalog:
    return SourceCatalog.from_testdata(spark, sf_dir)


def _active(df: DataFrame) -> DataFrame:
    return df.filter(currently_active("latest_activation_start_timestamp_utc", "latest_activation_end_timestamp_utc"))


# ----------------------------------------------------------- 2.1 scans, structure
@query("scan_table")
def scan_table(spark, d):
    return _cat(spark, d).table("sync.setting")


@query("scan_qualified_quoted")
def scan_qualified_quoted(spark, d):
    return _cat(spark, d).table('"WAREHOUSE"."PROVIDER"."PROVIDER"')


@query("scan_view")
def scan_view(spark, d):
    """The relation is a view here: a registered plan over other relations, resolved by name."""
    view = SourceCatalog.from_testdata(spark, d, store=False).view("sync.sync_overview_vw")
    return spark.sql(f"SELECT * FROM {view}")


@query("temp_table")
def temp_table_query(spark, d):
    cat = _cat(spark, d)
    latest = RP.latest_synced_pms_per_practice(cat, ADDRESS_WINDOW)
    return temp_table(latest, f"latest_sync_{cat.token}")


@query("cte")
def cte(spark, d):
    cat = _cat(spark, d)
    pv = cat.view("provider")
    return spark.sql(
        f"""
        WITH active_providers AS (
          SELECT provider_id, practice_id FROM {pv}
          WHERE latest_activation_start_timestamp_utc IS NOT NULL AND latest_activation_end_timestamp_utc IS NULL)
        SELECT practice_id, count(DISTINCT provider_id) AS num_active_providers
        FROM active_providers GROUP BY practice_id"""
    )


@query("cte_shared")
def cte_shared(spark, d):
    """The collapsed history is read twice: as rows and as the still-synced set."""
    cat = _cat(spark, d)
    dbs = reuse(S.selected_sync_dbs(cat, PmsSelector.by_name(*ATHENA_APPS)).select("sync_db_id").distinct())
    rows = reuse(mapping_history_collapsed(cat("setting"), dbs))
    marked = mark_members(rows, S.still_synced_locations(rows, dbs), "location_id", "location_id", "_still")
    return marked.select(
        "sync_db_id", "location_id", "created_date_utc", "deleted_date_utc", F.col("_still").isNotNull().alias("still_synced")
    )


@query("derived_table")
def derived_table(spark, d):
    cat = _cat(spark, d)
    counts = cat("provider_location_mapping").groupBy(F.col("location_id").alias("_loc")).agg(
        F.count_distinct("provider_id").alias("n_providers")
    )
    loc = cat("location").select("location_id", "practice_id")
    return loc.join(counts, loc["location_id"] == counts["_loc"]).select("location_id", "practice_id", "n_providers")


@query("param_scalar")
def param_scalar(spark, d):
    cat = _cat(spark, d)
    pt, snap = cat.view("practice"), cat.view("practice_snapshot_summary_day")
    return spark.sql(
        f"""SELECT DISTINCT pt.practice_id, pt.name, pt.monolith_provider_id
            FROM {pt} pt JOIN {snap} s ON s.practice_id = pt.practice_id
            WHERE s.snapshot_date_eastern = :month""",
        args={"month": PARAM_MONTH},
    )


@query("param_tuple")
def param_tuple(spark, d):
    w = PARAM_WINDOW
    app = _cat(spark, d)("appointment_summary")
    return (
        app.filter(F.col("appointment_created_timestamp_local").between(at_midnight(w.start), at_midnight(w.end)))
        .groupBy("provider_id")
        .agg(F.count_distinct("appointment_id").alias("n_bookings"))
    )


@query("param_from_query")
def param_from_query(spark, d):
    """The first reported month comes from a query and bounds the bookings that are counted.

    Its bounds are uncorrelated scalar subqueries of the column's own type, so
    they are among the filters of the scan and the bookings meet no join.
    """
    cat = _cat(spark, d)
    m = F.min("snapshot_month_eastern")
    month = cat("practice_snapshot_summary_month").agg(
        m.cast("timestamp_ntz").alias("begin"), F.add_months(m, 1).cast("timestamp_ntz").alias("end"),
        F.last_day(m).alias("last_day"), days_in_month(m).alias("total_days_in_month"),
    )
    value = lambda c: month.select(c).scalar()
    booked = F.col("appointment_created_timestamp_local")
    inside = cat("appointment_summary").filter((booked >= value("begin")) & (booked < value("end")))
    counted = inside.groupBy("provider_id").agg(F.count_distinct("appointment_id").alias("n_bookings"))
    return counted.select(
        "provider_id", value("last_day").alias("last_day"), value("total_days_in_month").alias("total_days_in_month"), "n_bookings"
    )


@query("result_set")
def result_set(spark, d):
    return write_result(RP.report_parent_entities(_cat(spark, d)), "parent_entities")


# ----------------------------------------------------------- 2.2 projections
@query("project_alias")
def project_alias(spark, d):
    return _cat(spark, d)("provider").select(
        F.col("provider_id").alias("c_docter_id"),
        F.col("monolith_professional_id").alias("docter_id"),
        "status",
        F.col("monolith_provider_id").alias("d_practice_id"),
        F.col("practice_id").alias("c_practice_id"),
    )


@query("project_star")
def project_star(spark, d):
    return _cat(spark, d)("practice_derived_metrics").select("*")


@query("project_qualified_star")
def project_qualified_star(spark, d):
    cat = _cat(spark, d)
    return R.roster_labels(R.provider_enrichment(cat, R.bookable_provider_roster(cat, "is_bookable_legacy")).distinct())


@query("project_literal")
def project_literal(spark, d):
    app = _cat(spark, d)("appointment_summary")
    return app.filter(F.col("is_premium_booking")).select(
        "provider_id", "appointment_id", F.lit(RP.BOOKING_BUCKET).alias("bucket")
    )


@query("project_predicate")
def project_predicate(spark, d):
    return _cat(spark, d)("opportunity_index").select(
        "provider_id", "snapshot_date_est", F.col("latest_activation_end_timestamp_utc").isNull().alias("activation_open")
    )


@query("project_duplicate")
def project_duplicate(spark, d):
    return _cat(spark, d)("contact_vw").select(
        "professional_id__c", F.col("provider_id__c").alias("practice_id"), "provider_id__c"
    )


@query("lateral_alias_agg")
def lateral_alias_agg(spark, d):
    pv = _cat(spark, d).view("provider")
    return spark.sql(
        f"""SELECT practice_id,
                   count(DISTINCT CASE WHEN latest_activation_end_timestamp_utc IS NULL THEN provider_id END) AS num_active,
                   CASE WHEN num_active = 0 THEN max(latest_activation_end_timestamp_utc) END AS deactivated_at
            FROM {pv} GROUP BY practice_id"""
    )


@query("lateral_alias_window")
def lateral_alias_window(spark, d):
    """Window partitioned by the source column of an output alias (Spark
    rejects an alias there), numbered newest first without a hot-key task."""
    ex = _cat(spark, d)("provider_explorer_day_week_vw").select(
        F.col("provider_id").alias("c_docter_id"), "snapshot_date_eastern"
    )
    return occurrence_number(ex, ["c_docter_id"], "snapshot_date_eastern", "rownum", descending=True)


@query("unqualified_resolution")
def unqualified_resolution(spark, d):
    cat = _cat(spark, d)
    asd, pp, ssd = (
        cat.view("provider_location_availability_summary_day"),
        cat.view("provider"),
        cat.view("provider_location_sync_summary_day_vw"),
    )
    return spark.sql(
        f"""SELECT DISTINCT asd.provider_id, title, npi, main_specialty, sync_type
            FROM {asd} asd JOIN {pp} pp ON pp.provider_id = asd.provider_id
            JOIN {ssd} ssd ON ssd.provider_id = asd.provider_id"""
    )


@query("select_distinct")
def select_distinct(spark, d):
    return _cat(spark, d)("sync_overview_vw").select("pms_application", "sync_type").distinct()


# ----------------------------------------------------------- 2.3 filters
@query("filter_eq_const")
def filter_eq_const(spark, d):
    s = _cat(spark, d)("setting")
    return s.filter((F.col("setting_key_id") == 16) & (F.col("event_type") == ADDED))


@query("filter_in_strings")
def filter_in_strings(spark, d):
    return _cat(spark, d)("setting").filter(F.col("event_type").isin(ADDED, UPDATED))


@query("filter_in_ints")
def filter_in_ints(spark, d):
    cat = _cat(spark, d)
    latest = latest_setting(cat("setting"), cat("practice_management_software"), value_type="int")
    return latest.filter(F.col("pms_id").isin(11, 12))


@query("filter_not_in")
def filter_not_in(spark, d):
    """NOT IN a literal list of providers."""
    asd = _cat(spark, d)("provider_location_availability_summary_day").select("provider_id", "practice_id", "snapshot_date_eastern")
    return asd.filter(~F.col("provider_id").isin(*NO_AVAILABILITY_EXCLUDED))


@query("filter_not_in_relation")
def filter_not_in_relation(spark, d):
    """Exclusion list given as a DataFrame (providers who had appointments): anti join."""
    cat = _cat(spark, d)
    asd = cat("provider_location_availability_summary_day").select("provider_id", "practice_id", "snapshot_date_eastern")
    booked = cat("appointment_summary").select(F.col("provider_id").alias("_booked")).distinct()
    return asd.join(booked, asd["provider_id"] == booked["_booked"], "left_anti")


@query("filter_not_equal")
def filter_not_equal(spark, d):
    return _cat(spark, d)("provider_location_sync_summary_day_vw").filter(F.col("sync_type") != RP.MANUAL_SYNC)


@query("filter_null_check")
def filter_null_check(spark, d):
    loc = _cat(spark, d)("location")
    return loc.filter(F.col("fax").isNull() & F.col("software").isNotNull()).select("location_id", "software")


@query("filter_bool")
def filter_bool(spark, d):
    return _cat(spark, d)("provider_location_mapping").filter(F.col("is_active"))


@query("filter_bool_text")
def filter_bool_text(spark, d):
    """A flag delivered as mixed-case text ('True' / 'FALSE') is normalised at load."""
    pv = _cat(spark, d)("provider")
    as_text = pv.select(
        "provider_id",
        F.when(F.col("is_bookable_legacy"), F.lit("True")).otherwise(F.lit("FALSE")).alias("is_bookable_legacy"),
    )
    return normalise_flags("provider", as_text).filter(F.col("is_bookable_legacy")).select("provider_id")


@query("filter_numeric_gt")
def filter_numeric_gt(spark, d):
    return _cat(spark, d)("practice_snapshot_summary_month").filter(F.col("days_in_month_active") > 0)


@query("filter_period_eq")
def filter_period_eq(spark, d):
    snap = _cat(spark, d)("provider_location_snapshot_summary_month")
    return snap.filter(F.col("snapshot_month_eastern") == date_lit(PERIOD_MONTH))


@query("filter_open_range")
def filter_open_range(spark, d):
    asd = _cat(spark, d)("provider_location_availability_summary_day")
    return asd.filter(F.col("snapshot_date_eastern") > date_lit(OPEN_RANGE_FROM))


@query("filter_between")
def filter_between(spark, d):
    w = BOOKING_WINDOW
    app = _cat(spark, d)("appointment_summary")
    return app.filter(F.col("appointment_created_timestamp_local").between(at_midnight(w.start), at_midnight(w.end)))


@query("filter_ilike")
def filter_ilike(spark, d):
    loc = _cat(spark, d)("location")
    return loc.filter(F.col("software").ilike(RP.RAINTREE_PATTERN)).select("location_id", "software")


@query("filter_as_of_interval")
def filter_as_of_interval(spark, d):
    history = mapping_history_flat(_cat(spark, d)("setting"))
    return as_of(history, "created_date_utc", "deleted_date_utc", at_midnight(AS_OF_BOUNDARY))


@query("filter_currently_active")
def filter_currently_active(spark, d):
    return _active(_cat(spark, d)("provider")).select("provider_id", "practice_id")


@query("filter_and_or")
def filter_and_or(spark, d):
    oi = _cat(spark, d)("opportunity_index")
    two_way = (F.col("sync_type") == "Read/Write") | (F.col("sync_type") == "Read/Write/Track")
    return oi.filter(two_way & F.col("is_active")).select("provider_id", "snapshot_date_est", "sync_type")


@query("filter_tautology")
def filter_tautology(spark, d):
    return _cat(spark, d)("contact_vw").filter(F.lit(1) == F.lit(1))


@query("filter_null_rejecting_after_outer")
def filter_null_rejecting_after_outer(spark, d):
    """LEFT JOIN + filter on the right side = INNER JOIN; written as inner."""
    cat = _cat(spark, d)
    pp = cat("provider").select("provider_id", F.col("monolith_professional_id").alias("_prof"))
    oi = cat("opportunity_index").filter(
        F.col("snapshot_date_est").between(date_lit(OI_WINDOW.start), date_lit(OI_WINDOW.end))
    )
    return pp.join(oi, pp["_prof"] == oi["monolith_professional_id"]).select(
        pp["provider_id"], "snapshot_date_est", "number_of_new_patient_timeslots_28_days"
    )


# ----------------------------------------------------------- 2.4 joins
@query("join_inner_equi")
def join_inner_equi(spark, d):
    cat = _cat(spark, d)
    loc = cat("location").select("location_id", "practice_id")
    pt = cat("practice").select(F.col("practice_id").alias("_pt"), "name")
    return loc.join(pt, loc["practice_id"] == pt["_pt"]).select("location_id", "practice_id", "name")


@query("join_inner_multikey")
def join_inner_multikey(spark, d):
    cat = _cat(spark, d)
    snap = cat("provider_location_snapshot_summary_month").select("provider_id", "location_id", "snapshot_month_eastern")
    plm = cat("provider_location_mapping").select("provider_id", "location_id", "approval_status")
    return snap.join(plm, ["provider_id", "location_id"])


@query("join_inner_on_filter")
def join_inner_on_filter(spark, d):
    cat = _cat(spark, d)
    plm = cat("provider_location_mapping").filter(F.col("is_active") & (F.col("approval_status") == RP.APPROVED))
    pv = cat("provider").filter(~F.col("is_test")).select(F.col("provider_id").alias("_pv"), "practice_id")
    return plm.join(pv, plm["provider_id"] == pv["_pv"]).select("provider_id", "location_id", "practice_id")


@query("join_cast_key")
def join_cast_key(spark, d):
    cat = _cat(spark, d)
    s18 = cat("setting").filter(F.col("setting_key_id") == 18).select(
        "entity_id", "event_timestamp_utc", try_int("setting_value").alias("_pms_key")
    )
    pms = cat("practice_management_software")
    return s18.join(pms, pms["pms_id"] == s18["_pms_key"]).select("entity_id", "event_timestamp_utc", "pms_application")


@query("join_left_equi")
def join_left_equi(spark, d):
    cat = _cat(spark, d)
    pv = cat("provider").select("provider_id", "monolith_professional_id")
    c = cat("contact_vw").select("professional_id__c", "email")
    return fanout_left_join(pv, c, "monolith_professional_id", "professional_id__c").select("provider_id", "email")


@query("join_left_on_filter")
def join_left_on_filter(spark, d):
    cat = _cat(spark, d)
    pt = cat("practice").select("practice_id")
    pv = _active(cat("provider")).select("provider_id", F.col("practice_id").alias("_pv_practice"))
    return pt.join(pv, pt["practice_id"] == pv["_pv_practice"], "left").select("practice_id", "provider_id")


@query("join_left_multikey_ordinal")
def join_left_multikey_ordinal(spark, d):
    return paired_occurrences(_cat(spark, d)("setting"), created_types=(ADDED, UPDATED), deleted_types=(DELETED,))


@query("join_left_anti_range")
def join_left_anti_range(spark, d):
    """Each customer's latest orders: no later order of the same customer exists."""
    orders = _cat(spark, d).base.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return not_superseded(orders, orders, ["o_custkey"], "o_orderdate", "o_orderdate")


@query("join_non_equi_residual")
def join_non_equi_residual(spark, d):
    """Late shipments: equi join on the order key with a range residual."""
    b = _cat(spark, d).base
    li = b.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    o = b.orders.select("o_orderkey", "o_orderdate")
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.make_dt_interval(days=F.lit(LATE_SHIP_DAYS))
    return li.join(o, (li["l_orderkey"] == o["o_orderkey"]) & late).select(
        "l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"
    )


@query("join_mark")
def join_mark(spark, d):
    cat = _cat(spark, d)
    open_rows = mapping_history_collapsed(cat("setting")).filter(F.col("deleted_date_utc").isNull())
    loc = cat("location").select("location_id", "monolith_provider_location_id")
    return mark_members(loc, open_rows, "monolith_provider_location_id", "location_id", "open_mapping_location")


@query("join_semi_bloom")
def join_semi_bloom(spark, d):
    """Line items of open orders, by way of a Bloom filter in the scan (as if the orders were too many to broadcast)."""
    b = _cat(spark, d).base
    chosen = reuse(b.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey"))
    items = b.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return choose(items, "l_orderkey", chosen, "o_orderkey", broadcast_keys=0, words=BLOOM_WORDS)


@query("join_preaggregated")
def join_preaggregated(spark, d):
    cat = _cat(spark, d)
    counts = _active(cat("provider")).groupBy(F.col("practice_id").alias("_pt")).agg(
        F.count_distinct("provider_id").alias("num_active_providers")
    )
    pt = cat("practice").select("practice_id", "name")
    return pt.join(counts, pt["practice_id"] == counts["_pt"], "left").select("practice_id", "name", "num_active_providers")


@query("join_self")
def join_self(spark, d):
    pv = _cat(spark, d)("provider")
    a = pv.select("provider_id", F.col("monolith_professional_id").alias("_a"))
    b = pv.select(F.col("monolith_professional_id").alias("_b"), "npi", "practice_name")
    return a.join(b, a["_a"] == b["_b"]).select("provider_id", "npi", "practice_name")


@query("join_star")
def join_star(spark, d):
    cat = _cat(spark, d)
    so = cat("sync_overview_vw").select("location_id", "pms_application")
    plm = cat("provider_location_mapping").select(F.col("location_id").alias("_loc"), F.col("provider_id").alias("_pv"))
    pv = cat("provider").select("provider_id", F.col("practice_id").alias("_pt"))
    ent = cat("practice_parent_entity_mapping_vw").select(F.col("practice_id").alias("_ent"), "parent_entity_name")
    return (
        so.join(plm, so["location_id"] == plm["_loc"])
        .join(pv, plm["_pv"] == pv["provider_id"])
        .join(ent, pv["_pt"] == ent["_ent"])
        .select("parent_entity_name", "pms_application", "provider_id", "location_id")
    )


@query("join_bridge")
def join_bridge(spark, d):
    cat = _cat(spark, d)
    loc = cat("location").select("location_id")
    plm = cat("provider_location_mapping").select(F.col("location_id").alias("_loc"), F.col("provider_id").alias("_pv"))
    pv = cat("provider").select("provider_id", "practice_id")
    return (
        loc.join(plm, loc["location_id"] == plm["_loc"])
        .join(pv, plm["_pv"] == pv["provider_id"])
        .select("location_id", "provider_id", "practice_id")
    )


@query("join_fanout_distinct")
def join_fanout_distinct(spark, d):
    """Loose join on practice then DISTINCT — inputs reduced to DISTINCT keys first."""
    cat = _cat(spark, d)
    asd = cat("provider_location_availability_summary_day").select("provider_id", "practice_id").distinct()
    loc = cat("location").select(F.col("practice_id").alias("_pt"), "software").distinct()
    return asd.join(loc, asd["practice_id"] == loc["_pt"]).select("provider_id", "software").distinct()


@query("join_inner_drops_unmatched")
def join_inner_drops_unmatched(spark, d):
    cat = _cat(spark, d)
    c = cat("contact_vw").select("professional_id__c", "email")
    pv = cat("provider").select(F.col("monolith_professional_id").alias("_prof"), "npi")
    return c.join(pv, c["professional_id__c"] == pv["_prof"]).select("professional_id__c", "email", "npi")


# ----------------------------------------------------------- 2.5 aggregations
@query("group_by_ordinal")
def group_by_ordinal(spark, d):
    ent = _cat(spark, d).view("practice_parent_entity_mapping_vw")
    return spark.sql(
        f"SELECT parent_entity_name, count(DISTINCT practice_id) AS num_practices FROM {ent} GROUP BY 1"
    )


@query("group_by_named")
def group_by_named(spark, d):
    so = _cat(spark, d)("sync_overview_vw")
    return so.groupBy("pms_application", "sync_type").agg(F.min("most_recent_sync_timestamp_utc").alias("first_sync"))


@query("agg_min")
def agg_min(spark, d):
    ev = mapping_events(_cat(spark, d)("setting"), (ADDED, UPDATED))
    return ev.groupBy("location_id").agg(F.min("ts").alias("first_created"))


@query("agg_max")
def agg_max(spark, d):
    s = _cat(spark, d)("setting")
    return (
        s.filter((F.col("setting_key_id") == 18) & F.col("event_type").isin(ADDED, UPDATED))
        .groupBy("entity_id")
        .agg(F.max("event_timestamp_utc").alias("most_recent_created_or_updated_event"))
    )


@query("agg_count_distinct")
def agg_count_distinct(spark, d):
    plm = _cat(spark, d)("provider_location_mapping")
    return plm.groupBy("location_id").agg(F.count_distinct("provider_id").alias("num_providers"))


@query("agg_count_distinct_integer")
def agg_count_distinct_integer(spark, d):
    """Distinct integers counted by bitmap buckets."""
    return count_distinct_integers(_cat(spark, d)("appointment_summary"), ["provider_id"], "appointment_id", "num_appointments")


@query("agg_multi_distinct")
def agg_multi_distinct(spark, d):
    li = _cat(spark, d).base.lineitem
    return count_distinct_each(li, ["l_returnflag"], {"num_parts": "l_partkey", "num_suppliers": "l_suppkey"})


@query("agg_mixed_distinct")
def agg_mixed_distinct(spark, d):
    li = _cat(spark, d).base.lineitem
    return count_distinct_integers(
        li, ["l_returnflag", "l_linestatus"], "l_orderkey", "num_orders",
        {"first_ship": ("min", "l_shipdate"), "last_ship": ("max", "l_shipdate")},
    )


@query("agg_conditional_result")
def agg_conditional_result(spark, d):
    o = _cat(spark, d).base.orders
    agg = o.groupBy("o_custkey").agg(
        F.count_distinct(F.when(F.col("o_orderstatus") == "O", F.col("o_orderkey"))).alias("open_orders"),
        F.max("o_orderdate").alias("_last"),
    )
    return agg.select("o_custkey", "open_orders", F.when(F.col("open_orders") == 0, F.col("_last")).alias("last_order_date"))


@query("agg_latest_event_join")
def agg_latest_event_join(spark, d):
    return rows_at_latest(_cat(spark, d)("setting"))


@query("agg_with_literal")
def agg_with_literal(spark, d):
    app = _cat(spark, d)("appointment_summary")
    return (
        app.filter(F.col("is_premium_booking"))
        .groupBy("provider_id")
        .agg(F.count_distinct("appointment_id").alias("npbookingcount"))
        .withColumn("bucket", F.lit(RP.BOOKING_BUCKET))
    )


@query("agg_of_agg")
def agg_of_agg(spark, d):
    cat = _cat(spark, d)
    per_loc = cat("provider_location_mapping").groupBy(F.col("location_id").alias("_loc")).agg(
        F.count_distinct("provider_id").alias("_n")
    )
    loc = cat("location").select("location_id", "practice_id")
    return (
        loc.join(per_loc, loc["location_id"] == per_loc["_loc"])
        .groupBy("practice_id")
        .agg(F.max("_n").alias("max_providers_per_location"))
    )


@query("agg_distinct_redundant")
def agg_distinct_redundant(spark, d):
    so = _cat(spark, d).view("sync_overview_vw")
    return spark.sql(
        f"SELECT DISTINCT pms_application, count(DISTINCT location_id) AS num_locations FROM {so} GROUP BY 1"
    )


# ----------------------------------------------------------- 2.6 windows
@query("win_row_number_asc")
def win_row_number_asc(spark, d):
    ev = mapping_events(_cat(spark, d)("setting"), (ADDED,))
    return occurrence_number(ev, ["sync_db_id", "location_id"], "ts", "occurrence")


@query("win_row_number_hot")
def win_row_number_hot(spark, d):
    """Few keys with very many rows each: every key is split into ranges."""
    ev = _cat(spark, d).base.events.select("event_type", "ts")
    return occurrence_number(ev, ["event_type"], "ts", "occurrence", min_hot_rows=HOT_ROWS)


@query("win_partition_expr")
def win_partition_expr(spark, d):
    """Partition key is an expression (try_cast of the text value)."""
    ev = mapping_events(_cat(spark, d)("setting"), (DELETED,))
    return occurrence_number(ev, ["sync_db_id", "location_id"], "ts", "occurrence")


@query("win_row_number_desc")
def win_row_number_desc(spark, d):
    """Rank each provider's opportunity snapshots, newest first."""
    oi = _cat(spark, d)("opportunity_index").select("provider_id", "snapshot_date_est")
    return occurrence_number(oi, ["provider_id"], "snapshot_date_est", "rownum", descending=True)


@query("qualify_inline")
def qualify_inline(spark, d):
    return RP.latest_synced_pms_per_practice(_cat(spark, d), ADDRESS_WINDOW)


@query("qualify_alias")
def qualify_alias(spark, d):
    return R.latest_explorer_row(_cat(spark, d))


@query("qualify_and_predicate")
def qualify_and_predicate(spark, d):
    return R.latest_active_opportunity_row(_cat(spark, d))


@query("qualify_distinct")
def qualify_distinct(spark, d):
    return R.latest_explorer_row(_cat(spark, d)).select("c_docter_id", "account_segment", "rownum").distinct()


# ----------------------------------------------------------- 2.7 sorts, top-k, sets
@query("sort_result_desc")
def sort_result_desc(spark, d):
    app = _cat(spark, d)("appointment_summary")
    return (
        app.groupBy("provider_id")
        .agg(F.count_distinct("appointment_id").alias("n_appointments"))
        .orderBy(F.col("provider_id").desc())
    )


@query("sort_multi_mixed")
def sort_multi_mixed(spark, d):
    ex = _cat(spark, d)("provider_explorer_day_week_vw")
    return ex.select("provider_id", "snapshot_date_eastern", "account_segment").orderBy(
        "provider_id", F.col("snapshot_date_eastern").desc()
    )


@query("sort_in_subquery")
def sort_in_subquery(spark, d):
    """An ORDER BY inside a subquery feeding a join has no effect; Catalyst drops it."""
    cat = _cat(spark, d)
    roster = R.bookable_provider_roster(cat, "is_bookable_legacy").orderBy("last_name")
    c = cat("contact_vw").select("professional_id__c", "email")
    return roster.join(c, roster["docter_id"] == c["professional_id__c"], "left").select("c_docter_id", "email")


@query("top1_per_group")
def top1_per_group_query(spark, d):
    o = _cat(spark, d).base.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return top1_per_group(o, ["o_custkey"], ["o_orderdate"], ["o_orderkey"])


@query("union_distinct")
def union_distinct_query(spark, d):
    b = _cat(spark, d).base
    return union_distinct(
        b.customer.select(F.col("c_nationkey").alias("nationkey")),
        b.supplier.select(F.col("s_nationkey").alias("nationkey")),
    )


# ----------------------------------------------------------- 2.8 scalar functions
def _values(spark, d, key):
    return _cat(spark, d)("setting").filter(F.col("setting_key_id") == key)


@query("fn_try_cast_bigint")
def fn_try_cast_bigint(spark, d):
    return _values(spark, d, 16).select("setting_value", try_bigint("setting_value").alias("sync_db_id")).distinct()


@query("fn_try_cast_int")
def fn_try_cast_int(spark, d):
    return _values(spark, d, 18).select("setting_value", try_int("setting_value").alias("pms_id")).distinct()


@query("fn_try_cast_noop")
def fn_try_cast_noop(spark, d):
    return _values(spark, d, 16).select("entity_id", try_bigint(try_bigint("setting_value")).alias("sync_db_id")).distinct()


@query("fn_cast_date")
def fn_cast_date(spark, d):
    ev = _cat(spark, d).base.events
    return ev.select(F.to_date(F.date_format("ts", "yyyy-MM-dd")).alias("event_date")).distinct()


@query("fn_last_day")
def fn_last_day(spark, d):
    return _cat(spark, d).base.orders.select(F.last_day("o_orderdate").alias("month_end")).distinct()


@query("fn_day")
def fn_day(spark, d):
    o = _cat(spark, d).base.orders
    return o.select(
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month_start"),
        days_in_month(F.col("o_orderdate").cast("date")).alias("days_in_month"),
    ).distinct()


@query("fn_add_months")
def fn_add_months(spark, d):
    m = F.col("snapshot_month_eastern")
    snap = _cat(spark, d)("practice_snapshot_summary_month")
    return snap.select(m, F.add_months(m, 1).alias("next_month")).distinct()


@query("fn_dateadd_day")
def fn_dateadd_day(spark, d):
    oi = _cat(spark, d)("opportunity_index")
    return oi.select("snapshot_date_est", F.date_add("snapshot_date_est", 1).alias("next_day")).distinct()


@query("fn_case_pms")
def fn_case_pms(spark, d):
    oi = _cat(spark, d)("opportunity_index")
    return oi.select(
        "provider_id",
        "snapshot_date_est",
        resolve_pms(
            F.col("sync_id"),
            F.col("sync_type"),
            F.col("synced_practice_management_system"),
            F.col("practice_management_system_listed_on_dsp"),
        ).alias("pms"),
    )


@query("fn_case_sync_type")
def fn_case_sync_type(spark, d):
    oi = _cat(spark, d)("opportunity_index")
    return oi.select("provider_id", "snapshot_date_est", "sync_type", sync_type_label(F.col("sync_type")).alias("f_sync_type"))


@query("fn_implicit_coercion")
def fn_implicit_coercion(spark, d):
    """A DATE bound against a TIMESTAMP column, made explicit (promoted to midnight)."""
    pv = _cat(spark, d)("provider")
    return pv.filter(F.col("latest_activation_end_timestamp_utc") > at_midnight(COERCION_BOUND)).select(
        "provider_id", "latest_activation_end_timestamp_utc"
    )
