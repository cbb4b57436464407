"""Every registered query against its DuckDB oracle (row count, column
names, order-insensitive values)."""

import pytest

import __spark_entry__ as E
from accrualkit.plans.registry import all_queries
from accrualkit_oracle.registry import DATE_COLUMNS, all_sql
from tools.oracle_check import compare, duck

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"
SQL = all_sql()
QUERIES = {name: fn for name, fn in E.queries().items() if name in SQL}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL) == set(all_queries())


@pytest.fixture(scope="module")
def duck_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def duck_check():
    return duck(SF_CHECK)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_small(spark, duck_small, name):
    sdf = QUERIES[name](spark, SF_SMALL).toPandas()
    odf = duck_small.execute(SQL[name]).df()
    ok, msg = compare(name, sdf, odf)
    assert ok, msg


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n.startswith("report_")))
def test_report_matches_oracle_sf001(spark, duck_check, name):
    sdf = QUERIES[name](spark, SF_CHECK).toPandas()
    odf = duck_check.execute(SQL[name]).df()
    ok, msg = compare(name, sdf, odf)
    assert ok, msg
    assert len(sdf) > 0


TZ_SENSITIVE = ["filter_between", "param_tuple", "active_syncs_as_of", "report_bookings_ep", "filter_as_of_interval"]


@pytest.mark.parametrize("name", TZ_SENSITIVE)
def test_results_do_not_depend_on_session_time_zone(spark, duck_check, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        sdf = QUERIES[name](spark, SF_CHECK).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    ok, msg = compare(name, sdf, duck_check.execute(SQL[name]).df())
    assert ok, msg


def test_raw_types_of_date_columns(spark, duck_small):
    """Before delivery as timestamps, both sides have DATE columns."""
    raw_sql, raw = all_sql(raw_dates=True), all_queries()
    for name, columns in DATE_COLUMNS.items():
        described = {r[0]: r[1] for r in duck_small.execute(f"describe {raw_sql[name]}").fetchall()}
        types = dict(raw[name](spark, SF_SMALL).dtypes)
        for c in columns:
            assert (described[c], types[c]) == ("DATE", "date"), (name, c)
