import __spark_entry__ as E
from accrualkit.plans.registry import all_queries
from accrualkit_oracle.registry import all_sql


def test_entry_runs_with_stable_schema(spark):
    a = E.entry(spark)
    b = E.entry(spark)
    assert a.schema == b.schema
    assert a.count() >= 1


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert len(q) >= 100
    assert set(s) <= set(q)
    assert set(all_sql()) == set(all_queries())  # only the training-data operators may lack SQL
    for name, sql in s.items():
        assert sql.strip().lower().startswith(("with", "select")), name


def test_date_outputs_are_listed_and_delivered_as_timestamps(spark):
    from accrualkit.plans.registry import all_queries
    from accrualkit_oracle.registry import DATE_COLUMNS

    raw = all_queries()
    found = {}
    for name, fn in raw.items():
        cols = tuple(f.name for f in fn(spark, "/root/testdata/sf0.001").schema.fields if f.dataType.typeName() == "date")
        if cols:
            found[name] = cols
    assert found == DATE_COLUMNS
    delivered = E.queries()["fn_add_months"](spark, "/root/testdata/sf0.001")
    assert dict(delivered.dtypes)["next_month"] == "timestamp_ntz"
