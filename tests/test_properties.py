"""Hypothesis-generated inputs checked against pure-Python brute force."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from accrualkit.operators.event_log import mapping_history_flat
from accrualkit.operators.joins import fanout_left_join, not_superseded
from helpers import SETTING_SCHEMA

SETTINGS = dict(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

stamps = st.one_of(st.none(), st.integers(0, 6).map(lambda h: dt.datetime(2024, 1, 1, h)))
events = st.lists(
    st.tuples(
        st.sampled_from(["L1", "L2", None]),
        st.sampled_from(["7", "8", "n/a", None]),
        st.sampled_from(["Added", "Updated", "Deleted"]),
        stamps,
    ),
    max_size=40,
)


def _db(v):
    return int(v) if v is not None and v.isdigit() else None


def brute_flat(rows, created=("Added",), deleted=("Deleted",)):
    def ordered(types):
        groups = {}
        for loc, val, kind, ts in rows:
            if kind in types:
                groups.setdefault((_db(val), loc), []).append(ts)
        # ascending, NULL timestamps last
        return {k: sorted(v, key=lambda t: (t is None, t or dt.datetime.min)) for k, v in groups.items()}

    c, d = ordered(created), ordered(deleted)
    out = []
    for (db, loc), stamps_ in c.items():
        dels = d.get((db, loc), []) if db is not None and loc is not None else []
        for n, ts in enumerate(stamps_):
            out.append((db, loc, ts, dels[n] if n < len(dels) else None))
    return sorted(out, key=repr)


@settings(**SETTINGS)
@given(events)
def test_flat_history_matches_brute_force(spark, rows):
    df = spark.createDataFrame([(16, loc, val, kind, ts) for loc, val, kind, ts in rows], SETTING_SCHEMA)
    got = sorted(
        ((r.sync_db_id, r.location_id, r.created_date_utc, r.deleted_date_utc) for r in mapping_history_flat(df).collect()),
        key=repr,
    )
    assert got == brute_flat(rows)


pairs = st.lists(st.tuples(st.sampled_from(["a", "b", None]), stamps), max_size=25)


@settings(**SETTINGS)
@given(pairs, pairs)
def test_not_superseded_matches_brute_force(spark, ev, sup):
    e = spark.createDataFrame(ev, "k string, t timestamp_ntz")
    s = spark.createDataFrame(sup, "k string, t timestamp_ntz")
    got = sorted(((r.k, r.t) for r in not_superseded(e, s, ["k"], "t", "t").collect()), key=repr)
    expected = sorted(
        [(k, t) for k, t in ev if not any(k is not None and k == k2 and t is not None and t2 is not None and t2 > t for k2, t2 in sup)],
        key=repr,
    )
    assert got == expected


keys = st.lists(st.sampled_from([1, 2, 3, None]), max_size=15)


@settings(**SETTINGS)
@given(keys, keys)
def test_fanout_left_join_matches_brute_force(spark, left_keys, right_keys):
    left = spark.createDataFrame([(i, k) for i, k in enumerate(left_keys)], "id int, k int")
    right = spark.createDataFrame([(k, j) for j, k in enumerate(right_keys)], "rk int, j int")
    got = sorted(((r.id, r.k, r.rk, r.j) for r in fanout_left_join(left, right, "k", "rk").collect()), key=repr)
    expected = []
    for i, k in enumerate(left_keys):
        matches = [(rk, j) for j, rk in enumerate(right_keys) if k is not None and rk == k]
        expected += [(i, k, rk, j) for rk, j in matches] or [(i, k, None, None)]
    assert got == sorted(expected, key=repr)
