"""The mapping log bucketed, merged month by month, chosen by a Bloom filter, and asked about many months."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from accrualkit.constants import LOCATION_SETTING_KEY
from accrualkit.operators import bloom, ordinal
from accrualkit.operators.distinct import count_distinct_each, count_distinct_integers
from accrualkit.operators.event_log import location_events, mapping_history_collapsed, mapping_history_flat, pair_events, store_location_events
from accrualkit.operators.temporal import as_of_each, valid_at
from accrualkit.plans import months as M
from accrualkit.plans import reports as RP
from accrualkit.plans.mapping_state import MappingState
from accrualkit.plans.materialize import register_view, reuse, run_scope
from accrualkit.plans.registry import all_queries
from accrualkit.plans.registry_params import DENTICON
from accrualkit.session import checkpoint_dir
from accrualkit.sources.catalog import SourceCatalog
from helpers import plan_text

SF = "/root/testdata/sf0.001"
BEGIN = dt.datetime(2024, 1, 1)


def tree(df):
    return plan_text(df).split("\n\n")[0]


def exchanges(df):
    return [line for line in tree(df).splitlines() if "Exchange" in line]


def log_frame(spark, rows):
    """rows: (database text, location, event type, minute or None)."""
    full = [(LOCATION_SETTING_KEY, loc, db, kind, None if t is None else BEGIN + dt.timedelta(minutes=t)) for db, loc, kind, t in rows]
    return spark.createDataFrame(full, "setting_key_id int, entity_id string, setting_value string, event_type string, event_timestamp_utc timestamp_ntz")


def random_log(rng, n):
    dbs, locs = ["1", "2", "3", "bad", None], ["a", "b", "c", None]
    return [(rng.choice(dbs), rng.choice(locs), rng.choice(["Added", "Deleted", "Updated"]), rng.choice([None, *range(60)])) for _ in range(n)]


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


# ------------------------------------------------------------------ frequent keys
def test_the_summary_is_all_that_numbering_shuffles_besides_the_window(spark, monkeypatch):
    """No hot key: the rows of the log are exchanged once in all jobs, building included."""
    summaries = []

    def spy(df, keys, tracked):
        summaries.append(frequent(df, keys, tracked))
        return summaries[-1]

    frequent = ordinal.frequent_keys
    monkeypatch.setattr(ordinal, "frequent_keys", spy)
    setting = SourceCatalog.from_testdata(spark, SF)("setting")
    history = mapping_history_flat(setting)
    assert len(summaries) == 1
    lines = tree(summaries[0]).splitlines()
    deepest = max(i for i, line in enumerate(lines) if "Exchange" in line)
    # rows are summarised below the first exchange, so that only summaries go through it
    assert any("ObjectHashAggregate" in line for line in lines[deepest + 1 :])
    assert len(exchanges(history)) == 1


def test_every_key_above_the_bound_is_found(spark):
    rng = random.Random(5)
    sizes = {f"hot{i}": rng.randrange(300, 900) for i in range(12)} | {f"k{i}": rng.randrange(1, 4) for i in range(3000)} | {None: 500}
    rows = [(k,) for k, n in sizes.items() for _ in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string").repartition(5)
    tracked = 200
    found = ordinal.frequent_keys(df, ["k"], tracked).first()
    assert found["n"] == len(rows)
    counts = {x["item"]: x["count"] for x in found["found"]}
    by_hash = {r["h"]: sizes[r["k"]] for r in df.select("k", ordinal.key_hash(["k"]).alias("h")).distinct().collect()}
    bound = 7 * len(rows) / tracked
    assert {h for h, n in by_hash.items() if n > bound} <= set(counts)
    assert all(by_hash[h] <= n <= by_hash[h] + 3.5 * len(rows) / tracked for h, n in counts.items())


def test_empty_and_all_null_logs(spark):
    for rows in ([], [(None, None, "Added", None)] * 3):
        out = mapping_history_flat(log_frame(spark, rows)).collect()
        assert len(out) == len(rows)


def test_too_many_hot_keys_are_refused(spark):
    with pytest.raises(ValueError):
        ordinal.hot_keys(spark.range(3), ["id"], 1, 10**6)


# ------------------------------------------------------------------ buckets
def test_a_bucketed_log_needs_no_shuffle(spark):
    setting = SourceCatalog.from_testdata(spark, SF)("setting")
    path = f"{checkpoint_dir(spark)}/bucket-test"
    log = store_location_events(setting, "mapping_log_test", 4, path)
    try:
        pairs = pair_events(log, placed=True)
        assert exchanges(pairs) == []
        collapsed = pair_events(log, created_types=("Added", "Updated"), placed=True).groupBy("sync_db_id", "location_id").agg(
            F.min("created_date_utc").alias("created_date_utc"), F.max("deleted_date_utc").alias("deleted_date_utc")
        )
        assert exchanges(collapsed) == []
        assert bag(pairs.drop("occurrence")) == bag(mapping_history_flat(setting))
        assert bag(collapsed) == bag(mapping_history_collapsed(setting))
    finally:
        spark.sql("DROP TABLE mapping_log_test")


# ------------------------------------------------------------------ state
@pytest.mark.parametrize("seed", range(2))
def test_merged_history_equals_the_full_one(spark, tmp_path, seed):
    rng = random.Random(seed)
    log = random_log(rng, 120)
    cuts = sorted(rng.sample(range(20, 120), 2))
    if seed:  # mostly in order, with a few late events; seed 0 is in no order at all
        log.sort(key=lambda r: (r[3] is None, r[3] or 0))
        for _ in range(4):
            log.append(log.pop(rng.randrange(60)))
    events = location_events(log_frame(spark, log).coalesce(1).withColumn("n", F.monotonically_increasing_id()).drop("n"))
    parts = [location_events(log_frame(spark, log[low:high])) for low, high in zip([0, *cuts], [*cuts, len(log)], strict=True)]
    state = MappingState.start(parts[0], str(tmp_path / "state"))
    upto = parts[0]
    for part in parts[1:]:
        upto = upto.unionByName(part)
        state = state.merge(part, upto)
        assert bag(state.history()) == bag(pair_events(upto).drop("occurrence"))
    assert bag(state.history()) == bag(pair_events(events).drop("occurrence"))


def test_merging_reads_the_log_for_late_keys_only(spark, tmp_path):
    first = location_events(log_frame(spark, [("1", "a", "Added", 1), ("1", "a", "Deleted", 5), ("2", "b", "Added", 3), ("3", "c", "Deleted", 2)]))
    state = MappingState.start(first, str(tmp_path / "state"))
    # on time: the log is not needed, so an empty one will do
    batch = location_events(log_frame(spark, [("2", "b", "Deleted", 9), ("3", "c", "Added", 4), ("1", "a", "Added", 8)]))
    merged = state.merge(batch, batch.limit(0))
    whole = first.unionByName(batch)
    assert bag(merged.history()) == bag(pair_events(whole).drop("occurrence"))
    assert bag(state.history()) == bag(pair_events(first).drop("occurrence"))  # the version before is untouched
    late = location_events(log_frame(spark, [("1", "a", "Added", 0)]))
    again = merged.merge(late, whole.unionByName(late))
    assert bag(again.history()) == bag(pair_events(whole.unionByName(late)).drop("occurrence"))
    assert merged.merge(batch.limit(0), whole).history().count() == merged.history().count()


# ------------------------------------------------------------------ Bloom filter
def test_chosen_rows_are_the_same_by_broadcast_and_by_filter(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    chosen = reuse(spark.range(0, 5000, 7).select(F.col("id").alias("c")).unionByName(spark.range(3).select(F.lit(None).cast("long").alias("c"))))
    wanted = bag(rows.filter("k % 7 = 0"))
    assert bag(bloom.choose(rows, "k", chosen, "c")) == wanted
    assert bag(bloom.choose(rows, "k", chosen, "c", broadcast_keys=0, words=256)) == wanted
    empty = reuse(chosen.limit(0))
    assert bloom.choose(rows, "k", empty, "c", broadcast_keys=-1, words=64).count() == 0


def test_the_filter_lets_few_others_pass(spark):
    keys = reuse(spark.range(0, 4000, 2).select(F.col("id").alias("k")))
    words = bloom.bloom_filter(keys, "k", 1024).scalar()
    passed = spark.range(4000).filter(bloom.may_hold(words, F.col("id"), 1024))
    assert passed.filter("id % 2 = 0").count() == 2000
    assert passed.filter("id % 2 = 1").count() < 100


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def below_the_first_exchange(df):
    lines = tree(df).splitlines()
    return "\n".join(lines[next(i for i, line in enumerate(lines) if "Exchange" in line) :])


def test_the_filter_is_below_the_first_exchange(spark, no_broadcast):
    query = all_queries()["join_semi_bloom"](spark, SF)
    assert "LeftSemi" in tree(query)
    assert "Filter" in below_the_first_exchange(query)
    condition = next(part for part in plan_text(query).split("\n\n") if ") Filter" in part and "xxhash64(l_orderkey" in part)
    assert "Subquery" in condition


@pytest.mark.parametrize("report", ["r1", "r2"])
def test_reports_by_a_large_selection_equal_those_by_broadcast(spark, monkeypatch, no_broadcast, report):
    from accrualkit.operators import event_log

    cat = SourceCatalog.from_testdata(spark, SF)
    build = {
        "r1": lambda: RP.report_api_practices(cat, ["Athena", "AthenaAPI"]),
        "r2": lambda: RP.report_active_locations(cat, "2024-03-01", DENTICON, "day"),
    }[report]
    want, seen = bag(build()), []

    def large(*args):
        seen.append(bloom.choose(*args, broadcast_keys=0, words=512))
        return seen[-1]

    monkeypatch.setattr(event_log, "choose", large)
    assert bag(build()) == want and len(seen) == 1
    assert "Filter" in below_the_first_exchange(seen[0]) and "Subquery" in plan_text(seen[0])


# ------------------------------------------------------------------ many months
def test_binned_as_of_equals_one_by_one(spark):
    rng = random.Random(2)
    day = lambda: rng.choice([None, *[BEGIN + dt.timedelta(days=rng.randrange(-400, 800), hours=rng.randrange(24)) for _ in range(6)]])
    df = spark.createDataFrame([(i, day(), day()) for i in range(300)], "id long, s timestamp_ntz, e timestamp_ntz")
    bounds = [BEGIN + dt.timedelta(days=30 * i) for i in range(12)] + [None]
    boundaries = spark.createDataFrame([(b,) for b in [*bounds, bounds[0]]], "b timestamp_ntz")
    got = bag(as_of_each(df, "s", "e", boundaries, "b").select("b", "id"))
    want = [(b, r["id"]) for b in bounds[:-1] for r in df.collect() if r["s"] and r["s"] < b and (r["e"] is None or r["e"] > b)]
    assert got == sorted(want, key=repr)
    assert as_of_each(df, "s", "e", boundaries.limit(0), "b").count() == 0


def test_binned_as_of_reads_the_rows_once(spark):
    df = reuse(spark.range(5).select("id", F.lit(BEGIN).alias("s"), F.lit(None).cast("timestamp_ntz").alias("e")))
    months = reuse(spark.createDataFrame([(BEGIN + dt.timedelta(days=40),)], "b timestamp_ntz"))
    plan = tree(as_of_each(df, "s", "e", months, "b"))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    one = df.filter(valid_at("s", "e", F.lit(BEGIN + dt.timedelta(days=40)).cast("timestamp_ntz"))).count()
    assert as_of_each(df, "s", "e", months, "b").count() == one == 5


@pytest.mark.parametrize("activity", ["day", "month"])
def test_two_months_in_one_pass_equal_two_runs(spark, monkeypatch, activity):
    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.01")
    numbered, plain = [], ordinal.occurrence_number
    from accrualkit.operators import event_log

    monkeypatch.setattr(event_log, "occurrence_number", lambda *a, **k: numbered.append(1) or plain(*a, **k))
    months = ("2024-01-01", "2024-03-01")
    both = M.report_active_locations_of_months(cat, months, DENTICON, activity)
    assert len(numbered) == 1
    columns = [c for c in both.columns if c != "report_month"]
    for month in months:
        one = RP.report_active_locations(cat, month, DENTICON, activity).select(*columns)
        assert bag(both.filter(F.col("report_month") == F.lit(month).cast("date")).select(*columns)) == bag(one)


# ------------------------------------------------------------------ distinct, parameters, marks
def test_bitmap_counts_equal_count_distinct(spark):
    rng = random.Random(4)
    values = [None, 0, -1, -32768, -32769, 32767, 32768, 2**62, *range(100, 160)]
    df = spark.createDataFrame([(rng.choice(["x", "y", None]), rng.choice(values), rng.choice(values)) for _ in range(500)] + [("z", None, None)], "k string, a long, b long")
    want = df.groupBy("k").agg(F.count_distinct("a").alias("n_a"), F.count_distinct("b").alias("n_b"), F.min("a").alias("low"), F.max("b").alias("high"))
    each = count_distinct_each(df, ["k"], {"n_a": "a", "n_b": "b"})
    assert bag(each.select("k", "n_a", "n_b")) == bag(want.select("k", "n_a", "n_b"))
    one = count_distinct_integers(df, ["k"], "a", "n_a", {"low": ("min", "a"), "high": ("max", "b")})
    assert bag(one.select("k", "n_a", "low", "high")) == bag(want.select("k", "n_a", "low", "high"))
    for name in ("agg_multi_distinct", "agg_mixed_distinct"):
        assert "Expand" not in tree(all_queries()[name](spark, SF))


def test_a_queried_bound_reaches_the_scan(spark):
    text = plan_text(all_queries()["param_from_query"](spark, SF))
    main = text.split("Subqueries")[0]
    assert "Join" not in main
    scan = next(part for part in main.split("\n\n") if "Scan parquet" in part and "appointment_created" in part)
    pushed = [line for line in scan.splitlines() if "Filters" in line]
    assert any("appointment_created_timestamp_local" in line for line in pushed)
    condition = next(part for part in main.split("\n\n") if ") Filter" in part and "Condition" in part)
    assert "cast(appointment_created" not in condition and condition.count("Subquery") >= 2
    assert any("Hosting operator id = 1 " in line for line in text.splitlines())  # the scan itself holds them


def test_marks_are_an_existence_join(spark):
    text = tree(all_queries()["join_mark"](spark, SF))
    assert "ExistenceJoin" in plan_text(all_queries()["join_mark"](spark, SF)) and "Window" in text


# ------------------------------------------------------------------ scratch
@pytest.mark.parametrize("fails", [False, True])
def test_a_run_leaves_nothing_behind(spark, fails):
    import os

    root = checkpoint_dir(spark).replace("file:", "")
    files = lambda: {os.path.join(base, f) for base, _, names in os.walk(root) for f in names}
    cat = SourceCatalog.from_testdata(spark, SF)
    for name in ("setting", "provider"):
        cat(name)  # stand-ins are stored tables, not part of a run
    files_before, views_before = files(), {t.name for t in spark.catalog.listTables()}
    try:
        with run_scope(spark) as scope:
            cat.view("provider")
            register_view(reuse(mapping_history_flat(cat("setting"))), "history_of_the_run")
            assert files() > files_before and os.path.isdir(scope.path.replace("file:", ""))
            with run_scope(spark) as inner:
                reuse(spark.range(3))
            assert not os.path.exists(inner.path.replace("file:", ""))
            if fails:
                raise RuntimeError("the run fails")
    except RuntimeError:
        assert fails
    assert files() == files_before and {t.name for t in spark.catalog.listTables()} == views_before
    assert not os.path.exists(scope.path.replace("file:", ""))
