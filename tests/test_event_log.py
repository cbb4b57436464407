"""Edge cases of the event-log operators on tiny hand-written logs."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from accrualkit.operators.event_log import latest_setting, mapping_history_collapsed, mapping_history_flat
from accrualkit.operators.ordinal import occurrence_number
from helpers import rows, setting_df, ts


def pms(spark):
    return spark.createDataFrame([(10, "Nextech"), (11, "Eaglesoft"), (12, "EaglesoftCloud")], "pms_id int, pms_application string")


def test_malformed_value_never_pairs(spark):
    log = setting_df(
        spark,
        [
            (16, "L1", "n/a", "Added", ts(1)),
            (16, "L1", "n/a", "Deleted", ts(2)),
            (16, "L1", "7", "Added", ts(3)),
        ],
    )
    got = rows(mapping_history_flat(log), "sync_db_id", "location_id", "created_date_utc", "deleted_date_utc")
    # NULL sync DB keeps its create row but never matches a delete
    assert got == sorted([(None, "L1", ts(1), None), (7, "L1", ts(3), None)], key=repr)


def test_delete_before_create_pairs_by_ordinal(spark):
    log = setting_df(spark, [(16, "L1", "7", "Deleted", ts(1)), (16, "L1", "7", "Added", ts(5))])
    got = rows(mapping_history_flat(log), "created_date_utc", "deleted_date_utc")
    assert got == [(ts(5), ts(1))]


def test_more_deletes_than_creates(spark):
    log = setting_df(
        spark,
        [
            (16, "L1", "7", "Added", ts(1)),
            (16, "L1", "7", "Deleted", ts(2)),
            (16, "L1", "7", "Deleted", ts(3)),
        ],
    )
    assert rows(mapping_history_flat(log), "created_date_utc", "deleted_date_utc") == [(ts(1), ts(2))]


def test_readd_after_delete_keeps_delete_in_collapsed_history(spark):
    log = setting_df(
        spark,
        [
            (16, "L1", "7", "Added", ts(1)),
            (16, "L1", "7", "Deleted", ts(2)),
            (16, "L1", "7", "Updated", ts(3)),
        ],
    )
    got = rows(mapping_history_collapsed(log), "sync_db_id", "location_id", "created_date_utc", "deleted_date_utc")
    assert got == [(7, "L1", ts(1), ts(2))]


def test_flat_history_counts_only_added_as_create(spark):
    log = setting_df(spark, [(16, "L1", "7", "Added", ts(1)), (16, "L1", "7", "Updated", ts(2))])
    assert len(mapping_history_flat(log).collect()) == 1
    assert len(mapping_history_flat(log, created_types=("Added", "Updated")).collect()) == 2


def test_latest_setting_keeps_ties_and_ignores_older(spark):
    log = setting_df(
        spark,
        [
            (18, "5", "10", "Added", ts(1)),
            (18, "5", "11", "Updated", ts(4)),
            (18, "5", "12", "Updated", ts(4)),
            (18, "6", "10", "Added", ts(2)),
            (18, "6", "oops", "Updated", ts(3)),
            (16, "5", "99", "Added", ts(9)),
        ],
    )
    got = rows(latest_setting(log, pms(spark)), "sync_db_id", "pms_id")
    # DB 5: both values at the tied latest timestamp; DB 6: latest value is
    # malformed, so it has no PMS at all (no fallback to the older row)
    assert got == [(5, 11), (5, 12)]


def test_latest_setting_counts_any_event_type_at_latest_time(spark):
    log = setting_df(
        spark,
        [(18, "5", "10", "Added", ts(1)), (18, "5", "11", "Deleted", ts(1))],
    )
    assert rows(latest_setting(log, pms(spark)), "pms_id") == [(10,), (11,)]


def test_occurrence_number_matches_row_number_on_hot_key(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randint(0, 20)}"
        day, hour = rnd.randint(1, 28), rnd.randint(0, 23)
        data.append((key if rnd.random() > 0.02 else None, ts(day, hour), i))
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id long")
    # 'hot' holds 60% of the rows: with a threshold of 100 rows it is split
    # into ranges here, the other keys (and the NULL key) stay cold
    mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=100)
    w = Window.partitionBy("k").orderBy("t")
    plain = df.withColumn("n", F.row_number().over(w).cast("int"))
    # ties share (k, t), so compare the multiset of (k, t, n)
    assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n")
    assert mine.count() == 3000


def test_occurrence_number_independent_of_session_time_zone(spark):
    data = [("k", ts(d, h)) for d in (9, 10, 11) for h in (0, 1, 2, 3, 23)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz")
    before = rows(occurrence_number(df, ["k"], "t", "n", min_hot_rows=2), "t", "n")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        after = rows(occurrence_number(df, ["k"], "t", "n", min_hot_rows=2), "t", "n")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert before == after
    assert [n for _, n in sorted(before)] == list(range(1, 16))


def test_pairing_matches_naive_join_formulation(spark):
    rnd = random.Random(5)
    data = []
    for _ in range(600):
        loc = rnd.choice(["L1", "L2", "L3", None])
        db = rnd.choice(["7", "8", "n/a", None])
        kind = rnd.choice(["Added", "Updated", "Deleted", "Deleted"])
        data.append((16, loc, db, kind, ts(rnd.randint(1, 5), rnd.randint(0, 3))))
    log = setting_df(spark, data)
    mine = mapping_history_flat(log, created_types=("Added", "Updated"))

    def numbered(types, p):
        ev = log.filter(F.col("event_type").isin(*types)).select(
            F.col("setting_value").try_cast("bigint").alias(f"{p}db"),
            F.col("entity_id").alias(f"{p}loc"),
            F.col("event_timestamp_utc").alias(f"{p}ts"),
        )
        w = Window.partitionBy(f"{p}db", f"{p}loc").orderBy(f"{p}ts")
        return ev.withColumn(f"{p}n", F.row_number().over(w))

    c, d = numbered(("Added", "Updated"), "c_"), numbered(("Deleted",), "d_")
    cond = (F.col("c_db") == F.col("d_db")) & (F.col("c_loc") == F.col("d_loc")) & (F.col("c_n") == F.col("d_n"))
    naive = c.join(d, cond, "left").select("c_db", "c_loc", "c_ts", "d_ts")
    assert rows(mine) == rows(naive)


def test_hot_key_threshold_bounds_the_hot_set():
    from accrualkit.operators.ordinal import hot_key_threshold

    assert hot_key_threshold(1_000, 100, 10) == 100
    assert hot_key_threshold(10**12, 100_000, 10_000) == 10**8
    # no more than max_hot_keys keys can exceed the threshold
    total, t = 10**9 + 7, hot_key_threshold(10**9 + 7, 10, 1000)
    assert total // (t + 1) <= 1000


def test_occurrence_number_descending_matches_row_number_desc(spark):
    rnd = random.Random(9)
    data = [("hot" if rnd.random() < 0.7 else f"k{rnd.randint(0, 5)}", ts(rnd.randint(1, 28), rnd.randint(0, 23))) for _ in range(2000)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz")
    mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=50, descending=True)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.col("t").desc())).cast("int"))
    assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n")


def test_occurrence_number_null_timestamps_in_hot_key_sort_last(spark):
    data = [("hot", ts(d, h)) for d in range(1, 6) for h in range(0, 4)] + [("hot", None)] * 3 + [("cold", None), ("cold", ts(1))]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz")
    for desc in (False, True):
        order = F.col("t").desc_nulls_last() if desc else F.col("t").asc_nulls_last()
        mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=5, descending=desc)
        plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(order)).cast("int"))
        assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n"), desc


def test_ranges_match_row_number_on_hot_key(spark):
    rnd = random.Random(17)
    data = []
    for i in range(4000):
        key = "hot" if rnd.random() < 0.5 else f"k{rnd.randint(0, 9)}"
        t = None if rnd.random() < 0.01 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 86_400 * 60))
        data.append((key, t, i))
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id long")
    for desc in (False, True):
        order = F.col("t").desc_nulls_last() if desc else F.col("t").asc_nulls_last()
        mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=100, descending=desc)
        plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(order)).cast("int"))
        assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n"), desc


def test_tied_copies_in_hot_key_match_row_number(spark):
    burst = dt.datetime(2024, 1, 15, 12, 0)
    data = [("hot", burst, i) for i in range(900)]  # 900 identical copies
    data += [("hot", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), 10_000 + i) for i in range(400)]
    data += [("hot", None, 20_000 + i) for i in range(150)] + [("cold", burst, 30_000), ("cold", None, 30_001)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id long").repartition(7)
    for desc in (False, True):
        order = F.col("t").desc_nulls_last() if desc else F.col("t").asc_nulls_last()
        # threshold 100: the burst (900 ties) and the NULL group (150) are split into runs
        mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=100, descending=desc)
        plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(order)).cast("int"))
        assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n"), desc


def range_sizes(spark):
    """Largest number of rows that one range of the last split numbering held."""
    from accrualkit.session import checkpoint_dir

    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark) + "/results")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(root)
    for f in sorted(files, key=lambda f: -f.getModificationTime()):
        df = spark.read.parquet(f.getPath().toString())
        if "_occ_range" in df.columns:
            return sorted(r["count"] for r in df.groupBy("_occ_range").count().collect())
    raise AssertionError("no numbering was split")


def test_a_burst_is_cut_by_rows_not_by_time(spark):
    rnd = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    # nine tenths of the key's rows lie in a thousandth of its span, a third on one instant
    data = [("hot", start + dt.timedelta(seconds=rnd.randint(0, 80_000)), i) for i in range(4000)]
    data += [("hot", start + dt.timedelta(seconds=100), i) for i in range(4000)]
    data += [("hot", start + dt.timedelta(seconds=rnd.randint(0, 80_000_000)), i) for i in range(800)]
    df = spark.createDataFrame(data, "k string, t timestamp_ntz, id long").repartition(5)
    mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=500)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t")))
    assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n")
    sizes = range_sizes(spark)
    assert len(sizes) >= 10 and sizes[-1] <= 2.5 * 500


def test_a_hot_day_of_a_date_column_is_split(spark):
    data = [("a" if i % 3 else "b", dt.date(2024, 1, 1 + (i % 20 == 0) * (i % 28)), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, t date, id long")
    mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=200, descending=True)
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.col("t").desc())))
    assert rows(mine, "k", "t", "n") == rows(plain, "k", "t", "n")
    assert range_sizes(spark)[-1] <= 2.5 * 200


def test_a_low_threshold_on_many_rows_does_not_make_a_task_for_every_few_rows(spark):
    # a null time in 50 and ten rows on each instant; 20,000 rows of three keys (one null) and a cold key
    data = [([None, "a", "b"][i % 3], None if i % 50 == 0 else ts(1) + dt.timedelta(seconds=i * 7919 % 2000)) for i in range(20_000)]
    df = spark.createDataFrame([*data, ("cold", ts(2)), ("cold", ts(1))], "k string, t timestamp_ntz").repartition(5)
    for desc in (False, True):
        order = F.col("t").desc_nulls_last() if desc else F.col("t").asc_nulls_last()
        want = rows(df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(order))), "k", "t", "n")
        # 1,000 ranges of 20 rows before
        mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=20, descending=desc)
        assert rows(mine, "k", "t", "n") == want, desc
        sizes = range_sizes(spark)
        assert len(sizes) <= 64 and sizes[-1] <= 2.5 * 20_000 / 64
        # more ranges where these would hold too many rows
        finer = occurrence_number(df, ["k"], "t", "n", min_hot_rows=20, descending=desc, range_rows=100)
        assert rows(finer, "k", "t", "n") == want, desc
        sizes = range_sizes(spark)
        assert 150 <= len(sizes) <= 200 and sizes[-1] <= 2.5 * 100


def test_ranges_grow_with_the_rows_that_they_may_hold():
    from accrualkit.operators.ordinal import FEW_RANGES, RANGE_ROWS, hot_key_threshold, range_count

    assert range_count(0, 300) == 1 and range_count(1_000, 300) == 4
    # the events of 0.1, 1 and 6 GB, cut at 300 rows: 1,200 to 100,000 ranges before
    assert [range_count(n, hot_key_threshold(n, 300)) for n in (600_000, 6_000_000, 36_000_000)] == [FEW_RANGES, FEW_RANGES, 360]
    for n in (10**5, 10**7, 10**9, 10**12):
        threshold = hot_key_threshold(n)
        # with the usual threshold, ranges of that many rows as ever
        assert range_count(n, threshold) == -(-n // threshold)
        assert range_count(n, 300) * max(RANGE_ROWS, 300) >= n


def test_numbers_are_bigint_and_null_keys_are_a_group(spark):
    df = spark.createDataFrame([(None, ts(1)), (None, ts(2)), ("a", ts(1))] * 20, "k string, t timestamp_ntz")
    for hot in (5, 1000):
        mine = occurrence_number(df, ["k"], "t", "n", min_hot_rows=hot)
        assert dict(mine.dtypes)["n"] == "bigint"
        assert sorted(r.n for r in mine.filter("k is null").collect()) == list(range(1, 41))


def test_history_of_chosen_databases_is_the_chosen_part_of_the_history(spark):
    rnd = random.Random(8)
    kinds = ["Added", "Updated", "Deleted", "Viewed"]
    data = [(16, rnd.choice("xyz"), rnd.choice(["1", "2", "3", "n/a"]), rnd.choice(kinds), ts(rnd.randint(1, 9))) for _ in range(400)]
    log = setting_df(spark, data)
    chosen = spark.createDataFrame([(1,), (3,), (9,)], "sync_db_id long")
    for history in (mapping_history_flat, mapping_history_collapsed):
        assert rows(history(log, sync_dbs=chosen)) == rows(history(log).filter("sync_db_id in (1, 3)"))
