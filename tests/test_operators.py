"""Temporal predicates, top-1, not-superseded, labels, flags."""

import datetime as dt
import random

from pyspark.sql import functions as F

from accrualkit.functions.casts import as_boolean
from accrualkit.functions.dates import at_midnight
from accrualkit.functions.labels import resolve_pms, sync_type_label
from accrualkit.operators.dedupe import top1_per_group
from accrualkit.operators.joins import fanout_left_join, mark_members, not_superseded, union_distinct
from accrualkit.operators.temporal import currently_active, valid_at
from accrualkit.params import ReportMonth, add_months
from accrualkit.sources.catalog import SourceCatalog, normalise_flags
from helpers import lit_ts, rows, ts


def test_valid_at_is_strict_on_both_bounds(spark):
    b = ts(10)
    df = spark.createDataFrame(
        [(1, ts(1), None), (2, ts(1), ts(10)), (3, ts(1), ts(11)), (4, ts(10), None), (5, None, None)],
        "id int, s timestamp_ntz, e timestamp_ntz",
    )
    got = [r.id for r in df.filter(valid_at("s", "e", lit_ts(b))).orderBy("id").collect()]
    assert got == [1, 3]


def test_currently_active(spark):
    df = spark.createDataFrame(
        [(1, ts(1), None), (2, None, None), (3, ts(1), ts(2))], "id int, s timestamp_ntz, e timestamp_ntz"
    )
    assert [r.id for r in df.filter(currently_active("s", "e")).collect()] == [1]


def test_between_upper_bound_is_midnight(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 31, 0, 0)), (2, dt.datetime(2024, 1, 31, 0, 1)), (3, dt.datetime(2024, 1, 1))],
        "id int, t timestamp_ntz",
    )
    cond = F.col("t").between(at_midnight("2024-01-01"), at_midnight("2024-01-31"))
    assert sorted(r.id for r in df.filter(cond).collect()) == [1, 3]


def test_top1_per_group_breaks_ties_deterministically(spark):
    df = spark.createDataFrame(
        [("p", 5, "a"), ("p", 5, "c"), ("p", 4, "z"), ("q", None, "x"), ("q", None, "y")],
        "k string, d int, v string",
    )
    got = rows(top1_per_group(df, ["k"], ["d"]), "k", "d", "v")
    assert got == [("p", 5, "c"), ("q", None, "y")]


def test_top1_keeps_rank_column(spark):
    df = spark.createDataFrame([("p", 1), ("p", 2)], "k string, d int")
    assert rows(top1_per_group(df, ["k"], ["d"], rank_col="rownum")) == [("p", 2, 1)]


def test_not_superseded_matches_left_join_is_null(spark):
    rnd = random.Random(3)
    ev = [(rnd.choice("abc"), rnd.choice("xy"), ts(rnd.randint(1, 20)) if rnd.random() > 0.1 else None) for _ in range(300)]
    sup = [(rnd.choice("abc"), rnd.choice("xy"), ts(rnd.randint(1, 20)) if rnd.random() > 0.1 else None) for _ in range(200)]
    e = spark.createDataFrame(ev, "a string, s string, created timestamp_ntz")
    s = spark.createDataFrame(sup, "a string, s string, deleted timestamp_ntz")
    mine = not_superseded(e, s, ["a", "s"], "created", "deleted")
    s2 = s.select(F.col("a").alias("a2"), F.col("s").alias("s2"), "deleted")
    naive = (
        e.join(s2, (e.a == s2.a2) & (e.s == s2.s2) & (s2.deleted > e.created), "left")
        .filter(F.col("a2").isNull())
        .select("a", "s", "created")
    )
    assert rows(mine) == rows(naive)


def test_not_superseded_is_a_left_anti_join(spark):
    e = spark.createDataFrame([("a", ts(1))], "k string, t timestamp_ntz")
    s = spark.createDataFrame([("a", ts(2))], "k string, t timestamp_ntz")
    assert "LeftAnti" in __import__("helpers").plan_text(not_superseded(e, s, ["k"], "t", "t"))


def test_mark_members_does_not_multiply_rows(spark):
    df = spark.createDataFrame([("L1",), ("L2",)], "loc string")
    members = spark.createDataFrame([("L1",), ("L1",), ("L3",)], "loc string")
    got = rows(mark_members(df, members, "loc", "loc", "m"), "loc", "m")
    assert got == [("L1", "L1"), ("L2", None)]


def test_union_distinct(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "p int, l string")
    b = spark.createDataFrame([(1, "x"), (2, "y")], "p int, l string")
    assert rows(union_distinct(a, b)) == [(1, "x"), (2, "y")]


def test_sync_type_label_and_null(spark):
    df = spark.createDataFrame(
        [("Read/Write",), ("Read/Write/Track",), ("Read Only",), ("Manual",), (None,), ("other",)], "t string"
    )
    got = [r.l for r in df.select(sync_type_label(F.col("t")).alias("l")).collect()]
    assert got == ["Two Way", "Two Way", "One Way", "Manual", "Manual", "Manual"]


def test_resolve_pms_is_not_coalesce(spark):
    df = spark.createDataFrame(
        [(None, None, None, "listed"), (1, None, None, "listed"), (None, "Manual", "pmsX", "listed")],
        "sid long, st string, synced string, listed string",
    )
    got = [
        r.p
        for r in df.select(
            resolve_pms(F.col("sid"), F.col("st"), F.col("synced"), F.col("listed")).alias("p")
        ).collect()
    ]
    # a sync id without a synced PMS reports NULL, not the listed PMS
    assert got == ["listed", None, "pmsX"]


def test_text_flags_normalised_at_load(spark):
    df = spark.createDataFrame(
        [("P1", "TRUE"), ("P2", "True"), ("P3", "false"), ("P4", None), ("P5", "junk")], "provider_id string, is_test string"
    )
    out = normalise_flags("provider", df)
    assert dict(out.dtypes)["is_test"] == "boolean"
    assert [r.is_test for r in out.orderBy("provider_id").collect()] == [True, True, False, None, None]
    assert as_boolean(F.col("x"), df.schema["provider_id"].dataType) is not None


def test_catalog_resolves_qualified_and_quoted_names(spark):
    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    a = cat.table("provider.provider")
    b = cat.table('"WAREHOUSE"."PROVIDER"."PROVIDER"')
    c = cat.table("provider")
    assert a is b is c


def test_catalog_from_tables_reads_paths_and_normalises(spark, tmp_path):
    path = str(tmp_path / "pv")
    spark.createDataFrame([("P1", "FALSE")], "provider_id string, is_test string").write.parquet(path)
    cat = SourceCatalog.from_tables(spark, {"provider": path})
    assert cat("provider").collect()[0].is_test is False


def test_month_parameters():
    m = ReportMonth.of("2024-02-01")
    assert (m.next_start, m.last_day, m.days) == (dt.date(2024, 3, 1), dt.date(2024, 2, 29), 29)
    assert add_months(dt.date(2024, 1, 31), 1) == dt.date(2024, 2, 29)


def test_fanout_left_join_equals_left_join(spark):
    rnd = random.Random(11)
    left = spark.createDataFrame([(i, rnd.choice([1, 2, 3, None])) for i in range(50)], "id int, k int")
    right = spark.createDataFrame(
        [(rnd.choice([1, 1, 1, 2, 4, None]), f"r{j}") for j in range(80)], "rk int, payload string"
    )
    mine = fanout_left_join(left, right, "k", "rk")
    plain = left.join(right, left.k == right.rk, "left")
    assert rows(mine, "id", "k", "rk", "payload") == rows(plain, "id", "k", "rk", "payload")
