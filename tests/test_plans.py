"""Plan-shape assertions: no Python in the plans, top-1 and anti joins as
intended, filters and projections pushed into the Parquet scans."""

import pytest

from accrualkit.plans.registry import all_queries
from accrualkit.sources.catalog import SourceCatalog
from helpers import plan_text

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_text(fn(spark, SF)) for name, fn in all_queries().items()}


def test_no_python_udfs_anywhere(plans):
    offenders = [n for n, p in plans.items() if any(node in p for node in PYTHON_NODES)]
    assert offenders == []


def test_top1_limits_before_the_shuffle(plans):
    # a partial WindowGroupLimit below the Exchange keeps one row per key
    # per map task, so a hot key never ships all its rows to one reducer
    for name in ("top1_per_group", "qualify_alias", "qualify_and_predicate"):
        tree = [ln for ln in plans[name].split("\n\n")[0].splitlines() if "+-" in ln]
        exchange = next(i for i, ln in enumerate(tree) if "Exchange" in ln)
        assert any("WindowGroupLimit" in ln for ln in tree[exchange + 1 :]), name


def test_superseded_mappings_use_left_anti(plans):
    assert "LeftAnti" in plans["live_aggregate_mappings"]
    assert "LeftAnti" in plans["join_left_anti_range"]


def test_left_join_with_null_rejecting_filter_is_inner(plans):
    p = plans["filter_null_rejecting_after_outer"]
    assert "LeftOuter" not in p


def test_filters_pushed_to_parquet(spark):
    orders = SourceCatalog.from_testdata(spark, SF).base.orders
    p = plan_text(orders.filter(orders.o_orderstatus == "O").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,O)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in p


def test_reports_prune_unused_columns(plans):
    # the location table has 13 columns; R2 needs 10 of them and R6 only 2,
    # so the unused ones must never reach a scan's read schema
    checked = 0
    for name, unused in (
        ("report_active_locations_nextech", ("address2", "address3", "software")),
        ("report_bookings_np", ("address1", "city", "fax", "zip_code")),
    ):
        for line in plans[name].splitlines():
            if line.strip().startswith("ReadSchema") and "monolith_provider_location_id" in line or (
                line.strip().startswith("ReadSchema") and "software" in line and "location_id" in line
            ):
                checked += 1
                assert not any(f"{c}:" in line for c in unused), (name, line)
    assert checked >= 2


def test_snapshot_period_filters_reach_the_scan(plans):
    # the one-month / one-day snapshot picks are pushed into the Parquet
    # scans, which is what lets a date-partitioned table skip partitions
    p = plans["report_active_locations_nextech"]
    assert "EqualTo(snapshot_month_eastern,2024-04-01)" in p
    assert "EqualTo(snapshot_month_eastern,2024-03-01)" in p
    assert "EqualTo(snapshot_date_eastern,2024-03-01)" in plans["report_active_locations_denticon"]


def shuffles(tree: str) -> int:
    return sum("Exchange" in line and "Broadcast" not in line for line in tree.splitlines())


def test_the_log_is_shuffled_once_for_numbering_pairing_and_collapse(spark):
    from accrualkit.operators.event_log import mapping_history_collapsed, mapping_history_flat

    setting = SourceCatalog.from_testdata(spark, SF)("setting")
    for history in (mapping_history_flat, mapping_history_collapsed):
        tree = plan_text(history(setting)).split("\n\n")[0]
        assert tree.count("Window (") == 1
        assert "BroadcastExchange" not in tree and "BroadcastHashJoin" not in tree
        assert shuffles(tree) == 1


@pytest.mark.parametrize("report", ["report_api_practices_athena", "report_active_locations_nextech"])
def test_databases_are_chosen_before_the_log_is_numbered(spark, report, monkeypatch):
    from accrualkit.operators import event_log

    seen = []

    def spy(events, *args, **kwargs):
        seen.append(plan_text(events).split("\n\n")[0])
        return numbered(events, *args, **kwargs)

    numbered = event_log.occurrence_number
    monkeypatch.setattr(event_log, "occurrence_number", spy)
    all_queries()[report](spark, SF)
    assert len(seen) == 1 and "LeftSemi" in seen[0] and "Window" not in seen[0]
