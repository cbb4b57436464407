"""Report semantics on hand-built inputs."""

import datetime as dt

from accrualkit.params import PmsSelector
from accrualkit.plans import reports as RP
from accrualkit.plans import roster as R
from accrualkit.plans import syncs as S
from accrualkit.functions.dates import at_midnight
from accrualkit.operators.event_log import mapping_history_flat
from accrualkit.sources.catalog import SourceCatalog
from helpers import SETTING_SCHEMA, rows

D = dt.date
T = dt.datetime


def test_latest_opportunity_row_inactive_drops_provider(spark):
    oi = spark.createDataFrame(
        [
            (D(2024, 1, 1), "1", 1, "P1", 100, "spec", True, True, T(2023, 1, 1), None, 1, "Read Only", "l", "s"),
            (D(2024, 1, 2), "1", 1, "P1", 100, "spec", False, True, T(2023, 1, 1), None, 1, "Read Only", "l", "s"),
            (D(2024, 1, 1), "1", 1, "P2", 200, "spec", True, True, T(2023, 1, 1), None, 2, "Read/Write", "l", "s"),
        ],
        "snapshot_date_est date, practice_id string, monolith_practice_id long, provider_id string,"
        " monolith_professional_id long, main_specialty string, is_active boolean, is_currently_synced boolean,"
        " latest_activation_start_timestamp_utc timestamp_ntz, latest_activation_end_timestamp_utc timestamp_ntz,"
        " sync_id long, sync_type string, practice_management_system_listed_on_dsp string,"
        " synced_practice_management_system string",
    )
    cat = SourceCatalog.from_frames(spark, {"opportunity_index": oi})
    assert rows(R.latest_active_opportunity_row(cat), "provider_id") == [("P2",)]


def test_no_availability_exclusions(spark):
    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    base = RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=())
    same = RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=("",))
    assert RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=None).count() == base.count()
    ids = [r.provider_id for r in base.select("provider_id").distinct().limit(2).collect()]
    fewer = RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=tuple(ids))
    assert base.count() == same.count() > 0
    assert fewer.filter(fewer.provider_id.isin(*ids)).count() == 0
    assert fewer.count() < base.count()


def test_sync_deleted_exactly_at_boundary_is_not_active(spark):
    setting = spark.createDataFrame(
        [
            (16, "1", "7", "Added", T(2024, 3, 5)),
            (16, "1", "7", "Deleted", T(2024, 4, 1)),
            (16, "2", "7", "Added", T(2024, 3, 5)),
            (16, "2", "7", "Deleted", T(2024, 4, 1, 0, 0, 1)),
            (18, "7", "10", "Added", T(2024, 1, 1)),
        ],
        SETTING_SCHEMA,
    )
    pms = spark.createDataFrame([(10, "Nextech")], "pms_id int, pms_application string")
    location = spark.createDataFrame(
        [("L1", "1", "100"), ("L2", "2", "100")], "location_id string, monolith_provider_location_id string, practice_id string"
    )
    practice = spark.createDataFrame([("100", 100)], "practice_id string, monolith_provider_id long")
    cat = SourceCatalog.from_frames(
        spark, {"setting": setting, "practice_management_software": pms, "location": location, "practice": practice}
    )
    syncs = S.active_syncs_as_of(cat, mapping_history_flat(setting), PmsSelector.by_id(10), at_midnight("2024-04-01"))
    assert rows(syncs, "cloud_location_id") == [("L2",)]


def test_reports_return_rows_on_smallest_data(spark):
    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    assert RP.report_active_locations(cat, "2024-03-01", PmsSelector.by_id(10), "month").count() > 0
    assert RP.report_synced_addresses(cat, RP.DateWindow.of("2023-12-01", "2023-12-31")).count() > 0
    assert RP.report_bookings(cat, "2024-01-01", "2024-01-31").count() > 0


def test_live_aggregate_mappings_superseding_rules(spark):
    almu = spark.createDataFrame(
        [
            # superseded: an update after the create
            ("A1", "L1", "create", T(2024, 1, 1), None),
            ("A1", "L1", "update", None, T(2024, 1, 5)),
            # live: the only update is older than the create
            ("A2", "L2", "create", T(2024, 1, 10), None),
            ("A2", "L2", "PROD_manual_backfill_20201119_update", None, T(2024, 1, 5)),
            # live: back-fill create, no update
            ("A3", "L3", "PROD_manual_backfill_20201119_create", T(2024, 1, 1), None),
            # source location not actively synced
            ("A4", "L9", "create", T(2024, 1, 1), None),
            # superseded by a back-fill update
            ("A5", "L5", "create", T(2024, 1, 1), None),
            ("A5", "L5", "PROD_manual_backfill_20201119_update", None, T(2024, 2, 1)),
        ],
        "aggregate_location_id string, source_location_id string, event_update_type string,"
        " created_timestamp_utc timestamp_ntz, deleted_timestamp_utc timestamp_ntz",
    )
    syncs = spark.createDataFrame([("L1",), ("L2",), ("L3",), ("L5",)], "cloud_location_id string")
    cat = SourceCatalog.from_frames(spark, {"aggregate_location_mapping_update": almu})
    got = rows(S.live_aggregate_mappings(cat, syncs), "aggregate_location_id")
    assert got == [("A2",), ("A3",)]


def test_api_practices_desync_date(spark):
    setting = spark.createDataFrame(
        [
            (18, "7", "14", "Added", T(2024, 1, 1)),
            (16, "1", "7", "Added", T(2024, 1, 2)),
            (16, "1", "7", "Deleted", T(2024, 1, 20)),
            (16, "2", "7", "Added", T(2024, 1, 3)),
            (16, "2", "7", "Deleted", T(2024, 1, 25)),
            (16, "3", "7", "Added", T(2024, 1, 4)),
        ],
        SETTING_SCHEMA,
    )
    frames = {
        "setting": setting,
        "practice_management_software": spark.createDataFrame([(14, "AllScriptsAPI")], "pms_id int, pms_application string"),
        "location": spark.createDataFrame(
            [("L1", "1", "P"), ("L2", "2", "P"), ("L3", "3", "Q")],
            "location_id string, monolith_provider_location_id string, practice_id string",
        ),
        "practice": spark.createDataFrame(
            [("P", 1, "Practice P", False), ("Q", 2, "Practice Q", False)],
            "practice_id string, monolith_provider_id long, name string, is_test boolean",
        ),
        "provider": spark.createDataFrame(
            [("V1", "P", T(2023, 1, 1), None), ("V2", "P", T(2023, 1, 1), T(2023, 6, 1))],
            "provider_id string, practice_id string, latest_activation_start_timestamp_utc timestamp_ntz,"
            " latest_activation_end_timestamp_utc timestamp_ntz",
        ),
    }
    out = RP.report_api_practices(SourceCatalog.from_frames(spark, frames), ["AllScriptsAPI"])
    got = {r.practice_id: r for r in out.collect()}
    # P: both locations deleted -> desync at the last delete; one active provider
    assert got["P"].num_locations_still_synced == 0
    assert got["P"].desync_date == T(2024, 1, 25)
    assert got["P"].num_active_providers == 1
    assert got["P"].initial_synced_date == T(2024, 1, 2)
    # Q: still synced -> no desync date; no providers -> 0
    assert got["Q"].num_locations_still_synced == 1
    assert got["Q"].desync_date is None
    assert got["Q"].num_active_providers == 0
