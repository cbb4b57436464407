from accrualkit.params import PmsSelector
from accrualkit.plans import monthly
from accrualkit.plans import reports as R
from accrualkit.sources.catalog import SourceCatalog
from helpers import rows

SF = "/root/testdata/sf0.01"
MONTH = "2024-03-01"


def test_month_end_shared_runs_equal_individual_reports(spark):
    cat = SourceCatalog.from_testdata(spark, SF)
    runs = monthly.month_end_runs(cat, MONTH)
    assert rows(runs["api_practices_athena"]()) == rows(R.report_api_practices(cat, ("Athena", "AthenaAPI")))
    assert rows(runs["active_locations_nextech"]()) == rows(
        R.report_active_locations(cat, MONTH, PmsSelector.by_id(10), "month")
    )
    assert rows(runs["active_locations_eaglesoft"]()) == rows(
        R.report_active_locations(cat, MONTH, PmsSelector.by_id(11, 12), "day")
    )
    assert rows(runs["provider_roster_npi"]()) == rows(R.report_provider_roster(cat, "is_bookable", with_npi=True))
    assert len(runs) == 13


def test_run_month_end_writes_reports(spark, tmp_path):
    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "m")
    written = monthly.run_month_end(cat, MONTH, out, only=["active_locations_nextech", "parent_entities"])
    assert set(written) == {"active_locations_nextech", "parent_entities"}
    assert spark.read.parquet(written["active_locations_nextech"]).count() == 3
