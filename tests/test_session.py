"""Checkpoint location and materialisation helpers."""

from accrualkit.plans.materialize import reuse, temp_table
from accrualkit.session import application_id, checkpoint_dir


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    got = checkpoint_dir(spark)
    assert got
    if configured:
        assert got == configured
    assert spark.sparkContext.getCheckpointDir()


def test_reuse_cuts_lineage(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k").groupBy("k").count()
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = reuse(df)
    plan = out.select("count")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet [count" in plan and "Range" not in plan
    assert sorted(r["count"] for r in out.collect()) == sorted(r["count"] for r in df.collect())
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == before


def test_temp_table_is_queryable_by_name(spark):
    temp_table(spark.range(5).toDF("x"), "accrualkit_tmp_probe")
    assert spark.sql("select sum(x) as s from accrualkit_tmp_probe").first().s == 10


def test_application_id(spark):
    assert application_id(spark)


def test_relation_names_resolve_by_their_full_name(spark):
    import pytest

    from accrualkit.sources.catalog import SourceCatalog

    cat = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    n = cat("location").count()
    for name in ("location", "provider.location", "WAREHOUSE.PROVIDER.LOCATION", '"WH"."PROVIDER"."LOCATION"', "`provider`.`location`"):
        assert cat.table(name).count() == n
        assert spark.table(cat.view(name)).count() == n
    for name in ("billing.location", "wh.billing.location", "a.b.provider.location", "locations", ""):
        with pytest.raises(KeyError):
            cat.table(name)


def test_exclusions_of_numeric_providers_and_empty_strings(spark):
    from accrualkit.plans import reports as RP
    from accrualkit.sources.catalog import SourceCatalog

    base = SourceCatalog.from_testdata(spark, "/root/testdata/sf0.001")
    names = ("provider_location_availability_summary_day", "location", "provider", "provider_location_sync_summary_day_vw")
    frames = {}
    for name in names:
        df = base(name)
        if "provider_id" in df.columns:
            df = df.withColumn("provider_id", df["provider_id"].substr(2, 20).cast("bigint"))
        frames[name] = df
    cat = SourceCatalog.from_frames(spark, frames)
    every = RP.report_no_availability(cat, "2023-12-01")
    assert dict(every.dtypes)["provider_id"] == "bigint"
    ids = [r["provider_id"] for r in every.select("provider_id").distinct().collect()]
    assert RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=("", None)).count() == every.count()
    left = RP.report_no_availability(cat, "2023-12-01", excluded_provider_ids=(ids[0], "")).select("provider_id").distinct()
    assert sorted(r["provider_id"] for r in left.collect()) == sorted(ids[1:])
