from accrualkit import cli


def test_cli_writes_report(spark, tmp_path):
    out = str(tmp_path / "nextech")
    rc = cli.main(
        ["--testdata", "/root/testdata/sf0.001", "--out", out, "--format", "csv",
         "active-locations", "--month", "2024-03-01", "--pms-id", "10", "--activity", "month"]
    )
    assert rc == 0
    back = spark.read.option("header", "true").csv(out)
    assert back.count() == 3
    assert "num_of_providers" in back.columns


def test_cli_parses_every_report():
    p = cli.parser()
    for argv in (
        ["api-practices", "--apps", "Athena", "AthenaAPI"],
        ["synced-addresses", "--from", "2023-12-01", "--to", "2023-12-31"],
        ["provider-roster", "--with-npi", "--bookable-flag", "is_bookable"],
        ["parent-entities"],
        ["bookings", "--start", "2024-01-01", "--end", "2024-01-31"],
        ["no-availability", "--since", "2023-12-01"],
    ):
        assert p.parse_args(argv).report == argv[0]
    assert set(cli.REPORTS) == {"api-practices", "active-locations", "synced-addresses", "provider-roster",
                                "parent-entities", "bookings", "no-availability"}
