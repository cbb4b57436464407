"""Run a report from the command line.

    python -m accrualkit.cli active-locations --month 2024-03-01 --pms-id 10 --activity month \\
        --testdata /root/testdata/sf0.01 --out /shared/reports/nextech-2024-03 --format csv

Inputs come from the warehouse tables by their logical names (default),
from a JSON file mapping logical names to tables or paths (``--tables``),
or from the test-data stand-ins (``--testdata DIR``).  The result is
written in parallel as a CSV (with header) or Parquet directory; ``--show N``
also prints the first N rows.
"""

from __future__ import annotations

import argparse
import json

from accrualkit.params import DateWindow, PmsSelector
from accrualkit.plans import monthly
from accrualkit.plans.materialize import run_scope
from accrualkit.plans import reports as R
from accrualkit.session import build_session
from accrualkit.sources.catalog import SourceCatalog


def _pms(args) -> PmsSelector:
    if args.pms_id:
        return PmsSelector.by_id(*args.pms_id)
    return PmsSelector.by_name(*args.pms_name)


REPORTS = {
    "api-practices": lambda cat, a: R.report_api_practices(cat, a.apps),
    "active-locations": lambda cat, a: R.report_active_locations(cat, a.month, _pms(a), a.activity),
    "synced-addresses": lambda cat, a: R.report_synced_addresses(cat, DateWindow.of(a.date_from, a.date_to), a.pms),
    "provider-roster": lambda cat, a: R.report_provider_roster(cat, a.bookable_flag, a.with_npi),
    "parent-entities": lambda cat, a: R.report_parent_entities(cat, a.apps),
    "bookings": lambda cat, a: R.report_bookings(cat, a.start, a.end, a.pattern),
    "no-availability": lambda cat, a: R.report_no_availability(cat, a.since, a.pattern, a.exclude),
}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="accrualkit", description=__doc__.split("\n\n")[0])
    src = p.add_mutually_exclusive_group()
    src.add_argument("--tables", help="JSON file: logical name -> table name or path")
    src.add_argument("--testdata", help="directory of the generated test tables")
    p.add_argument("--master", help="Spark master (default: from spark-submit)")
    p.add_argument("--out", help="output directory")
    p.add_argument("--format", choices=("csv", "parquet"), default="parquet")
    p.add_argument("--show", type=int, default=0, help="print the first N rows")
    sub = p.add_subparsers(dest="report", required=True)

    s = sub.add_parser("api-practices")
    s.add_argument("--apps", nargs="+", required=True)
    s = sub.add_parser("active-locations")
    s.add_argument("--month", required=True)
    g = s.add_mutually_exclusive_group(required=True)
    g.add_argument("--pms-name", nargs="+")
    g.add_argument("--pms-id", nargs="+", type=int)
    s.add_argument("--activity", choices=("day", "month"), default="day")
    s = sub.add_parser("synced-addresses")
    s.add_argument("--from", dest="date_from", required=True)
    s.add_argument("--to", dest="date_to", required=True)
    s.add_argument("--pms", nargs="+", default=list(R.DENTRIX_PMS))
    s = sub.add_parser("provider-roster")
    s.add_argument("--bookable-flag", default="is_bookable_legacy", choices=("is_bookable_legacy", "is_bookable"))
    s.add_argument("--with-npi", action="store_true")
    s = sub.add_parser("parent-entities")
    s.add_argument("--apps", nargs="+", default=list(R.CERNER_APPLICATIONS))
    s = sub.add_parser("bookings")
    s.add_argument("--start", required=True)
    s.add_argument("--end", required=True)
    s.add_argument("--pattern", default=R.RAINTREE_PATTERN)
    s = sub.add_parser("no-availability")
    s.add_argument("--since", required=True)
    s.add_argument("--pattern", default=R.RAINTREE_PATTERN)
    s.add_argument("--exclude", nargs="*", default=[""], help="provider ids to leave out")
    s = sub.add_parser("month-end", help="every report of a month; shared event-log work done once")
    s.add_argument("--month", required=True)
    s.add_argument("--only", nargs="*", help="subset of the month-end report names")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = build_session(args.master)
    if args.testdata:
        cat = SourceCatalog.from_testdata(spark, args.testdata)
    else:
        locations = json.load(open(args.tables)) if args.tables else None
        cat = SourceCatalog.from_tables(spark, locations)
    if args.report == "month-end":
        if not args.out:
            raise SystemExit("month-end needs --out")
        for name, path in monthly.run_month_end(cat, args.month, args.out, args.format, args.only).items():
            print(f"{name}\t{path}")
        return 0
    with run_scope(spark):
        df = REPORTS[args.report](cat, args)
        if args.out:
            writer = df.write.mode("overwrite")
            if args.format == "csv":
                writer.option("header", "true").csv(args.out)
            else:
                writer.parquet(args.out)
        if args.show:
            df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
