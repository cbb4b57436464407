"""Hot-key experiment for the skew-safe operators.

    python -m tools.skew_experiment [rows]

An operator experiment, not a registered query.  It builds a Spark-generated
table (``spark.range``) in which one key holds a third of all rows. It runs
each skew-safe operator and its plain counterpart, checks that their results
are identical, and reads the largest per-task shuffle input from Spark's
event log, written to a fresh scratch folder.  Prints one JSON object.
"""

from __future__ import annotations

import collections
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, ".")

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from accrualkit.operators.dedupe import top1_per_group  # noqa: E402
from accrualkit.operators.event_log import rows_at_latest  # noqa: E402
from accrualkit.operators.joins import fanout_left_join, not_superseded  # noqa: E402
from accrualkit.operators.ordinal import occurrence_number  # noqa: E402
from accrualkit.session import build_session  # noqa: E402


def task_shares(event_dir: str, total: int) -> dict[str, float]:
    """Largest share of ``total`` rows read by one task, per job group."""
    stage_group: dict[int, str] = {}
    worst: dict[str, int] = collections.defaultdict(int)
    for path in glob.glob(os.path.join(event_dir, "**", "*"), recursive=True):
        if os.path.isdir(path) or "appstatus" in path:
            continue
        with open(path) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    group = e.get("Properties", {}).get("spark.jobGroup.id", "")
                    for s in e["Stage Infos"]:
                        stage_group[s["Stage ID"]] = group
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    g = stage_group.get(e["Stage ID"], "")
                    worst[g] = max(worst[g], m.get("Total Records Read", 0))
    return {g: round(v / total, 4) for g, v in worst.items() if g}


def main() -> None:
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 3_000_000
    events = tempfile.mkdtemp(prefix="skew-events-", dir="/tmp")
    spark = build_session(
        "local[8]",
        shuffle_partitions=64,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events,
            "spark.eventLog.compress": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    sc = spark.sparkContext
    hot = F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 50_000)
    df = spark.range(n).select(
        hot.alias("key"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=(F.col("id") * 7919) % (90 * 86400))).alias("ts"),
        (F.col("id") * 31 % 1000).alias("v"),
    )
    same: dict[str, bool] = {}
    seconds: dict[str, float] = {}

    def run(group: str, frame):
        sc.setJobGroup(group, group)
        t0 = time.perf_counter()
        out = sorted(frame.collect())
        seconds[group] = round(time.perf_counter() - t0, 2)
        return out

    # occurrence numbers
    summary = lambda d: d.groupBy("key").agg(F.sum("n").alias("s"), F.max("n").alias("m"), F.count("*").alias("c"))
    plain = run("row_number_plain", summary(df.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("ts")))))
    split = run("occurrence_number", summary(occurrence_number(df, ["key"], "ts", "n")))
    same["occurrence_number"] = plain == split

    # a group of copies: a third of all rows share one key *and* one timestamp
    copies = df.withColumn(
        "ts", F.when(F.col("key") == -1, F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")).otherwise(F.col("ts"))
    )
    plain_c = run("row_number_copies_plain", summary(copies.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("ts")))))
    split_c = run("occurrence_number_copies", summary(occurrence_number(copies, ["key"], "ts", "n")))
    same["occurrence_number_copies"] = plain_c == split_c

    # top-1 per key (map-side WindowGroupLimit)
    top = run("top1_per_group", top1_per_group(df, ["key"], ["ts"], ["v"]).groupBy().agg(F.sum("v"), F.count("*")))
    ref = run("top1_reference", df.groupBy("key").agg(F.max(F.struct("ts", "v")).alias("t")).groupBy().agg(F.sum("t.v"), F.count("*")))
    same["top1_per_group"] = top == ref

    # left join whose right side has the hot key
    left = spark.range(100_000).select((F.col("id") - 1).alias("k"))
    count = lambda d: d.groupBy().agg(F.count("*"), F.sum(F.coalesce("v", F.lit(0))))
    lj = run("left_join_plain", count(left.join(df, left.k == df.key, "left")))
    fj = run("fanout_left_join", count(fanout_left_join(left, df, "k", "key")))
    same["fanout_left_join"] = lj == fj

    # not superseded: the hot key on both sides of the range anti join
    ev = df.select("key", "ts")
    later = df.select("key", F.col("ts").alias("t2")).filter(F.col("v") < 5)
    ns = run("not_superseded", not_superseded(ev, later, ["key"], "ts", "t2").groupBy().count())
    plain_ns = run(
        "anti_join_plain",
        ev.join(later.withColumnRenamed("key", "k2"), (F.col("key") == F.col("k2")) & (F.col("t2") > F.col("ts")), "left_anti")
        .groupBy()
        .count(),
    )
    same["not_superseded"] = ns == plain_ns

    # latest row per key with ties kept (key-18 shaped rows)
    log = df.select(
        F.lit(18).alias("setting_key_id"),
        F.col("key").cast("string").alias("entity_id"),
        F.col("v").cast("string").alias("setting_value"),
        F.lit("Updated").alias("event_type"),
        F.col("ts").alias("event_timestamp_utc"),
    )
    lat = run("rows_at_latest", rows_at_latest(log).groupBy().count())
    w = Window.partitionBy("entity_id")
    plain_lat = run(
        "latest_window_plain",
        log.withColumn("m", F.max("event_timestamp_utc").over(w)).filter(F.col("m") == F.col("event_timestamp_utc")).groupBy().count(),
    )
    same["rows_at_latest"] = lat == plain_lat

    spark.stop()
    print(json.dumps({"rows": n, "hot_key_share": 1 / 3, "identical_results": same,
                      "largest_task_share_of_rows": task_shares(events, n), "seconds": seconds}))


if __name__ == "__main__":
    main()
