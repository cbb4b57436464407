"""Occurrence numbers (ROW_NUMBER per key, ordered in time) without hot keys.

The mapping history pairs the n-th create with the n-th delete of a
(sync DB, location) key, so every event needs its ordinal within its key.
A plain ``row_number() over (partition by key order by ts)`` sends a whole
key to one task; if one key holds a third of the log, one task sorts a
third of the log.

A key is *hot* above ``threshold = max(min_hot_rows, total_rows /
max_hot_keys)`` rows, so about ``max_hot_keys`` keys are hot at most, and the
list of them has a proven size bound.  It comes from a mergeable summary of
frequent keys (Spark's ``approx_top_k`` sketch, of the Misra-Gries family) over
a 64-bit hash of the key: every task summarises its rows in a table of bounded
size, and only these tables are shuffled and merged.  A summary that tracks m
keys of n rows is off by 3.5 n / m at most and lists every key of more than
7 n / m rows; m is seven times ``max_hot_keys``, so no key above the threshold
is missed.  (A key that is not hot may be listed too, as may one that shares a
hash with a hot one; that costs nothing but the cut below.)

* No key is hot: one plain window over the keys, the only shuffle of the rows.
* Otherwise the log is read once more and written to the shared folder, hot
  and cold rows apart.  Cold keys are numbered by the plain window.  The rows
  of hot keys are range-partitioned by (key, time, position), with splitters
  that Spark samples from the rows themselves, so ranges hold about as many
  rows each however the rows are spread in time: a burst is cut as finely as
  it is dense, and rows on one instant are cut by their position in the
  written copy.  Each range is sorted and written with its rows' places in it.
  A row's number is its place, counted from the first row that the range has
  of the key, plus the rows that earlier ranges have of the key (one row per
  range and hot key).

A range holds about ``threshold`` rows, but as each is a task and a file, no
more than ``FEW_RANGES`` are cut unless they would hold over ``range_rows``
rows each: a low ``min_hot_rows`` on a large log would else make a task for
every few hundred rows.

Rows tied on the order column are interchangeable in a ROW_NUMBER: tied rows
carry identical (key, time) values, so which of them gets which number never
changes a report.  NULL keys form their own group, as in ``PARTITION BY``;
NULL times sort last in either direction.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.plans.materialize import reuse, write_result

MIN_HOT_ROWS = 100_000
MAX_HOT_KEYS = 100_000
#: Keys that the summary tracks for each key that may be hot, and the most that Spark's sketch takes.
TRACKED_PER_HOT = 7
MOST_TRACKED = 1_000_000
#: Tasks that merge the summaries before the last one does.
MERGERS = 64
#: Rows that a range may hold whatever the threshold is, and the ranges that may hold fewer.
RANGE_ROWS = 100_000
FEW_RANGES = 64


def hot_key_threshold(total_rows: int, min_hot_rows: int = MIN_HOT_ROWS, max_hot_keys: int = MAX_HOT_KEYS) -> int:
    """Row count above which a key is hot; at most ``max_hot_keys`` keys exceed it."""
    return max(min_hot_rows, -(-total_rows // max_hot_keys))


def range_count(hot_rows: int, threshold: int, range_rows: int = RANGE_ROWS) -> int:
    """Ranges for ``hot_rows``: of ``threshold`` rows while they are few, else of ``range_rows`` if that is more."""
    return max(1, min(-(-hot_rows // threshold), max(FEW_RANGES, -(-hot_rows // range_rows))))


def key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def frequent_keys(df: DataFrame, keys: Sequence[str], tracked: int) -> DataFrame:
    """One row: n, the rows of ``df``, and found, the ``key_hash`` and about the rows of frequent keys.

    Counts are never too low; ``found`` has every key of more than 7 n / ``tracked`` rows.
    """
    merger = F.pmod(F.spark_partition_id(), F.lit(MERGERS))
    hashed = df.select(key_hash(keys).alias("_occ_key"), merger.alias("_occ_merger"))
    parts = hashed.groupBy("_occ_merger").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k_accumulate(_occ_key, {tracked})").alias("summary")
    )
    # grouped, as the sketch cannot be merged from nothing: an empty ``df`` gives no row
    whole = parts.groupBy(F.lit(0).alias("_occ_all")).agg(F.sum("n").alias("n"), F.expr("approx_top_k_combine(summary)").alias("summary"))
    return whole.select("n", F.expr(f"approx_top_k_estimate(summary, {tracked})").alias("found"))


def hot_keys(df: DataFrame, keys: Sequence[str], min_hot_rows: int, max_hot_keys: int) -> tuple[list[int], int, int]:
    """(hashes of the hot keys, about how many rows they have, threshold)."""
    tracked = TRACKED_PER_HOT * max_hot_keys
    if tracked > MOST_TRACKED:
        raise ValueError(f"at most {MOST_TRACKED // TRACKED_PER_HOT} hot keys can be told apart")
    threshold = F.greatest(F.lit(min_hot_rows), F.ceil(F.col("n") / max_hot_keys))
    summary = frequent_keys(df, keys, tracked).withColumn("threshold", threshold)
    row = summary.select("threshold", F.filter("found", lambda x: x["count"] > F.col("threshold")).alias("hot")).first()
    if row is None or not row["hot"]:
        return [], 0, int((row and row["threshold"]) or min_hot_rows)
    return [x["item"] for x in row["hot"]], sum(x["count"] for x in row["hot"]), int(row["threshold"])


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_occ_{k}"]) for k in keys])


def occurrence_number(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    out: str = "occurrence",
    min_hot_rows: int = MIN_HOT_ROWS,
    max_hot_keys: int = MAX_HOT_KEYS,
    descending: bool = False,
    co_locate: Sequence[str] | None = None,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Append ``out`` = 1, 2, ... (BIGINT) per ``keys`` in ascending ``order_col``
    (newest first with ``descending=True``; NULLs last either way).

    ``co_locate``: some of ``keys`` by which the rows are partitioned, for a
    caller that goes on by those columns and then needs no further shuffle.

    ``range_rows``: rows that a range of hot rows may hold where the threshold
    is lower and there are many ranges.

    Building the result runs the summary over ``df`` (one read, no shuffle of
    its rows); if a key is hot, also the writes described above.  The result
    itself is lazy.
    """
    order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_last()

    def plain(rows: DataFrame) -> DataFrame:
        placed = rows.repartition(*[F.col(k) for k in co_locate]) if co_locate else rows
        return placed.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)).cast("bigint"))

    hot, hot_rows, threshold = hot_keys(df, keys, min_hot_rows, max_hot_keys)
    if not hot:
        return plain(df)

    # at most about max_hot_keys hashes: broadcast
    listed = F.broadcast(df.sparkSession.createDataFrame([(h, True) for h in hot], "_occ_key long, _occ_hot boolean"))
    flagged = df.withColumn("_occ_key", key_hash(keys)).join(listed, "_occ_key", "left").select(
        *df.columns, F.coalesce("_occ_hot", F.lit(False)).alias("_occ_hot"), F.monotonically_increasing_id().alias("_occ_at")
    )
    copy = write_result(flagged, "numbering", partition_by=["_occ_hot"])
    cold = copy.filter(~F.col("_occ_hot")).select(*df.columns)

    in_order = [*[F.col(k).asc_nulls_last() for k in keys], order, F.col("_occ_at")]
    spread = copy.filter("_occ_hot").repartitionByRange(range_count(hot_rows, threshold, range_rows), *in_order)
    # places are consecutive in a range, so a key's rows in it have consecutive places
    placed = reuse(
        spread.sortWithinPartitions(*in_order).select(
            *df.columns, F.spark_partition_id().alias("_occ_range"), F.monotonically_increasing_id().alias("_occ_place")
        )
    )
    before = Window.partitionBy(*keys).orderBy("_occ_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_occ_range", *keys).agg(F.count(F.lit(1)).alias("_occ_rows"), F.min("_occ_place").alias("_occ_first"))
    # one row per range and key in it: about ranges + hot keys at most
    offsets = F.broadcast(
        sizes.select(
            F.col("_occ_range").alias("_occ_r"), *[F.col(k).alias(f"_occ_{k}") for k in keys], "_occ_first",
            F.coalesce(F.sum("_occ_rows").over(before), F.lit(0)).alias("_occ_offset"),
        )
    )
    place = F.col("_occ_place") - F.col("_occ_first") + 1
    numbered = placed.join(offsets, (placed["_occ_range"] == F.col("_occ_r")) & _same_key(placed, offsets, keys)).select(
        *df.columns, (F.col("_occ_offset") + place).cast("bigint").alias(out)
    )
    return plain(cold).unionByName(numbered)
