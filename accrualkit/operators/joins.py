"""Join-shaped operators: not-superseded, membership marks, union distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def not_superseded(
    events: DataFrame,
    superseders: DataFrame,
    keys: Sequence[str],
    event_ts: str,
    superseder_ts: str,
) -> DataFrame:
    """Events with no superseding row (same keys, later timestamp).

    Equivalent to ``LEFT JOIN s ON keys AND s.ts > e.ts WHERE s.key IS NULL``.
    An event is superseded iff some superseder is later, i.e. iff the
    *latest* superseder is later.  So the superseders are first reduced to
    one row per key (partial aggregation — a hot key costs nothing extra),
    and the anti join with its range residual then compares each event with
    one row instead of every superseder of its key.
    """
    latest = superseders.groupBy(*[F.col(k).alias(f"_sup_{i}") for i, k in enumerate(keys)]).agg(
        F.max(superseder_ts).alias("_sup_latest")
    )
    cond = [events[k] == F.col(f"_sup_{i}") for i, k in enumerate(keys)]
    cond.append(F.col("_sup_latest") > events[event_ts])
    return events.join(latest, reduce(lambda a, b: a & b, cond), "left_anti")


def mark_members(df: DataFrame, members: DataFrame, left_key: str, member_key: str, out: str) -> DataFrame:
    """``out`` = the key of a row that has a member, else NULL.

    An existence join: it asks whether a member exists and never multiplies
    rows, so members need no DISTINCT.
    """
    member = members.select(F.col(member_key).alias("_mark_member"))
    # names of their own: a column that members have too would be taken for theirs
    asked = df.withColumn("_mark_key", F.col(left_key))
    found = member.filter(F.col("_mark_member") == F.col("_mark_key").outer()).exists()
    return asked.select(*df.columns, F.when(found, F.col("_mark_key")).alias(out))


def fanout_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """LEFT JOIN for a right side that may pile many rows onto one key.

    Adaptive execution can split a skewed key of either side of an *inner*
    join, but never the non-preserved side of a LEFT join (a split task
    could not tell whether a left row matched elsewhere).  So the join is
    written as

        matched   = left ⋈ right                       (inner: hot key split by AQE)
        unmatched = left ▷ DISTINCT right keys        (anti: one row per key)

    and the two are unioned, with NULLs for the right columns of unmatched
    rows — exactly the rows of ``left LEFT JOIN right``.  ``left`` is read
    twice, so pass a materialised or cheap left side.
    """
    matched = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("_fanout_key")).distinct()
    unmatched = left.join(keys, left[left_key] == keys["_fanout_key"], "left_anti")
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields]
    return matched.unionByName(unmatched.select("*", *pad))


def union_distinct(*frames: DataFrame) -> DataFrame:
    """SQL ``UNION``: union by column name, then remove duplicates."""
    return reduce(lambda a, b: a.unionByName(b), frames).distinct()
