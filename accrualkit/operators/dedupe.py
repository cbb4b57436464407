"""Top-1 per group (latest row per key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top1_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    tie_break: Sequence[str] | None = None,
    rank_col: str | None = None,
) -> DataFrame:
    """Keep the first row per ``keys`` ordered by ``order_desc`` descending.

    Ties on ``order_desc`` are broken by ``tie_break`` (default: all other
    columns), descending, NULLs last — a total order, so the result is
    deterministic where the reports' own ranking was not.

    ``row_number() = 1`` is planned by Catalyst as a *WindowGroupLimit*: a
    partial top-1 runs on each map partition before the shuffle, so a key
    holding a third of the rows ships at most one row per map task.
    If ``rank_col`` is given the (always 1) row number is kept under that name.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in order_desc]
    order = [F.col(c).desc_nulls_last() for c in list(order_desc) + list(tie_break)]
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
    if rank_col:
        return out.withColumnRenamed("_rn", rank_col)
    return out.drop("_rn")
