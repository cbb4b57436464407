"""Exact distinct counts of integers by bitmap buckets.

``COUNT(DISTINCT)`` of several columns makes Spark write every row once a
column (an ``Expand``) and shuffle each distinct value.  For integers the
values of one bucket (32,768 neighbouring numbers) fit a bitmap of 4 KB
instead: a task sets bits, bitmaps of a bucket are or-ed, and the counts of the
bits add up, since buckets share no value.  A shuffled row is a bucket, not a
value, so dense ids (surrogate keys) cost about a bit a value.  Ids that are
spread over a range thousands of times their number are better left to
``count_distinct``: a bucket costs 4 KB however few of its bits are set.

Null values are not counted, as in SQL; a null key is a group of its own; a
group without values counts 0.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MERGED = {"min": F.min, "max": F.max}


def count_distinct_integers(
    df: DataFrame, keys: Sequence[str], column: str | Column, out: str, extremes: Mapping[str, tuple[str, str]] | None = None
) -> DataFrame:
    """``keys`` and ``out``, the distinct values of the integer ``column``.

    ``extremes`` adds columns in the same pass: name -> (``min`` or ``max``, column).
    """
    extremes = extremes or {}
    value = (F.col(column) if isinstance(column, str) else column).cast("bigint")
    wanted = df.select(*keys, value.alias("_value"), *[F.col(c).alias(f"_own_{name}") for name, (_, c) in extremes.items()])
    buckets = wanted.groupBy(*keys, F.bitmap_bucket_number("_value").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_value")).alias("_bits"),
        *[_MERGED[how](f"_own_{name}").alias(f"_own_{name}") for name, (how, _) in extremes.items()],
    )
    return buckets.groupBy(*keys).agg(
        F.sum(F.bitmap_count("_bits")).alias(out), *[_MERGED[how](f"_own_{name}").alias(name) for name, (how, _) in extremes.items()]
    )


def count_distinct_each(df: DataFrame, keys: Sequence[str], columns: Mapping[str, str]) -> DataFrame:
    """``keys`` and the distinct values of several integer columns (name -> column).

    Each column is read and counted by itself, and the counts (one row a
    group) are joined.
    """
    counts = [count_distinct_integers(df, keys, column, out) for out, column in columns.items()]

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
        same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
        return left.join(other, same).drop(*[f"_right_{k}" for k in keys])

    return reduce(joined, counts)
