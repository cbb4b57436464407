"""Choosing rows by a set of keys that may be too large to broadcast.

``choose`` keeps the rows whose key is among the chosen ones.  The chosen keys
are counted first.  Up to ``BROADCAST_KEYS`` they are broadcast, so the rows
are filtered where they are read.  Beyond that a Bloom filter of fixed size,
built by one aggregation, does most of this: it is an uncorrelated scalar
subquery, so it is there before the scan of the rows starts and no row that it
rejects is shuffled.  A semi join on the remaining rows makes the result exact.

The filter is blocked: a key sets four bits of one 64-bit word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrualkit.plans.materialize import reuse

#: Keys that are broadcast at most.
BROADCAST_KEYS = 1_000_000
#: Words of a filter (8 bytes each): at 4 million keys 2 % of the other rows pass.
WORDS = 1 << 20
_BITS = " | ".join(f"shiftleft(1L, int(shiftright(hashed, {6 * i}) & 63))" for i in range(4))


def _word(words: int) -> str:
    return f"int(pmod(shiftright(hashed, 24), {words}))"


def bloom_filter(keys: DataFrame, key: str, words: int = WORDS) -> DataFrame:
    """One row with ``words``, the words of the filter of ``keys`` in order."""
    spark = keys.sparkSession
    set_bits = keys.select(F.xxhash64(key).alias("hashed")).selectExpr(f"{_word(words)} AS word", f"{_BITS} AS bits")
    every = spark.range(words).selectExpr("int(id) AS word", "0L AS bits")
    each = set_bits.unionByName(every).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return each.agg(F.transform(in_order, lambda w: w["bits"]).alias("words"))


def may_hold(filter_words: Column, key: Column, words: int = WORDS) -> Column:
    """Whether ``key`` may be among the keys of the filter (never false for one that is)."""
    hashed = F.xxhash64(key)
    word = F.pmod(F.shiftright(hashed, 24), F.lit(words)).cast("int")
    one = F.lit(1).cast("long")
    bits = None
    for i in range(4):
        place = F.shiftright(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bit = F.call_function("shiftleft", one, place)
        bits = bit if bits is None else bits.bitwiseOR(bit)
    return F.get(filter_words, word).bitwiseAND(bits) == bits


def choose(
    rows: DataFrame, key: str, chosen: DataFrame, chosen_key: str, broadcast_keys: int = BROADCAST_KEYS, words: int = WORDS
) -> DataFrame:
    """Rows of ``rows`` whose ``key`` is a ``chosen_key`` of ``chosen`` (pass it materialised: it is counted first)."""
    wanted = chosen.select(F.col(chosen_key).alias("_chosen_key"))
    if chosen.count() <= broadcast_keys:
        return rows.join(F.broadcast(wanted), rows[key] == F.col("_chosen_key"), "left_semi")
    words_of = bloom_filter(reuse(wanted.filter("_chosen_key IS NOT NULL")), "_chosen_key", words).scalar()
    return rows.filter(may_hold(words_of, rows[key], words)).join(wanted, rows[key] == F.col("_chosen_key"), "left_semi")
