"""Uniform shuffle into shards of exact sizes, by a hypergeometric communication matrix.

Rows are dealt to blocks by a hash of their content (so the blocks do not
depend on files or partitions).  How many rows each block sends to each shard
follows the multivariate hypergeometric law that a uniform permutation has,
with the shard sizes fixed beforehand.  The counts are drawn by halving the
list of blocks: the left half's share of the shards is one draw from the whole,
and so on down to a block.  Each node has its own seed, so a task finds its row
of the matrix alone, in about log2(blocks) draws a shard, however many blocks
there are; on the way it adds up what the blocks before it send to each shard.
No matrix passes through the driver, which only sees the block sizes.

Then a block deals its rows in random order (first permutation).  The rows of
a shard are thereby numbered from 0, block by block, and a keyed bijection of
these numbers (second permutation) is the place of a row in its shard.  Rows
are exchanged by stretches of places, so a shard is as many tasks as it needs.

Rows of a block are ordered by a hash of all columns, so a repeated task deals
them in the same way; rows equal in all columns are interchangeable.

Defined cases: null ids and texts are ordinary values; very long texts travel
once; repeated rows are shuffled one by one (rows alike in ``by`` share a
block); an empty table gives an empty result; columns of the input are all
kept, those called like a new one as ``input_<name>``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accrualkit.llm.common import mix64, set_apart

#: Rows of a block and of a stretch of places, about.
BLOCK_ROWS = 16_384


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """One draw; beyond the range of numpy's sampler by inversion around the mode."""
    if max(good, bad, n) < 10**9:
        return int(rng.hypergeometric(good, bad, n)) if good and n else 0
    total = good + bad
    low, high = max(0, n - bad), min(n, good)
    mean = n * (good / total)
    spread = math.sqrt(max(1.0, mean * (bad / total) * ((total - n) / max(1, total - 1))))
    k = np.arange(max(low, int(mean - 12 * spread)), min(high, int(mean + 12 * spread)) + 1, dtype=np.float64)
    # logs of successive ratios P(k+1) / P(k), summed from the left end
    ratio = np.log(good - k[:-1]) + np.log(n - k[:-1]) - np.log(k[:-1] + 1) - np.log(bad - n + k[:-1] + 1)
    logs = np.concatenate([[0.0], np.cumsum(ratio)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return int(k[min(len(k) - 1, np.searchsorted(weights, rng.random() * weights[-1]))])


def draw_counts(rng: np.random.Generator, cells: np.ndarray, n: int) -> np.ndarray:
    """How many of ``n`` rows drawn without replacement come from each cell."""
    out, rest = np.zeros_like(cells), int(cells.sum())
    for j, size in enumerate(cells.tolist()):
        rest -= size
        out[j] = got = _hypergeometric(rng, size, rest, n)
        n -= got
    return out


def matrix_row(block: int, starts: np.ndarray, sizes: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Row ``block`` of the communication matrix, and the sum of the rows before it.

    ``starts`` are the cumulated block sizes, ``sizes`` those of the shards.
    """
    low, high, before = 0, len(starts) - 1, np.zeros_like(sizes)
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = draw_counts(rng, sizes, int(starts[middle] - starts[low]))
        if block < middle:
            sizes, high = left, middle
        else:
            sizes, low, before = sizes - left, middle, before + left
    return sizes, before


def exact_sizes(n: int, shards: int) -> np.ndarray:
    return np.array([n // shards + (j < n % shards) for j in range(shards)], dtype=np.int64)


def permuted(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A bijection of 0 .. n - 1 chosen by ``key``, at ``x``: a Feistel network that is run again until it is below n."""
    half = np.uint64(max(1, -(-max(1, n - 1).bit_length() // 2)))
    mask = np.uint64((1 << int(half)) - 1)
    out, waiting = np.zeros(len(x), np.int64), np.arange(len(x))
    value = x.astype(np.uint64)
    while len(waiting):
        left, right = value >> half, value & mask
        for turn in range(6):
            mixed = right + np.uint64(mix64(key * 6 + turn))
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                mixed = (mixed ^ mixed >> np.uint64(shift)) * np.uint64(factor)
            left, right = right, left ^ (mixed ^ mixed >> np.uint64(31)) & mask
        value = left << half | right
        inside = value < n
        out[waiting[inside]] = value[inside].astype(np.int64)
        waiting, value = waiting[~inside], value[~inside]
    return out


def _deal(starts: np.ndarray, sizes: np.ndarray, seed: int, block_at: int):
    def plan(block: int) -> tuple[np.ndarray, np.ndarray]:
        """Shard and slot of each row of a block."""
        counts, before = matrix_row(block, starts, sizes, seed)
        shard = np.repeat(np.arange(len(sizes)), counts)
        first = np.repeat(before - np.cumsum(counts) + counts, counts)
        place, slot = np.arange(len(shard)) + first, np.empty(len(shard), np.int64)
        for s in np.flatnonzero(counts).tolist():
            own = shard == s
            slot[own] = permuted(place[own], int(sizes[s]), mix64(seed) + s)
        order = np.random.default_rng([seed, 1, block]).permutation(len(shard))
        return shard[order], slot[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, shards, slots, at = None, None, None, 0
        for batch in batches:
            blocks = batch.column(block_at).to_numpy(zero_copy_only=False)
            shard, slot = np.empty(len(blocks), np.int32), np.empty(len(blocks), np.int64)
            edges = np.flatnonzero(np.diff(blocks)) + 1
            for low, high in zip([0, *edges], [*edges, len(blocks)], strict=True):
                if high == low:
                    continue
                if blocks[low] != current:
                    if shards is not None and at != len(shards):
                        raise RuntimeError(f"block {current} has changed since it was counted")
                    current, at = int(blocks[low]), 0
                    shards, slots = plan(current)
                if at + high - low > len(shards):
                    raise RuntimeError(f"block {current} has changed since it was counted")
                shard[low:high], slot[low:high] = shards[at : at + high - low], slots[at : at + high - low]
                at += high - low
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard), pa.array(slot)], names=[*batch.schema.names, "shard", "slot"])

    return run


def shard(df: DataFrame, by: list[Column], shards: int, seed: int = 29, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``df`` with shard (from 0) and slot (gapless from 0 in its shard), sizes at most one apart.

    ``by`` are the columns whose values tell rows apart; they only deal rows
    to blocks.  The new columns are the last two.
    """
    names = set_apart(df, "shard", "slot").columns
    inner = [f"c{i}" for i in range(len(names))]
    hashable = [c for c, f in zip(df.columns, df.schema.fields, strict=True) if not isinstance(f.dataType, T.MapType)]
    plain = df.select(F.xxhash64(*by).alias("h"), F.xxhash64(*[F.col(f"`{c}`") for c in hashable]).alias("tie"), *[F.col(f"`{c}`").alias(i) for c, i in zip(df.columns, inner, strict=True)])
    sized = plain.select("h")
    n = sized.count()
    blocks = max(1, -(-n // block_rows))
    block = F.pmod(F.xxhash64("h", F.lit(seed)), F.lit(blocks)).cast("long")
    counted = dict(sized.groupBy(block.alias("block")).count().collect())
    starts = np.concatenate([[0], np.cumsum([counted.get(b, 0) for b in range(blocks)])]).astype(np.int64)
    fields = ", ".join(f"{i} {f.dataType.simpleString()}" for i, f in zip(inner, df.schema.fields, strict=True))
    dealt = (
        plain.withColumn("block", block)
        .repartitionById(blocks, F.col("block").cast("int"))
        .sortWithinPartitions("block", "h", "tie")
        .mapInArrow(_deal(starts, exact_sizes(n, shards), seed, len(inner) + 2), f"h long, tie long, {fields}, block long, shard int, slot long")
    )
    per_shard = max(1, -(-n // (shards * block_rows)))
    cell = F.col("shard") * per_shard + F.least(F.lit(per_shard - 1), F.floor(F.col("slot") / block_rows)).cast("int")
    placed = dealt.repartitionById(shards * per_shard, cell.cast("int")).sortWithinPartitions("shard", "slot")
    return placed.select(*[F.col(i).alias(c) for c, i in zip(names, inner, strict=True)], "shard", "slot")


def shard_sizes(text: Column) -> list[Column]:
    """size (UTF-8 bytes and one) and text_crc32 of a text; null counts as empty."""
    filled = F.coalesce(text, F.lit(""))
    return [(F.octet_length(filled) + 1).cast("long").alias("size"), F.crc32(filled).alias("text_crc32")]
