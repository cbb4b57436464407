"""Mixing sources to target weights by pivotal dependent rounding.

Each document has an expected number of copies, its source's target divided
by its source's size.  The whole part is taken as it is.  The fractional parts
are rounded dependently: documents of a source meet in pairs and exchange mass
(size times probability), in a random direction that leaves all expectations
unchanged, until one of them is decided.  So the mass taken from a source
stays exactly at its target until the very last document, whatever the sizes
are.

The exchange runs as a reduction tree.  Documents are dealt to buckets by a
hash of their content, each bucket leaves one undecided document per source,
and ``FAN`` buckets meet in a node of the next level.  Large documents are decided
first, so that what is undecided last tends to be small.  The random numbers are
hashes of the two documents, so a rerun, another partitioning or a recomputed
task decides alike.

Defined cases: a null or empty text has size 0 and is never taken beyond the
whole part of its rate (its words are 0 anyway).  A null source is a source of
its own, ordered last.  A source of size 0 has target 0.  Repeated rows are
decided one by one.  A very long text counts by its words, like any other.  An
empty table gives an empty result.  ``mix_documents`` keeps all columns,
whatever their names are.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.llm.common import MASK64, fresh, mix64, stored

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source's target stops at so many times its size.
MAX_COPIES = 3
#: Documents per bucket, and nodes that meet in a node of the next level.
BUCKET_ROWS = 16_384
FAN = 16

BLANKS = " \t\n\u000b\f\r"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for null."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(F.coalesce(F.length(trimmed), F.lit(0)) == 0, F.lit(0)).otherwise(
        F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))
    ).cast("long")


def ranked(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``rank`` (from 0) by ``column``, nulls last, without one task seeing all rows.

    A range partitioning orders the rows between partitions, a window inside
    them; the driver sees one count per partition.
    """
    order = F.col(column).asc_nulls_last()
    parts = stored(df.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ranked")
    offsets, total = [], 0
    for row in sorted(parts.groupBy("part").count().collect()):
        offsets.append((row["part"], total))
        total += row["count"]
    if not offsets:
        return parts.drop("part").withColumn("rank", F.lit(0).cast("long"))
    starts = df.sparkSession.createDataFrame(offsets, "part int, start long")
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order))
    return (
        parts.withColumn("inside", inside)
        .join(F.broadcast(starts), "part")
        .withColumn("rank", F.col("start") + F.col("inside") - 1)
        .drop("part", "inside", "start")
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """One row per source: source, rank, source_size, target.

    The targets share the total size by weight and stop at ``most`` times the
    source's size; the excess is shared again.  That level is one number per
    weight unit, so each round is one aggregation over the sources and the
    driver sees two sums.
    """
    totals = ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    totals = stored(totals.withColumn("weight", weight), "sources")
    total = totals.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("source_size") * most < F.col("weight") * level
        held, free = totals.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not free:
            break
        raised = (total - held) / free
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("source_size").cast("double") * most, F.col("weight") * F.lit(level))
    return totals.select("source", "rank", "source_size", target.alias("target"))


# --- the exchange -----------------------------------------------------------

_STATE = pa.schema(
    [
        ("id", pa.int64()), ("h", pa.int64()), ("rank", pa.int64()), ("node", pa.int64()),
        ("size", pa.int64()), ("whole", pa.int64()), ("p", pa.float64()), ("copies", pa.int64()),
    ]
)
_STATE_DDL = "id long, h long, rank long, node long, size long, whole long, p double, copies long"
_EDGE = 1e-9


def _uniform(a: int, b: int, seed: int) -> float:
    return mix64((mix64((a & MASK64) ^ seed) + (b & MASK64)) & MASK64) / 2.0**64


def exchange(p_i: float, a_i: float, p_j: float, a_j: float, u: float) -> tuple[float, float]:
    """Move mass between two probabilities until one is 0 or 1; expectations stay."""
    up, down = min(a_i * (1 - p_i), a_j * p_j), min(a_i * p_i, a_j * (1 - p_j))
    if u * (up + down) < down:
        return _snap(p_i + up / a_i), _snap(p_j - up / a_j)
    return _snap(p_i - down / a_i), _snap(p_j + down / a_j)


def _snap(p: float) -> float:
    return 0.0 if p < _EDGE else 1.0 if p > 1 - _EDGE else p


def _open(p: float) -> bool:
    return 0.0 < p < 1.0


def round_group(h: list[int], size: list[int], p: list[float], seed: int) -> None:
    """Round ``p`` in place until at most one entry is fractional; the sum of size * p stays.

    The largest undecided document draws whether it goes up (with its own
    probability) or down, and meets the next ones in order of size.  Each of
    them gives, or takes, the share that it could exchange in either case, so
    its expectation stays; the shares add up until the large one is integral.
    If all shares together do not suffice, two plain exchanges go on.
    """
    waiting = deque(sorted((i for i in range(len(p)) if _open(p[i])), key=lambda i: (-size[i], h[i])))
    draw = 0
    while len(waiting) > 1:
        i, met, share, draw = waiting.popleft(), [], 0.0, draw + 1
        a, start = size[i], p[i]
        up = _uniform(h[i], draw, seed) < start
        while share < 1.0 and waiting:
            j = waiting.popleft()
            f = min(size[j] * p[j] / (a * (1 - start)), size[j] * (1 - p[j]) / (a * start), 1.0 - share)
            p[j] = _snap(p[j] - f * a * (1 - start) / size[j] if up else p[j] + f * a * start / size[j])
            share += f
            if share > 1 - _EDGE:
                share = 1.0
            if _open(p[j]):
                met.append(j)
        p[i] = _snap(start + share * (1 - start) if up else start - share * start)
        waiting.extendleft(reversed(met))
        if _open(p[i]):
            while waiting and _open(p[i]):
                j, draw = waiting.popleft(), draw + 1
                p[i], p[j] = exchange(p[i], a, p[j], size[j], _uniform(h[i], h[j] + draw, seed))
                if _open(p[j]):
                    waiting.appendleft(j)
            if _open(p[i]):
                waiting.appendleft(i)


def _pair_up(seed: int, last: bool):
    """Rows sorted by (node, rank): decide all but one of each; the last level decides that one as well.

    A (node, rank) has about ``BUCKET_ROWS`` rows at most, or ``FAN`` further up.
    """

    def decided(rows: list[list]) -> pa.RecordBatch:
        _, h, _, _, size, whole, p, _ = (list(c) for c in zip(*rows, strict=True))
        p = [x if a else 0.0 for x, a in zip(map(_snap, p), size, strict=True)]
        round_group(h, size, p, seed)
        if last:
            p = [float(_uniform(a, 0, seed) < x) if _open(x) else x for a, x in zip(h, p, strict=True)]
        copies = [None if _open(x) else w + int(x) for w, x in zip(whole, p, strict=True)]
        columns = [*list(zip(*rows, strict=True))[:6], p, copies]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _STATE, strict=True)], schema=_STATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[list] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and (group[0][3], group[0][2]) != (row[3], row[2]):
                    yield decided(group)
                    group = []
                group.append(row)
        if group:
            yield decided(group)

    return run


def mix(rows: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """How often each row is taken.

    ``rows`` has id, h (a hash of the row's content), source, size.  Returns
    id, h, source, size, source_size, target, copies: one row for each row.
    """
    sized = stored(rows.select("id", "h", "source", "size"), "sized")
    sources = stored(source_targets(sized, weights), "targets")
    n = sized.count()
    buckets = max(1, -(-n // bucket_rows))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = sized.join(sources, sized["source"].eqNullSafe(sources["source"])).select(
        "id", "h", "rank", F.pmod(F.xxhash64("h"), F.lit(buckets)).alias("node"), "size",
        F.floor(rate).cast("long").alias("whole"), (rate - F.floor(rate)).alias("p"), F.lit(None).cast("long").alias("copies"),
    )
    decided, level = [], 0
    while True:
        last = buckets == 1
        state = stored(
            rated.repartition(buckets, "node")
            .sortWithinPartitions("node", "rank", "h", "id")
            .mapInArrow(_pair_up(mix64(seed + level), last), _STATE_DDL),
            f"mix{level}",
        )
        decided.append(state.filter(F.col("copies").isNotNull()))
        if last:
            break
        buckets, level = -(-buckets // FAN), level + 1
        rated = state.filter(F.col("copies").isNull()).withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
    taken = decided[0]
    for more in decided[1:]:
        taken = taken.unionByName(more)
    return taken.join(sources, "rank").select("id", "h", "source", "size", "source_size", "target", "copies")


def mix_documents(docs: DataFrame, seed: int = 17, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken, all columns kept."""
    h, c, m, i = fresh(docs, "h", "copies", "rows", "nth")
    keyed = docs.withColumn(h, F.xxhash64("doc_id", "text", "source"))
    rows = keyed.select(F.col("doc_id").cast("long").alias("id"), F.col(h).alias("h"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"))
    counts = mix(rows, seed, weights).groupBy(F.col("h").alias("mix_h")).agg(F.sum("copies").alias(c), F.count("*").alias(m))
    counts = stored(counts.filter(F.col(c) > 0), "copies")
    # rows alike in id, text and source share their copies evenly
    nth = F.row_number().over(Window.partitionBy(h).orderBy(h))
    own = F.floor(F.col(c) / F.col(m)) + (F.col(i) <= F.col(c) % F.col(m)).cast("long")
    joined = keyed.join(counts, keyed[h] == counts["mix_h"]).withColumn(i, nth)
    repeated = joined.withColumn(c, own.cast("int")).withColumn(i, F.explode(F.array_repeat(F.lit(1), F.col(c))))
    return repeated.select(*docs.columns)
