"""Merkle manifest of a dataset by a slot pivot.

Every row is a leaf.  Leaves are ordered within their group, every ``fanout``
consecutive nodes of a group become the digest of their concatenated digests,
and so on until one node, the group's subroot, is left; the subroots, ordered
by group (null first, then bytewise), become the root in the same way.

A block is the ``fanout ** depth`` nodes below one node ``depth`` levels up.
One aggregation with a conditional aggregate for each slot spreads the nodes
of a block into as many columns.  Concatenating the columns of a run hashes
it, level by level; the columns of a run without a node's own are that node's
siblings.  The digests that blocks end with are the nodes of the next, smaller
table.  The way back down is one join a table: siblings below a block, then
those above it.  Nothing but row counts reaches the driver.

Positions come from a range partitioning by group, order and place in the
stored copy: each range numbers its rows alone and adds how many of the group
earlier ranges hold.  So no task has more than a range, whatever share of the
rows one group, or one row repeated, holds.

Defined cases: a null group is a group of its own and the first one; null
order values come first; rows with equal group and order are ordered by leaf,
and rows that agree in that too get neighbouring places (which copy gets
which cannot matter to digests); empty and very long texts are hashed like any
other; an empty table has no leaves and no root; kept columns may have any
names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.llm.common import stored

FANOUT = 2
#: Slots of a block: ``fanout ** depth`` columns, as many as stay below this (one level at least).
SLOTS = 8
#: Rows of a range, about.
RANGE_ROWS = 100_000
PATH = "array<struct<left: string, right: string>>"


def digest(*values: Column) -> Column:
    """Lowercase hex sha256 of the values' bytes one after the other; nulls add nothing."""
    return F.sha2(F.concat_ws("", *values), 256)


def leaf_digest(*values: Column) -> Column:
    """The leaf of a row: each value as ``-`` if null, else its UTF-8 length in bytes, ``:`` and itself."""
    return digest(*[F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values])


def _numbered(rows: DataFrame, order: Sequence[str], range_rows: int) -> DataFrame:
    """``rows`` (with a text column g) with idx, from 0 in each g by ``order``, and n, the rows of g."""
    copy = stored(rows, "leaves")
    ranges = max(1, -(-copy.count() // range_rows))
    spread = copy.withColumn("at", F.monotonically_increasing_id()).repartitionByRange(ranges, "g", *order, "at")
    placed = stored(spread.withColumn("part", F.spark_partition_id()), "ranges")
    sizes = placed.groupBy("part", "g").agg(F.count(F.lit(1)).alias("rows"))
    # one row for each range that a group lies in
    group = Window.partitionBy("g")
    before = F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("part", "g", F.coalesce(before, F.lit(0)).alias("start"), F.sum("rows").over(group).alias("n"))
    inside = F.row_number().over(Window.partitionBy("part", "g").orderBy(*order, "at"))
    numbered = placed.withColumn("inside", inside).join(starts, ["part", "g"])
    return numbered.select(*rows.columns, (F.col("start") + F.col("inside") - 1).alias("idx"), "n")


def _depth(fanout: int, slots: int) -> int:
    depth = 1
    while fanout ** (depth + 1) <= slots:
        depth += 1
    return depth


def _blocks(nodes: DataFrame, fanout: int, depth: int) -> DataFrame:
    """g, idx, n, kept, digest of ``nodes`` with the path to the top of their block, and that top.

    A path lists for each level the digests left and right of the own one.
    """
    width = fanout**depth
    spread = [f"max(CASE WHEN pmod(idx, {width}) = {i} THEN struct(kept, digest) END) AS s{i}" for i in range(width)]
    pivot = nodes.groupBy("g", F.floor(F.col("idx") / width).alias("block")).agg(F.max("n").alias("n"), *map(F.expr, spread))
    wide = pivot.selectExpr("*", *[f"s{i}.digest AS l0_{i}" for i in range(width)])
    joined = lambda columns: f"concat_ws('', {', '.join(columns)})" if columns else "''"
    for level in range(depth):
        above = []
        for q in range(fanout ** (depth - level - 1)):
            run = [f"l{level}_{i}" for i in range(q * fanout, (q + 1) * fanout)]
            parent = f"CASE WHEN n > {fanout**level} THEN sha2({joined(run)}, 256) ELSE {run[0]} END"
            above.append(f"CASE WHEN {run[0]} IS NOT NULL THEN {parent} END AS l{level + 1}_{q}")
        wide = wide.selectExpr("*", *above)

    def child(i: int) -> str:
        steps = []
        for level in range(depth):
            own = i // fanout**level
            first = own - own % fanout
            run = [f"l{level}_{j}" for j in range(first, first + fanout)]
            left, right = joined(run[: own - first]), joined(run[own - first + 1 :])
            steps.append(f"named_struct('left', {left}, 'right', {right})")
        return f"named_struct('slot', {i}L, 'one', s{i}, 'path', array({', '.join(steps)}))"

    levels = " + ".join(f"int(n > {fanout**level})" for level in range(depth))
    children = f"explode(array({', '.join(child(i) for i in range(width))})) AS child"
    each = wide.selectExpr("g", "block", "n", f"l{depth}_0 AS top", children).filter("child.one IS NOT NULL")
    return each.selectExpr(
        "g", f"block * {width} + child.slot AS idx", "n", "child.one.kept AS kept", "child.one.digest AS digest",
        f"CAST(slice(child.path, 1, {levels}) AS {PATH}) AS path", "top",
    )


def _tree(nodes: DataFrame, above: Callable[[DataFrame], DataFrame], fanout: int, slots: int) -> DataFrame:
    """g, kept, digest, path, subroot, root of ``nodes`` (g, idx, n, kept, digest).

    ``above`` turns the groups' subroots (g, digest) into their g, path, subroot and root.
    """
    depth = _depth(fanout, slots)
    width = fanout**depth
    tables, rows = [], nodes
    while True:
        tables.append(stored(_blocks(rows, fanout, depth), "blocks"))
        largest = tables[-1].agg(F.max("n")).first()[0] or 0
        tops = tables[-1].filter(F.pmod("idx", F.lit(width)) == 0)
        rows = tops.select("g", F.floor(F.col("idx") / width).alias("idx"), F.ceil(F.col("n") / width).alias("n"), F.lit(None).cast("boolean").alias("kept"), F.col("top").alias("digest"))
        if largest <= width:
            break
    upper = above(rows.select("g", "digest")).select("g", F.lit(0).cast("long").alias("block"), F.col("path").alias("rest"), "subroot", "root")
    for level, table in reversed(list(enumerate(tables))):
        joined = table.withColumn("block", F.floor(F.col("idx") / width)).join(upper, ["g", "block"])
        down = joined.select("g", "idx", "kept", "digest", F.concat("path", "rest").alias("path"), "subroot", "root")
        if level:
            upper = stored(down.select("g", F.col("idx").alias("block"), F.col("path").alias("rest"), "subroot", "root"), "paths")
    return down


def manifest(
    df: DataFrame, group: Column, order: Sequence[Column], leaf: Column, keep: Sequence[Column] = (),
    fanout: int = FANOUT, slots: int = SLOTS, range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """``keep`` of each row, with its leaf, path, subroot and root.

    A path has for each level, from the leaf to the root, the concatenated
    digests left and right of the own one in its run.
    """
    if fanout < 2:
        raise ValueError("a run has two nodes at least")
    names = [f"o{i}" for i in range(len(order))]
    kept = df.select(*keep).columns if keep else []
    # null first: its key sorts before every other
    g = F.when(group.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), group.cast("string")))
    payload = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(keep)]) if keep else F.lit(None).cast("boolean")
    plain = df.select(g.alias("g"), *[c.alias(o) for c, o in zip(order, names, strict=True)], leaf.alias("digest"), payload.alias("kept"))
    nodes = _numbered(plain, [*names, "digest"], range_rows)

    def above(subroots: DataFrame) -> DataFrame:
        top = _numbered(subroots.select(F.lit("").alias("g"), F.col("g").alias("kept"), "digest"), ["kept"], range_rows)
        none = F.array().cast(PATH)
        tree = _tree(top, lambda root: root.select("g", none.alias("path"), F.col("digest").alias("subroot"), F.col("digest").alias("root")), fanout, slots)
        return tree.select(F.col("kept").alias("g"), "path", F.col("digest").alias("subroot"), "root")

    tree = _tree(nodes, above, fanout, slots)
    own = [F.col(f"kept.c{i}").alias(c) for i, c in enumerate(kept)]
    return tree.select(*own, F.col("digest").alias("leaf"), "path", "subroot", "root")


def siblings(path: Column) -> Column:
    """All digests of a path, level by level and left to right, in one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and the siblings of ``path`` give."""
    return F.aggregate(path, leaf, lambda own, step: digest(step["left"], own, step["right"]))
