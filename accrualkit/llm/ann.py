"""Approximate nearest neighbours by cosine: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample (``FIT_ROWS``) of the unit vectors: each
node splits its share by k-means into ``BRANCH`` children until a leaf stands
for about ``LEAF_ROWS`` rows (at most ``LEAVES`` leaves).  Every row goes down
to the leaf of the nearest centres.  A query keeps a priority queue of nodes,
opens the nearest one again and again, and visits leaves in the order in which
they come up.  How many leaves it visits is calibrated: some indexed rows are
searched exactly against all rows, and the visits are widened until the
leaves visited hold ``RECALL`` of their true neighbours (all leaves, if need
be, which is an exact search).

Neighbouring leaves make up a bin of about ``BLOCK_ROWS`` rows.  A query goes
to a bin once, with the leaves it visits there, and takes its nearest rows of
all of them with it, so what is compared leaves as one short list for each
query and bin.  A bin with more rows (one large leaf) is split into blocks of
rows and one with many visitors into blocks of visits, so no task holds more
than a block of each.  Of rows with the very same vector, only as many as can
be among the nearest (those of the smallest ids) are compared.

Scores are cosines of the original vectors in double precision, computed in
the same way for each pair, so equal vectors tie and ties go to the smaller id.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite
component take no part, neither do rows without an id; only vectors of equal
length are compared; a row that repeats another exactly counts once; a query
with fewer candidates than asked for gets all of them; empty tables give an
empty result; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.llm.common import bounded_sample, stored

NEAREST = 5
#: Rows that the tree is fitted on, about; children of a node; rows of a leaf, about; leaves at most.
FIT_ROWS, BRANCH, LEAF_ROWS, LEAVES = 20_000, 8, 256, 4096
#: Calibration: queries, and the share of their true neighbours that the visits must reach.
CALIBRATION, RECALL = 200, 0.96
BLOCK_ROWS, BLOCK_VISITS = 4096, 4096
#: Queries whose rough cosines with a block are held at a time.
ROUGH_VISITS = 256


@dataclass
class Tree:
    centres: np.ndarray  # (nodes, dimensions), unit length
    children: list[list[int]]  # of each node; none for a leaf
    leaf: np.ndarray  # number of a leaf node, else -1

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector: the nearest child, level by level."""
        node = np.zeros(len(unit), np.int64)
        while True:
            inner = [n for n in np.unique(node).tolist() if self.children[n]]
            if not inner:
                return self.leaf[node]
            for n in inner:
                here = np.flatnonzero(node == n)
                own = np.array(self.children[n])
                node[here] = own[np.argmax(unit[here] @ self.centres[own].T, axis=1)]

    def visits(self, unit: np.ndarray, most: int) -> Iterator[int]:
        """Leaves in the order in which best-bin-first search reaches them."""
        near = self.centres @ unit
        queue, reached = [(0.0, 0)], 0
        while queue and reached < most:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                reached += 1
                yield int(self.leaf[node])
            for child in self.children[node]:
                heapq.heappush(queue, (-float(near[child]), child))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Cluster of each unit vector; up to ``k`` clusters."""
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    own = np.zeros(len(x), np.int64)
    for _ in range(12):
        own = np.argmax(x @ centres.T, axis=1)
        for j in range(len(centres)):
            mine = x[own == j]
            mean = mine.sum(0) if len(mine) else x[rng.integers(len(x))]
            centres[j] = mean / max(1e-12, np.linalg.norm(mean))
    return own


def fit_tree(unit: np.ndarray, leaf_share: float, seed: int = 3) -> Tree:
    """A tree whose leaves hold about ``leaf_share`` of the sample each."""
    rng = np.random.default_rng(seed)
    centres, children, leaf = [np.zeros(unit.shape[1])], [[]], [-1]
    waiting, leaves = [(0, np.arange(len(unit)))], 0
    while waiting:
        node, rows = waiting.pop(0)
        parts = []
        if len(rows) > max(1.0, leaf_share * len(unit)):
            own = _kmeans(unit[rows], int(min(BRANCH, np.ceil(len(rows) / max(1.0, leaf_share * len(unit))))), rng)
            parts = [rows[own == j] for j in np.unique(own)]
        if len(parts) < 2:
            leaf[node], leaves = leaves, leaves + 1
            continue
        for part in parts:
            mean = unit[part].sum(0)
            children[node].append(len(centres))
            waiting.append((len(centres), part))
            centres.append(mean / max(1e-12, np.linalg.norm(mean)))
            children.append([])
            leaf.append(-1)
    return Tree(np.array(centres), children, np.array(leaf))


def _vectors(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.maximum(np.abs(x).max(axis=1, keepdims=True), 1e-300)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row, in double precision; equal rows give equal results."""
    length = np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((query * query).sum())
    return (rows * query).sum(axis=1) / length


def nearest(query: np.ndarray, rows: np.ndarray, rough: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, cosines) of the ``k`` nearest rows other than ``own``; ``rough`` are cosines up to rounding."""
    others = ids != own
    if others.sum() > k:
        bound = np.partition(rough[others], -k)[-k] - 1e-9
        at = np.flatnonzero(others & (rough >= bound))
    else:
        at = np.flatnonzero(others)
    exact = cosines(query, rows[at])
    order = np.lexsort((ids[at], -exact))[:k]
    return at[order], exact[order]


def usable(df: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector, length of the rows that take part."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(v, lambda x: x != 0)
    plain = df.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return plain.filter(F.col("id").isNotNull() & v.isNotNull() & finite & some).withColumn("length", F.size("vector"))


_HITS = pa.schema([("query", pa.int64()), ("id", pa.int64()), ("score", pa.float64()), ("leaf", pa.int64())])
_HITS_DDL = "query long, id long, score double, leaf long"


def _hits(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 4, _HITS, strict=True)], schema=_HITS)


def best(hits: DataFrame, k: int) -> DataFrame:
    """The ``k`` best hits of each query, with rank from 1."""
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "id"))
    return hits.withColumn("rank", rank).filter(F.col("rank") <= k)


def exact_hits(queries: list[tuple[int, list[float]]], tree: Tree, k: int):
    """The ``k`` nearest rows of a batch (id, vector) for a bounded set of queries, with their leaves."""
    q = np.array([v for _, v in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, x = batch.column(0).to_numpy(), _vectors(batch.column(1))
            unit = _unit(x)
            leaf, rough = tree.assign(unit), _unit(q) @ unit.T
            rows = []
            for i, (own, _) in enumerate(queries):
                at, score = nearest(q[i], x, rough[i], ids, own, k)
                rows += [(own, int(ids[j]), float(s), int(leaf[j])) for j, s in zip(at, score, strict=True)]
            yield _hits(rows)

    return run


def calibrate(rows: DataFrame, tree: Tree, k: int, queries: int = CALIBRATION, recall: float = RECALL) -> int:
    """How many leaves to visit so that ``recall`` of the true neighbours are reached."""
    some = [(r["id"], list(r["vector"])) for r in bounded_sample(rows, F.col("id"), queries).select("id", "vector").limit(2 * queries).collect()]
    if not some:
        return 1
    truth = best(rows.select("id", "vector").mapInArrow(exact_hits(some, tree, k), _HITS_DDL), k).select("query", "leaf").collect()
    at = {}
    for own, vector in some:
        at[own] = {leaf: i for i, leaf in enumerate(tree.visits(_unit(np.array([vector]))[0], tree.leaves))}
    reached = sorted(at[r["query"]][r["leaf"]] + 1 for r in truth)
    return reached[min(len(reached) - 1, int(np.ceil(recall * len(reached))) - 1)] if reached else 1


def _with_leaf(tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = pa.array(tree.assign(_unit(_vectors(batch.column(1)))))
                yield pa.RecordBatch.from_arrays([*batch.columns, leaf], names=["id", "vector", "leaf"])

    return run


def leaf_bins(counts: dict[int, int], leaves: int, rows: int) -> np.ndarray:
    """Bin of each leaf: neighbouring leaves up to about ``rows`` rows, a larger leaf by itself."""
    bins, held, current = np.zeros(leaves, np.int64), 0, 0
    for leaf in range(leaves):
        n = counts.get(leaf, 0)
        if held and held + n > rows:
            current, held = current + 1, 0
        bins[leaf] = current
        held += n
    return bins


def _with_visits(tree: Tree, most: int, bins: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at, where, leaves = [], [], []
            for i, u in enumerate(_unit(_vectors(batch.column(1)))):
                reached = np.sort(np.fromiter(tree.visits(u, most), np.int64))
                for own in np.unique(bins[reached]):
                    at.append(i)
                    where.append(int(own))
                    leaves.append(reached[bins[reached] == own])
            columns = [c.take(pa.array(at, pa.int64())) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(where, pa.int64()), pa.array(leaves, pa.list_(pa.int64()))], names=["id", "vector", "bin", "leaves"]
            )

    return run


def _compare(k: int):
    def run(key: tuple, rows: pa.Table, visits: pa.Table) -> pa.Table:
        if not rows.num_rows or not visits.num_rows:
            return pa.Table.from_batches([_hits([])])
        rows = rows.sort_by("leaf").combine_chunks()
        ids, x = rows.column("id").to_numpy(), _vectors(rows.column("vector").combine_chunks())
        leaf, first = np.unique(rows.column("leaf").to_numpy(), return_index=True)
        places = dict(zip(leaf.tolist(), np.split(np.arange(len(ids)), first[1:]), strict=True))
        q, leaves = _vectors(visits.column("vector").combine_chunks()), visits.column("leaves").to_pylist()
        unit, out = _unit(x), []
        for low in range(0, len(q), ROUGH_VISITS):
            rough = _unit(q[low : low + ROUGH_VISITS]) @ unit.T
            for i, own in enumerate(visits.column("id").slice(low, ROUGH_VISITS).to_pylist(), low):
                inside = [places[n] for n in leaves[i] if n in places]
                if not inside:
                    continue
                here = np.concatenate(inside)
                at, score = nearest(q[i], x[here], rough[i - low, here], ids[here], own, k)
                out += [(own, int(ids[here[j]]), float(s), key[0].as_py()) for j, s in zip(at, score, strict=True)]
        return pa.Table.from_batches([_hits(out)])

    return run


def _blocks(counts: dict[int, int], rows: int) -> Column:
    """Number of blocks of each bin (at most one a leaf, so ``LEAVES``)."""
    many = {own: -(-n // rows) for own, n in counts.items() if n > 2 * rows}
    if not many:
        return F.lit(1)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in many.items() for x in kv])[F.col("bin")], F.lit(1))


def search(rows: DataFrame, queries: DataFrame, k: int = NEAREST, recall: float = RECALL, leaf_rows: int = LEAF_ROWS, fit_rows: int = FIT_ROWS) -> DataFrame:
    """query, rank, id, score: the ``k`` nearest ``rows`` of each of ``queries`` (both as of ``usable``)."""
    # enough of each set of equal vectors: the k nearest of a query, and the query itself
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    rows = stored(rows.distinct().withColumn("nth", nth).filter(F.col("nth") <= k + 1).drop("nth"), "vectors")
    found = None
    for size in rows.groupBy("length").count().orderBy("length").collect():
        part = _search_length(
            rows.filter(F.col("length") == size["length"]), queries.filter(F.col("length") == size["length"]), size["count"], k, recall, leaf_rows, fit_rows
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], _HITS_DDL + ", rank int")
    return best(found.drop("rank"), k).select("query", "rank", "id", "score")


def _search_length(rows: DataFrame, queries: DataFrame, n: int, k: int, recall: float, leaf_rows: int, fit_rows: int) -> DataFrame:
    sample = bounded_sample(rows, F.col("id"), fit_rows).select("id", "vector").limit(2 * fit_rows).toArrow().sort_by("id")
    x = _vectors(sample.column("vector").combine_chunks())
    leaves = min(LEAVES, max(1, n // leaf_rows))
    tree = fit_tree(_unit(x), 1.0 / leaves) if len(x) else Tree(np.zeros((1, 1)), [[]], np.array([0]))
    most = calibrate(rows, tree, k, recall=recall)
    placed = stored(rows.select("id", "vector").mapInArrow(_with_leaf(tree), "id long, vector array<double>, leaf long"), "leaves")
    counts = dict(placed.groupBy("leaf").count().collect())
    bins = leaf_bins(counts, tree.leaves, BLOCK_ROWS)
    # one row a leaf: at most LEAVES
    bin_of = F.broadcast(rows.sparkSession.createDataFrame(list(enumerate(bins.tolist())), "leaf long, bin long"))
    placed = placed.join(bin_of, "leaf")
    visits = stored(
        queries.select("id", "vector").distinct().mapInArrow(_with_visits(tree, most, bins), "id long, vector array<double>, bin long, leaves array<long>"),
        "visits",
    )
    sizes: dict[int, int] = {}
    for leaf, n in counts.items():
        sizes[int(bins[leaf])] = sizes.get(int(bins[leaf]), 0) + n
    row_blocks = _blocks(sizes, BLOCK_ROWS)
    visit_blocks = _blocks(dict(visits.groupBy("bin").count().collect()), BLOCK_VISITS)

    def spread(df: DataFrame, own: str, own_blocks: Column, other: str, other_blocks: Column) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("id", "vector"), own_blocks).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), other_blocks.cast("int") - 1))
        )

    keys = ["bin", "row_block", "visit_block"]
    left = spread(placed, "row_block", row_blocks, "visit_block", visit_blocks).groupBy(*keys)
    right = spread(visits, "visit_block", visit_blocks, "row_block", row_blocks).groupBy(*keys)
    return left.cogroup(right).applyInArrow(_compare(k), _HITS_DDL).withColumn("rank", F.lit(0))
