import time
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from accrualkit.llm import queries, sharding
from accrualkit.llm.common import set_apart

from cases import document_frame, odd_texts


def test_matrix_rows_and_columns_have_the_fixed_sums():
    sizes, shards = [5, 0, 17, 8, 30, 1, 9], sharding.exact_sizes(70, 8)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    rows = [sharding.matrix_row(b, starts, shards, 11) for b in range(len(sizes))]
    matrix = np.array([r for r, _ in rows])
    assert (matrix >= 0).all()
    assert matrix.sum(1).tolist() == sizes and matrix.sum(0).tolist() == shards.tolist()
    assert [before.tolist() for _, before in rows] == [matrix[:b].sum(0).tolist() for b in range(len(sizes))]


def test_matrix_follows_the_hypergeometric_law():
    starts, sizes = np.array([0, 6, 10]), np.array([5, 5])
    drawn = Counter(int(sharding.matrix_row(0, starts, sizes, seed)[0][0]) for seed in range(4000))
    want = {k: c / 210 for k, c in {1: 5, 2: 50, 3: 100, 4: 50, 5: 5}.items()}  # C(5,k) C(5,6-k) / C(10,6)
    assert all(abs(drawn[k] / 4000 - p) < 0.03 for k, p in want.items())


def test_a_block_costs_the_same_among_many():
    took = []
    for blocks in (400, 6400):
        starts, shards = np.arange(blocks + 1) * 16_384, sharding.exact_sizes(blocks * 16_384, 8)
        begin = time.process_time()
        for b in range(0, blocks, blocks // 20):
            sharding.matrix_row(b, starts, shards, 3)
        took.append(time.process_time() - begin)
    assert took[1] < 4 * max(took[0], 0.01)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_places_are_permuted_one_to_one_and_evenly(n):
    assert sorted(sharding.permuted(np.arange(n), n, 5).tolist()) == list(range(n))
    if n == 17:
        seen = Counter((x, int(y)) for key in range(3400) for x, y in enumerate(sharding.permuted(np.arange(n), n, key)))
        chi = sum((seen[x, y] - 200) ** 2 / 200 for x in range(n) for y in range(n))
        assert chi < 256 + 5 * (2 * 256) ** 0.5


def test_draws_beyond_numpys_range():
    rng = np.random.default_rng(1)
    draws = [sharding._hypergeometric(rng, 3 * 10**9, 10**9, 2 * 10**9) for _ in range(30)]
    assert abs(np.mean(draws) / (1.5 * 10**9) - 1) < 1e-4


@pytest.mark.parametrize("n, shards, block_rows", [(100, 8, 7), (3, 8, 10), (0, 8, 10), (64, 1, 9)])
def test_sizes_are_exact_and_slots_gapless(spark, n, shards, block_rows):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(n)], "doc_id long, text string")
    rows = sharding.shard(df, [F.col("doc_id"), F.col("text")], shards, block_rows=block_rows).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(n))
    counts = Counter(r["shard"] for r in rows)
    assert {counts[s] for s in range(shards)} <= {n // shards, n // shards + 1}
    for s in range(shards):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_the_shuffle_is_uniform(spark):
    df = spark.createDataFrame([(i,) for i in range(40)], "doc_id long")
    places = np.zeros((40, 4))
    for seed in range(60):
        for r in sharding.shard(df, [F.col("doc_id")], 4, seed=seed, block_rows=8).collect():
            places[r["doc_id"], r["shard"]] += 1
    assert ((places - 15) ** 2 / 15).sum() < 200  # chi-square, 120 degrees of freedom


def test_partitions_do_not_matter(spark):
    df = spark.createDataFrame([(i,) for i in range(500)], "doc_id long")
    place = lambda d: {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(d, [F.col("doc_id")], 8, block_rows=50).collect()}
    assert place(df.repartition(1)) == place(df.repartition(5))


def test_odd_rows(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    placed = sharding.shard(docs, [F.col("doc_id"), F.col("text")], 3, block_rows=4)
    assert placed.columns == [*["input_" * (c in ("shard", "slot")) + c for c in docs.columns], "shard", "slot"]
    rows = placed.collect()
    assert len(rows) == len(odd_texts()) and all(r["input_shard"] == "x" for r in rows)
    again = set_apart(placed, "shard")
    assert again.columns[-2] == "input_input_shard" and len(set(again.columns)) == len(again.columns)


def test_rows_alike_but_for_other_columns_are_ordered(spark):
    rows = [(1, "same", i) for i in range(60)]
    place = lambda r: {(x["v"], x["shard"], x["slot"]) for x in sharding.shard(spark.createDataFrame(r, "doc_id long, text string, v int"), [F.col("doc_id")], 4, block_rows=10).collect()}
    assert place(rows) == place(rows[::-1])


def test_query(spark):
    rows = queries.op9_sharding(spark, "/root/testdata/sf0.001").collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in rows:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "rows", None)
    assert Counter(Counter(r["shard"] for r in rows).values()) == {25: 8}
