import random

import pytest
import xxhash
from pyspark.sql import functions as F

from accrualkit.llm import queries, simhash

from cases import document_frame, odd_texts


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(values, bits):
    """Smallest index reachable from each index, over all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def clustered(rng, groups, members):
    out = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        out.add(centre)
        for _ in range(members):
            x = centre
            for _ in range(rng.randint(0, 4)):
                x ^= 1 << rng.randrange(64)
            out.add(x)
    return sorted(out, key=lambda _: rng.random())


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("paired_list", [1, 4, 1000])
def test_links_have_the_components_of_all_pairs(spark, bits, paired_list):
    rng = random.Random(bits + paired_list)
    values = clustered(rng, 6, 40) + [rng.getrandbits(64) for _ in range(20)]
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    edges = simhash.links(df, bits, paired_list)
    for u, v in edges.collect():
        assert u > v and ((u ^ v) & (1 << 64) - 1).bit_count() <= bits
    roots = dict(simhash.components(edges).collect())
    place = {v: i for i, v in enumerate(signed)}
    want = plain_components(values, bits)
    got = {}
    for i, v in enumerate(signed):
        got.setdefault(roots.get(v, v), []).append(i)
    assert {i: min(g) for g in got.values() for i in g} == dict(enumerate(want))
    assert len(place) == len(values)


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i + 1, i) for i in range(60)] + [(1000 + i, 1000) for i in range(1, 50)]
    got = dict(simhash.components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 50)}


@pytest.mark.parametrize("text", [None, "", " \n", "One", "a B", "A b C", "x y Z Ä q", "w " * 5000])
def test_fingerprint(text):
    assert simhash.fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    values = [plain_fingerprint(r["text"]) for r in docs]
    want = {r["doc_id"]: (f"{v:016x}", docs[c]["doc_id"]) for r, v, c in zip(docs, values, plain_components(values, 2))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op6_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_one_of_each(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns
    rows = left.collect()
    # 1 and 7 are equal, 2, 3, 4 and the null text have no words, 8 is there twice
    assert sorted((r["doc_id"] for r in rows if r["doc_id"] is not None)) == [1, 2, 5, 6, 8, 9, 10]
    assert [r["text"] for r in rows if r["doc_id"] is None] == ["text without an id at all"]
    assert simhash.one_of_each(docs.limit(0)).count() == 0
    found = simhash.near_duplicates(docs)
    assert found.count() == len(odd_texts())
    assert found.filter(F.col("id").isNull()).select("component").distinct().count() == 2


def test_rows_of_one_id_with_different_texts(spark):
    docs = document_frame(spark, [(1, "a b c d e f g"), (1, "completely other words in this one"), (2, "a b c d e f g")])
    assert sorted(r["text"] for r in simhash.one_of_each(docs).collect()) == ["a b c d e f g", "completely other words in this one"]
