import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from accrualkit.llm import merkle, queries

from cases import CLASHING, document_frame, odd_texts


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(nodes, fanout):
    """(top, path of each node): a path is a list of (left, right)."""
    paths, places, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, place in enumerate(places):
            first = place - place % fanout
            run = level[first : first + fanout]
            paths[i].append(("".join(run[: place - first]), "".join(run[place - first + 1 :])))
        level = [sha(*level[i : i + fanout]) for i in range(0, len(level), fanout)]
        places = [p // fanout for p in places]
    return level[0], paths


def plain_manifest(rows, fanout):
    """rows: (group, order, leaf); the sorted (leaf, path, subroot, root) of all."""
    groups = {}
    for g, o, leaf in rows:
        groups.setdefault(g, []).append((o is not None, o if o is not None else 0, leaf))
    keys = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[2] for x in sorted(groups[g])], fanout) for g in keys}
    if not keys:
        return []
    root, above = plain_tree([trees[g][0] for g in keys], fanout)
    out = []
    for g, up in zip(keys, above, strict=True):
        for (_, _, leaf), path in zip(sorted(groups[g]), trees[g][1], strict=True):
            out.append((leaf, tuple(path + up), trees[g][0], root))
    return sorted(out)


def built(df, fanout=2, slots=16, range_rows=merkle.RANGE_ROWS):
    tree = merkle.manifest(df, F.col("g"), [F.col("o")], F.col("leaf"), [F.col("g"), F.col("o")], fanout, slots, range_rows)
    rows = tree.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert all(r["folded"] == r["root"] for r in rows)
    return sorted((r["leaf"], tuple((s["left"], s["right"]) for s in r["path"]), r["subroot"], r["root"]) for r in rows)


@pytest.mark.parametrize("fanout, slots, range_rows", [(2, 16, 100), (2, 4, 7), (3, 16, 1000), (5, 2, 20)])
def test_every_path_equals_the_plain_tree(spark, fanout, slots, range_rows):
    rng = random.Random(fanout)
    sizes = {None: 3, "": 1, "a": 70, "é": 17, "z": 16, "Z": 33}
    rows = [(g, rng.choice([None, *range(40)]), sha(str(rng.random()))) for g, n in sizes.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, o long, leaf string").repartition(3)
    assert built(df, fanout, slots, range_rows) == plain_manifest(rows, fanout)


@pytest.mark.parametrize("rows", [[], [("a", 1, sha("x"))], [(None, None, sha("x"))], [("a", 1, sha("x")), ("b", 1, sha("y"))]])
def test_tiny_tables(spark, rows):
    assert built(spark.createDataFrame(rows, "g string, o long, leaf string")) == plain_manifest(rows, 2)


def test_one_row_repeated_is_cut_into_ranges(spark):
    rows = [("a", 5, sha("same"))] * 300 + [("a", i, sha(str(i))) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, o long, leaf string").repartition(4)
    assert built(df, range_rows=30) == plain_manifest(rows, 2)


def test_odd_documents_and_clashing_columns(spark):
    docs = document_frame(spark, [*odd_texts(), (31, "x", None), (32, "y", "", None)], extra=True)
    names = [c for c in docs.columns if c != "text"]
    leaf = merkle.leaf_digest(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    out = merkle.manifest(docs, F.col("lang"), [F.col("doc_id")], leaf, [F.col(c) for c in names]).collect()
    assert len(out) == docs.count() and all(r["size"] == "x" and r["block"] == "x" for r in out) and set(CLASHING) < set(out[0].__fields__)
    want = {sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"])]) for r in docs.collect()}
    assert {r["leaf"] for r in out} == want


def test_query_against_a_plain_tree(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    encode = lambda d, more=0: sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"] if d["n_chars"] is None else d["n_chars"] + more, d["text"])])
    plain = {leaf: (path, subroot, root) for leaf, path, subroot, root in plain_manifest([(d["lang"], d["doc_id"], encode(d)) for d in docs], 2)}
    got = {r["doc_id"]: r for r in queries.op13_merkle(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        r, (path, subroot, root) = got[d["doc_id"]], plain[encode(d)]
        assert (r["leaf"], r["subroot"], r["root"]) == (encode(d), subroot, root)
        assert r["proof_sha256"] == sha(*[a + b for a, b in path])
        own = encode(d, 1) if zlib.crc32(str(d["doc_id"]).encode()) % 7 == 0 else encode(d)
        for left, right in path:
            own = sha(left, own, right)
        assert r["folded_root"] == own and r["verified"] == (own == root)
    assert 0 < sum(not r["verified"] for r in got.values()) < len(docs)
