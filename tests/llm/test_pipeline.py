from collections import Counter

import pytest
from cases import document_frame, odd_texts
from pyspark.sql import functions as F

import corpus_pipeline
from accrualkit.llm import decontaminate, queries, simhash
from accrualkit.llm.common import documents, stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """Rows after each stage, by name."""
    out, docs = {"documents": documents(spark, SF)}, documents(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF), name)
    return out


def ids(df):
    return Counter(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns(kept):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]
    for name in names[:-1]:
        assert kept[name].columns == kept["documents"].columns


def test_near_duplicates_against_all_pairs(kept):
    rows = kept["toxicity"].select("doc_id", "text").orderBy("doc_id").collect()
    values = [simhash.fingerprint(r["text"].encode()) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert ids(kept["near_duplicates"]) == Counter(rows[i]["doc_id"] for i in range(len(rows)) if find(i) == i)


def test_decontamination_against_all_pairs(spark, kept):
    items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in items]
    clean = Counter()
    for r in kept["near_duplicates"].collect():
        w = decontaminate.words_of(r["text"])
        own = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        clean[r["doc_id"]] += not any(len(s & own) >= 0.8 * len(s) for s in sets)
    assert ids(kept["decontamination"]) == +clean


def test_toxic_documents_go_and_clean_ones_stay(spark, kept):
    scored = queries.op7_toxicity(spark, SF).filter("predicted = 0")
    assert ids(kept["toxicity"]) == ids(scored)


def test_mixing_and_sharding(kept):
    mixed, placed = ids(kept["mixing"]), ids(kept["sharding"])
    assert placed == mixed and set(mixed) <= set(ids(kept["decontamination"])) and max(mixed.values()) <= 3
    sizes = kept["sharding"].groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("last"), F.countDistinct("slot").alias("slots")).collect()
    assert max(r["n"] for r in sizes) - min(r["n"] for r in sizes) <= 1
    assert all(r["last"] + 1 == r["n"] == r["slots"] for r in sizes)


def test_stages_take_odd_rows(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    for name, stage in corpus_pipeline.STAGES:
        for rows in (docs, docs.limit(0)):
            left = stored(stage(spark, rows, SF), name)
            assert name == "sharding" or left.columns == docs.columns
            assert left.count() <= 3 * rows.count()
