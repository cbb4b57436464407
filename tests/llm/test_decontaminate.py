import random
from collections import Counter

import pytest
from cases import document_frame, odd_texts

from accrualkit.llm import decontaminate as dc


def plain(docs, items, k=5, share=0.8):
    out = set()
    for item, text in items:
        words = dc.words_of(text)
        if not words:
            continue
        n = min(k, len(words))
        own = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}
        for doc, body in docs:
            w = dc.words_of(body)
            shared = len(own & {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
            if shared >= share * len(own) - 1e-9:
                out.add((doc, item, shared, len(own)))
    return out


def item_frame(spark, items):
    return spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")


def search(spark, docs, items, **more):
    found = dc.contained_items(document_frame(spark, docs, extra=True), item_frame(spark, items), **more).collect()
    assert all(r["containment"] == r["shared"] / r["shingles"] for r in found)
    rows = Counter(d for d, _ in docs)  # a repeated row is reported again
    assert all(n <= rows[d] for (d, _), n in Counter((r["id"], r["item_id"]) for r in found).items())
    return {(r["id"], r["item_id"], r["shared"], r["shingles"]) for r in found}


@pytest.mark.parametrize("block_words", [1_000_000, 60])
def test_against_all_pairs(spark, block_words):
    rng = random.Random(block_words)
    vocabulary = [f"w{i}" for i in range(40)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, make(rng.choice([1, 2, 4, 5, 6, 9, 20, 60]))) for i in range(30)]
    docs = []
    for d in range(80):
        words = make(rng.randint(0, 50))
        for _ in range(rng.randint(0, 2)):
            part = list(rng.choice(items)[1])
            for _ in range(rng.randint(0, 3)):  # edits, so that containment falls on both sides of the threshold
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            at = rng.randint(0, len(words))
            words[at:at] = part
        docs.append((d, " ".join(words)))
    items = [(i, " ".join(w)) for i, w in items]
    want = plain(docs, items)
    assert want and search(spark, docs, items, block_words=block_words) == want


def test_a_scattered_item_in_a_very_long_text(spark):
    rng = random.Random(1)
    item = [f"i{n}" for n in range(40)]
    filler = lambda n: [f"f{rng.randrange(999)}" for _ in range(n)]
    text = filler(40_000) + item[:22] + filler(30_000) + item[18:] + filler(50_000)
    docs = [(1, " ".join(text)), (2, " ".join(filler(100) + item[:20]))]
    assert {r[:2] for r in search(spark, docs, [(7, " ".join(item).upper())])} == {(1, 7)}


def test_odd_rows(spark):
    items = [(1, None), (2, ""), (3, "one two three four five six seven"), (3, "one two three four five six seven"), (4, "x"), (None, "repeated row here"), (6, "text without an id")]
    docs = [r[:2] for r in odd_texts()]
    assert search(spark, docs, items) == plain(docs, items)
    assert search(spark, [], items) == set() == search(spark, docs, [])


def test_rows_with_items_go(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    items = item_frame(spark, [(3, "one two three four five six seven"), (4, "repeated row here")])
    for blocks in (1_000_000, 4):
        left = dc.without_items(docs, items, block_words=blocks)
        assert left.columns == docs.columns
        assert sorted((str(r["doc_id"]) for r in left.collect())) == sorted(str(r[0]) for r in odd_texts() if r[0] not in (1, 7, 8))
    assert dc.without_items(docs, items.limit(0)).count() == docs.count()


def test_the_plan_does_not_grow_with_the_items(spark):
    docs = document_frame(spark, [(i, f"alpha beta gamma delta epsilon zeta {i}") for i in range(20)])
    items = item_frame(spark, [(i, f"alpha beta gamma delta epsilon zeta {i}") for i in range(20)])
    nodes = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("\n")
    sizes = [[nodes(f(docs, items, block_words=b)) for b in (30, 7)] for f in (dc.contained_items, dc.without_items)]
    assert all(few == many for few, many in sizes)
    assert dc.contained_items(docs, items, block_words=7).count() == 20 == docs.count() - dc.without_items(docs, items, block_words=7).count()
