import math
import random
import zlib

import numpy as np
import pytest
from cases import document_frame, odd_texts
from pyspark.sql import functions as F

from accrualkit.llm import quality, queries
from accrualkit.llm.common import labelled_texts


def labelled(spark, sf, query, label):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = query(spark, sf).join(labels, "doc_id").select("held_out", "score", "predicted", label).toPandas()
    return rows[rows.held_out]


def test_held_out_accuracy(spark):
    rows = labelled(spark, "/root/testdata/sf0.01", queries.op2_quality, "quality")
    assert (rows.predicted == rows.quality).mean() > 0.97
    assert rows.score.between(0, 1).all()


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(1)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.fit(x, y)
    assert model.pairs[0] == (0, 1)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95


def test_score_is_the_sum_of_its_tables():
    rng = np.random.default_rng(2)
    x, y = rng.random((500, 4)), (rng.random(500) < 0.4).astype(float)
    model = quality.fit(x, y)
    bins = model.bins(x)
    for i in (0, 17, 499):
        own = model.constant + sum(t[b[i]] for t, b in zip(model.tables, bins))
        own += sum(t[model.coarse[f][bins[f][i]], model.coarse[g][bins[g][i]]] for (f, g), t in zip(model.pairs, model.pair_tables))
        assert abs(own - model.logit(x)[i]) < 1e-9


def test_without_labels_or_with_one_kind(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert quality.train(docs, none, "quality", 4, 2).score(np.zeros((1, len(quality.FEATURES))))[0] == 0.5
    ones = spark.createDataFrame([(1, 1), (5, 1), (6, 1), (None, 1), (9, None), (9, 7), (7, 0), (7, 1)], "doc_id long, quality int")
    model = quality.train(docs, ones, "quality", 4, 2)
    assert model.score(np.zeros((1, len(quality.FEATURES))))[0] > 0.5


def test_odd_rows(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9, 10)], "doc_id long, quality int")
    score = quality.scorer(quality.train(docs, labels, "quality", 4, 2))
    rows = docs.select("text", score(F.col("text")).alias("s")).collect()
    assert len(rows) == len(odd_texts()) and all(0 <= r["s"] <= 1 for r in rows)
    by_text = {}
    for r in rows:
        by_text.setdefault(r["text"] or "", set()).add(r["s"])
    assert all(len(s) == 1 for s in by_text.values())
    assert docs.limit(0).select(score(F.col("text")).alias("s")).count() == 0
    assert all(len(quality.features(None if t is None else t.encode())) == len(quality.FEATURES) for _, t, *_ in odd_texts())


def test_training_rows_are_bounded_where_an_id_repeats(spark):
    rows = [(7, f"text {i % 900}") for i in range(3000)] + [(i, f"own {i}") for i in range(20, 40)]
    docs = document_frame(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i in [7, *range(20, 40)]], "doc_id long, quality int")
    held_out = next(h for h in range(4) if zlib.crc32(b"7") % 4 != h)
    sample = labelled_texts(docs, labels, "quality", 4, held_out, 100).collect()
    assert 50 < len(sample) < 200 and len({(r["id"], r["text"]) for r in sample}) == len(sample)


def plain_features(text):
    raw = (text or "").encode()
    words = raw.split()
    n, m = len(raw), len(words)
    if not m:
        return [math.log(1 + n)] + [0.0] * (len(quality.FEATURES) - 1)
    chars = list(raw)
    share = lambda group, of: sum(c in group for c in chars) / of
    upper, lower = sum(65 <= c <= 90 for c in chars), sum(97 <= c <= 122 for c in chars)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    triples = [tuple(words[i : i + 3]) for i in range(m - 2)]
    distinct = set(words)
    entropy = -sum(chars.count(c) / n * math.log2(chars.count(c) / n) for c in set(chars))
    return [
        math.log(1 + n), math.log(1 + m), (n - m) / m, upper / max(1, upper + lower), sum(48 <= c <= 57 for c in chars) / n,
        share(b".,;:?", m), share(b"!", m), share(b"$%&*#@^~=+<>{}[]\\/_", m), share(b"|", m), sum(c > 127 for c in chars) / n,
        len(distinct) / m, 1 - len(set(triples)) / len(triples) if triples else 0.0, 1 - len(set(lines)) / len(lines),
        math.log(1 + m / len(lines)), max(words.count(w) for w in distinct) / m, entropy,
        sum(len(w) < 4 for w in distinct) / len(distinct), sum(not chr(w[-1]).islower() or w[-1] > 127 for w in words) / m,
    ]


def test_features_against_plain_counting(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    for text in [*texts, None, "", " \n", "x", "A b! 1|2\nA b! 1|2\n\n", "é中 $5"]:
        got = quality.features(None if text is None else text.encode())
        assert got == pytest.approx(plain_features(text), abs=1e-9)


def test_cuts_against_every_cut():
    rng = np.random.default_rng(2)
    gain = lambda g, h: g * g / (h + 1)
    for _ in range(60):
        k = int(rng.integers(1, 14))
        g, h, n = rng.normal(size=k), rng.random(k), rng.integers(0, 9, k).astype(float)
        tried = {c: gain(g[:c].sum(), h[:c].sum()) + gain(g[c:].sum(), h[c:].sum()) - gain(g.sum(), h.sum()) for c in range(1, k) if n[:c].sum() >= quality.LEAF_ROWS <= n[c:].sum()}
        best, at = quality._best_cut(g, h, n)
        want = max([0.0, *tried.values()])
        assert best == pytest.approx(want) and (not at or tried[at] == pytest.approx(want))


def test_a_round_against_a_plain_tree():
    """One cyclic round of one feature: leaves are the best two levels of cuts, found by trying all."""
    rng = np.random.default_rng(4)
    gain = lambda g, h: g * g / (h + 1)
    for _ in range(20):
        k = 9
        g, h, n = rng.normal(size=k), rng.random(k), np.full(k, 6.0)

        def grown(low, high, depth, g=g, h=h):
            value = {i: g[low:high].sum() / (h[low:high].sum() + 1) for i in range(low, high)}
            base = gain(g[low:high].sum(), h[low:high].sum())
            options = [(gain(g[low:c].sum(), h[low:c].sum()) + gain(g[c:high].sum(), h[c:high].sum()) - base, c) for c in range(low + 1, high)] if depth else []
            if not options or max(options)[0] <= 0:
                return value if depth < 2 else dict.fromkeys(range(low, high), 0.0)
            cut = max(options, key=lambda o: (round(o[0], 12), -o[1]))[1]
            return grown(low, cut, depth - 1) | grown(cut, high, depth - 1)

        assert quality._tree(g, h, n) == pytest.approx([v for _, v in sorted(grown(0, k, 2).items())])


def test_scores_of_whole_texts_against_table_lookups(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["good words", "BAD $$$", "ok 12", "x!"]) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    y = np.array([float("BAD" not in t) for t in texts])
    x = np.array([quality.features(t.encode()) for t in texts])
    model = quality.fit(x, y)
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", quality.scorer(model)(F.col("text")).alias("s")).collect():
        value, own = model.constant, plain_features(r["text"])
        places = [sum(c <= own[f] + 1e-12 for c in cuts) for f, cuts in enumerate(model.cuts)]
        value += sum(table[p] for table, p in zip(model.tables, places, strict=True))
        value += sum(table[model.coarse[f][places[f]]][model.coarse[g][places[g]]] for (f, g), table in zip(model.pairs, model.pair_tables, strict=True))
        assert r["s"] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, value)))), abs=1e-9)
