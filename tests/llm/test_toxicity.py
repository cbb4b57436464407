import math

import numpy as np
import pytest
from cases import document_frame, odd_texts
from pyspark.sql import functions as F
from test_quality import labelled

from accrualkit.llm import queries, toxicity


def test_held_out_accuracy(spark):
    rows = labelled(spark, "/root/testdata/sf0.1", queries.op7_toxicity, "toxic")
    assert (rows.predicted == rows.toxic).mean() > 0.97
    assert rows.predicted[rows.toxic == 1].mean() > 0.85


def test_gradients_match_differences():
    rng = np.random.default_rng(1)
    net = toxicity.Network({"aa": 1, "bb": 2}, rng)
    net.p = {k: v.astype(np.float64) + rng.normal(0, 0.2, v.shape) for k, v in net.p.items()}
    words = ["aa", "bb", "other"]
    grams = toxicity.char_grams(words)
    ids = rng.integers(0, 3, (4, 7))
    mask = np.arange(7) < np.array([7, 5, 1, 3])[:, None]
    y, weight = np.array([1.0, 0, 1, 0]), np.array([2.0, 1, 1, 1])

    def loss():
        z = net.forward(net.project(net.inputs(words, grams)), ids, mask)
        return float((weight * (np.logaddexp(0, z) - y * z)).sum() / len(y))

    grads = net.gradients(words, grams, ids, mask, y, weight)
    for name, g in grads.items():
        flat = net.p[name].reshape(-1)
        for i in np.argsort(-np.abs(g).ravel())[:4]:
            before = flat[i]
            flat[i] = before + 1e-2
            up = loss()
            flat[i] = before - 1e-2
            down = loss()
            flat[i] = before
            assert (up - down) / 2e-2 == pytest.approx(g.ravel()[i], abs=2e-3), name


@pytest.mark.parametrize("n", [1, 15, 16, 31, 32, 33, 48, 49, 500])
def test_windows_overlap_and_cover(n):
    starts = toxicity.window_starts(n)
    covered = set().union(*(range(s, min(n, s + toxicity.WINDOW)) for s in starts))
    assert covered == set(range(n)) and set(np.diff(starts)) <= {toxicity.STRIDE}


def trained():
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(60)]
    texts, y = [], []
    for i in range(240):
        t = list(rng.choice(words, rng.integers(5, 120)))
        if i % 3 == 0:
            t[rng.integers(len(t))] = rng.choice(["nastyone", "nastytwo"])
        texts.append(t)
        y.append(i % 3 == 0)
    return toxicity.fit(texts, np.array(y, float))


def test_one_word_in_a_long_text_and_unseen_forms():
    net = trained()
    clean = " ".join(f"w{i % 60}" for i in range(3000))
    words = clean.split()
    words[2990] = "nastyone"
    s = toxicity.Scorer(net).scores([clean, " ".join(words), "w1 w2 nastytwo w3", "w1 w2 nastything w3", "", None])
    assert s[0] < 0.5 < s[1] and s[2] > 0.5 and s[3] > s[0] and s[4] == s[5] < 0.5


def test_long_texts_in_chunks_score_alike(monkeypatch):
    net = trained()
    text = " ".join(f"w{i * 7 % 60}" for i in range(5000)) + " nastyone end"
    whole = toxicity.Scorer(net).worst([text, "w1", text])
    monkeypatch.setattr(toxicity, "CHUNK_WORDS", 256)
    assert toxicity.Scorer(net).worst([text, "w1", text]) == pytest.approx(whole, abs=1e-4)


def test_odd_rows(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    net = trained()
    left = toxicity.without_toxic(docs, net)
    assert left.columns == docs.columns
    assert toxicity.without_toxic(docs.limit(0), net).count() == 0
    score = toxicity.scorer(net)
    assert all(0 <= r[0] <= 1 for r in docs.select(score(F.col("text"))).collect())


def test_without_labels(spark):
    docs = document_frame(spark, odd_texts())
    net = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic", 5, 0)
    assert toxicity.without_toxic(docs, net).count() == len(odd_texts())


def test_training_reads_every_window_of_long_texts(spark):
    rng = np.random.default_rng(8)
    words = [f"w{i}" for i in range(60)]
    texts = [list(rng.choice(words, 6000)) for _ in range(60)]
    # 256 evenly spread fragments of 16 words would miss these places
    spread = set((np.arange(256) * 375 // 256).tolist())
    places = [f for f in range(375) if f not in spread]
    for t in texts[::2]:
        t[16 * rng.choice(places) + rng.integers(16)] = "nastyone"
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(60)], "doc_id long, toxic int")
    net = toxicity.train(docs, labels, "toxic", 1, 1)
    clean = " ".join(words * 20)
    s = toxicity.Scorer(net).scores([clean, clean + " nastyone " + clean])
    assert s[0] < 0.5 < s[1]
    x = toxicity.Scorer(net).worst(" ".join(t) for t in texts)
    assert (x[::2].min() > x[1::2].max()) and ((net.scale * x + net.shift > 0) == (np.arange(60) % 2 == 0)).all()


def plain_window(net, words):
    """Log-odds of one window, unit by unit."""
    p, size = net.p, toxicity.HIDDEN
    sigmoid = lambda v: 1 / (1 + math.exp(-v))
    bucket, owner = toxicity.char_grams(words)
    inputs = []
    for i, w in enumerate(words):
        own = [p["grams"][b].astype(float) for b, o in zip(bucket, owner, strict=True) if o == i]
        inputs.append([*map(float, p["words"][net.vocabulary.get(w, 0)]), *(sum(own) / max(1, len(own)) if own else np.zeros(toxicity.CHAR_DIM))])

    def states(side, xs):
        h, out = [0.0] * size, []
        for x in xs:
            gx = [sum(a * b for a, b in zip(x, p[f"w{side}"][:, k].tolist(), strict=True)) + float(p[f"c{side}"][k]) for k in range(3 * size)]
            gh = [sum(a * b for a, b in zip(h, p[f"u{side}"][:, k].tolist(), strict=True)) for k in range(3 * size)]
            z = [sigmoid(gx[k] + gh[k]) for k in range(size)]
            r = [sigmoid(gx[size + k] + gh[size + k]) for k in range(size)]
            n = [math.tanh(gx[2 * size + k] + r[k] * gh[2 * size + k]) for k in range(size)]
            h = [(1 - z[k]) * n[k] + z[k] * h[k] for k in range(size)]
            out.append(h)
        return out

    both = [f + b for f, b in zip(states("f", inputs), states("b", inputs[::-1])[::-1], strict=True)]
    look = [sum(math.tanh(sum(s[j] * float(p["a"][j, k]) for j in range(2 * size))) * float(p["v"][k]) for k in range(toxicity.ATTENTION)) for s in both]
    weight = [math.exp(v - max(look)) for v in look]
    pooled = [sum(w * s[j] for w, s in zip(weight, both, strict=True)) / sum(weight) for j in range(2 * size)]
    return sum(a * float(b) for a, b in zip(pooled, p["o"], strict=True)) + float(p["bias"][0])


def test_whole_texts_against_a_plain_recurrent_pass():
    rng = np.random.default_rng(6)
    names = [f"w{i}" for i in range(30)]
    net = toxicity.Network({w: i + 1 for i, w in enumerate(names[:20])}, rng)
    net.p = {k: (v * 3).astype(np.float32) for k, v in net.p.items()}
    texts = [" ".join(rng.choice(names, n)) for n in (1, 3, toxicity.WINDOW, toxicity.WINDOW + 1, 2 * toxicity.WINDOW + 5)]
    got = toxicity.Scorer(net).worst(iter(texts))
    for text, value in zip(texts, got, strict=True):
        words = text.split()
        starts = toxicity.window_starts(len(words)).tolist()
        assert {i for s in starts for i in range(s, min(len(words), s + toxicity.WINDOW))} == set(range(len(words)))
        assert value == pytest.approx(max(plain_window(net, words[s : s + toxicity.WINDOW]) for s in starts), abs=2e-3)
