import random

import numpy as np
from cases import document_frame, odd_texts
from pyspark.sql import functions as F

from accrualkit.llm import langid, queries

SYLLABLES = {"aa": ["ka", "lo", "mi"], "bb": ["zu", "pre", "sti"], "ru": ["да", "не", "го"], "el": ["κα", "το", "μη"]}


def text_of(lang, n, rng):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def rows(rng, n=40):
    return [(i, text_of(lang, 50, rng), lang) for i, lang in enumerate(list(SYLLABLES) * n)]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = queries.op4_language(spark, sf).join(docs, "doc_id").filter("held_out").toPandas()
    assert (got.lang == got.lang_pred).mean() > 0.98 and got.score.between(0, 1).all()


def test_spans_of_mixed_text(spark):
    rng = random.Random(1)
    model = langid.train(document_frame(spark, rows(rng)))
    parts = [("aa", text_of("aa", 30, rng)), ("bb", text_of("bb", 40, rng)), ("ru", text_of("ru", 5, rng)), ("aa", text_of("aa", 20, rng))]
    text = ". ".join(t for _, t in parts)
    spans = langid.Labeller(model).spans(text)
    assert [s[0] for s in spans] == [p[0] for p in parts]
    assert [text[a:b] for _, a, b in spans] == [p[1] for p in parts]
    names, scores = langid.Labeller(model).predict([text, text_of("el", 9, rng)])
    assert names == ["bb", "el"] and scores[1] == 1.0 and 0.3 < scores[0] < 0.9


def test_scripts_narrow_the_candidates(spark):
    model = langid.train(document_frame(spark, rows(random.Random(2))))
    place = {n: i for i, n in enumerate(model.languages)}
    scores = model.scores(["дадада", "kalomi"])
    assert scores[0, place["ru"]] == 0 and scores[0, place["aa"]] == -langid.WORST
    assert scores[1, place["ru"]] == -langid.WORST


def test_a_rare_second_script_is_a_candidate(spark):
    rng = random.Random(7)
    mixed = [(1000 + i, text_of("aa", 99, rng) + " " + text_of("ru", 1, rng), "aa") for i in range(40)]
    model = langid.train(document_frame(spark, [r for r in rows(rng) if r[2] != "ru"] + mixed))
    assert langid.Labeller(model).predict([text_of("ru", 9, rng)])[0] == ["aa"]
    place = model.languages.index("aa")
    assert -langid.WORST <= model.scripts[place]["Cyrillic"] < 0 == model.scripts[place]["Latin"]


def test_runs_are_cut_where_the_script_changes(spark):
    assert langid.words_of("Alpha中文かな beta") == ["alpha", "中文", "かな", "beta"] and langid.words_of("naïve “quoted”") == ["naïve", "quoted"]
    rng = random.Random(8)
    model = langid.train(document_frame(spark, rows(rng)))
    assert langid.Labeller(model).spans("kalomikaloДадада") == [("aa", 0, 10), ("ru", 10, 16)]


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(3)
    lengths = np.array([6, 1, 0, 4, 6])
    scores = rng.normal(0, 3, (lengths.sum(), 3)).astype(np.float32)
    got, at = langid.viterbi(scores, lengths, 2.0), 0
    value = lambda path, s: sum(s[t, p] for t, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))
    for n in lengths:
        s, own = scores[at : at + n], got[at : at + n].tolist()
        paths = np.stack(np.meshgrid(*[range(3)] * n, indexing="ij"), -1).reshape(-1, n).tolist() if n else [[]]
        assert abs(value(own, s) - max(value(p, s) for p in paths)) < 1e-4
        at += n


def test_odd_rows(spark):
    docs = document_frame(spark, odd_texts(), extra=True)
    model = langid.train(document_frame(spark, rows(random.Random(4))))
    predict = langid.predictor(model)
    got = docs.select("text", predict(F.col("text")).alias("p")).select("text", "p.*").collect()
    assert len(got) == len(odd_texts())
    for r in got:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang"] == langid.UNKNOWN) == (not letters) and 0 <= r["score"] <= 1
    nothing = langid.train(docs.limit(0))
    assert langid.Labeller(nothing).predict(["some text"]) == ([langid.UNKNOWN], [0.0])
    assert langid.Labeller(nothing).spans("some text") == []


def test_long_texts_in_chunks(monkeypatch, spark):
    rng = random.Random(5)
    model = langid.train(document_frame(spark, rows(rng)))
    texts = [text_of("aa", 900, rng) + " " + text_of("bb", 300, rng), text_of("ru", 3, rng), text_of("bb", 700, rng)]
    whole = langid.Labeller(model).predict(texts)
    monkeypatch.setattr(langid, "CHUNK_WORDS", 256)
    assert langid.Labeller(model).predict(texts) == whole


def test_every_language_is_learned(spark):
    rng = random.Random(6)
    syllables = ["".join(p) for p in zip(*[iter(rng.choices("bcdfghjklmnpqrstvwxyz", k=630))] * 3)]
    own = {f"l{i:02d}": syllables[3 * i : 3 * i + 3] for i in range(70)}
    text = lambda lang: " ".join("".join(rng.choices(own[lang], k=2)) for _ in range(30))
    seen = [(lang, text(lang)) for lang in own for _ in range(4 if lang > "l03" else 2)]
    model = langid.train(document_frame(spark, [(i, t, lang) for i, (lang, t) in enumerate(seen)]))
    assert sorted(model.languages) == sorted(own)
    assert langid.Labeller(model).predict([text(lang) for lang in own])[0] == list(own)


def test_copies_count_once(spark, monkeypatch):
    rng = random.Random(7)
    names = "abcdefghijkl"
    seen = [(f"copy{'x' * i} {name}", name) for i, name in enumerate(names, 1) for _ in range(100)]
    seen += [(text_of("aa", 8, rng), name) for name in names for _ in range(100)]
    monkeypatch.setattr(langid, "learn", lambda counts, languages: counts)
    counts = langid.train(document_frame(spark, [(i, *r) for i, r in enumerate(seen)]), texts=50)
    copied = [n for _, word, n in counts if word.startswith("copy")]
    assert copied and max(copied) == 1


def test_whole_texts_against_plain_scoring(spark):
    """Scores word by word and the best of all paths by plain dynamic programming; letters of the best language."""
    rng = random.Random(11)
    model = langid.train(document_frame(spark, rows(rng)))
    texts = [" ".join(text_of(rng.choice(list(SYLLABLES)), rng.randint(1, 6), rng) for _ in range(rng.randint(1, 6))) for _ in range(30)]
    names, scores = langid.Labeller(model).predict(texts)
    k = len(model.languages)
    for text, name, score in zip(texts, names, scores, strict=True):
        words = langid.words_of(text)
        own = [[float(v) for v in model.scores([w])[0, :k]] for w in words]
        best = [(v, [j]) for j, v in enumerate(own[0])]
        for row in own[1:]:
            best = [max(((v - langid.SWITCH * (path[-1] != j) + row[j], [*path, j]) for v, path in best), key=lambda x: x[0]) for j in range(k)]
        path = max(best, key=lambda x: x[0])[1]
        letters = [sum(len(w) for w, j in zip(words, path, strict=True) if j == lang) for lang in range(k)]
        if sorted(letters)[-1] > sorted(letters)[-2]:
            assert name == model.languages[letters.index(max(letters))]
            assert abs(score - max(letters) / sum(letters)) < 1e-6
