import hashlib
import random

import numpy as np
import pytest
from cases import document_frame, odd_texts

from accrualkit.llm import substring


def plain(rows, length=substring.LENGTH):
    """n_bytes, n_removed, n_spans, kept for (doc_id, text) rows, window by window; a null id is the largest."""
    rank = lambda d: (d is None, d or 0)
    first, out = {}, []
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            w = raw[i : i + length]
            first[w] = min(first.get(w, rank(doc)), rank(doc))
    for doc, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < rank(doc):
                gone[i : i + length] = True
        kept = np.frombuffer(raw, np.uint8)[~gone[:-1]].tobytes()
        out.append((doc, len(raw), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **sizes):
    docs = document_frame(spark, rows, extra=True)
    return sorted((tuple(r) for r in substring.without_repeats(docs, **sizes).collect()), key=str)


def copies(rng, n):
    """Texts with shared passages, near copies and low variety."""
    words = ["the", "of", "and", "ab", "abab", "é", "lorem", "ipsum", "x"]
    some = [" ".join(rng.choice(words) for _ in range(rng.randint(5, 60))) for _ in range(12)]
    out = []
    for i in range(n):
        text = " ".join(rng.choice(some) for _ in range(rng.randint(0, 3)))
        if rng.random() < 0.5 and text:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice("qz") + text[at + 1 :]
        out.append((i * 3 % 101, text))
    return out


@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 800, "bucket_windows": 300}, {"bucket_bytes": 2000, "bucket_windows": 20}])
def test_against_single_windows(spark, sizes):
    rows = copies(random.Random(len(sizes) + 1), 60)
    assert found(spark, rows, **sizes) == plain(rows)


@pytest.mark.parametrize("sizes", [{}, {"bucket_bytes": 3000, "bucket_windows": 400}])
def test_a_passage_in_every_document(spark, sizes):
    rng = random.Random(9)
    passage = " ".join(str(rng.random()) for _ in range(12))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(80)]
    assert found(spark, rows, **sizes) == plain(rows)


def test_one_letter_texts_and_touching_spans(spark):
    a, b = "a" * 120, "".join(chr(97 + i % 26) for i in range(50))
    rows = [(1, a), (2, a + "b" + a), (3, b), (4, b + b + "tail"), (5, "a" * 49)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    rows = [r[:2] for r in odd_texts() if r[0] != 6] + [(20, "é" * 300), (None, "text without an id at all " * 4), (None, "text without an id at all " * 4), (21, "text without an id at all " * 4)]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_very_long_texts(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcdefgh ") for _ in range(substring._SLICE * 2 + 1000))
    rows = [(1, long), (2, "x" + long[1000:]), (3, long[-70:])]
    got = {r[0]: r[1:4] for r in found(spark, rows)}
    assert got[1] == (len(long), 0, 0)
    assert got[2] == (len(long) - 999, len(long) - 1000, 1)
    assert got[3] == (70, 70, 1)


def test_kept_bytes(spark):
    text = "".join(chr(97 + i % 26) for i in range(60))
    docs = document_frame(spark, [(1, text), (2, f"<{text}>")])
    kept = {r["doc"]: bytes(r["kept"]) for r in substring.without_repeats(docs, with_bytes=True).collect()}
    assert kept == {1: text.encode(), 2: b"<>"}


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    tokens = [rng.integers(0, 3, 60_000).astype(np.uint64), rng.integers(0, 50, 60_000).astype(np.uint64), rng.integers(-9, 9, 60_000)]
    order = substring.multikey_quicksort(tokens)
    assert sorted(order.tolist()) == list(range(60_000))
    want = np.lexsort(tokens[::-1])
    assert all((t[order] == t[want]).all() for t in tokens)


def test_every_window_has_its_anchor():
    rng = np.random.default_rng(2)
    texts = [rng.integers(97, 100, n).astype(np.uint8) for n in (10, 400, 49, 50, 51, 0, 1000)]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    text, begin, runs, _, _ = (np.concatenate(c) for c in zip(*substring.anchors(np.concatenate(texts), offsets)))
    for i, t in enumerate(texts):
        covered = [w for s, n in zip(begin[text == i], runs[text == i]) for w in range(s, s + n)]
        assert covered == list(range(max(0, len(t) - substring.LENGTH + 1)))


def test_copies_of_one_row_are_searched_once(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(300))
    for copies in (5, 500):
        rows = [(1, passage), *[(2, "head " + passage + " tail")] * copies]
        df = document_frame(spark, rows)
        plain = df.selectExpr("doc_id AS doc", "xxhash64(doc_id, text) AS uid", "text")
        assert substring.removed_spans(plain.distinct(), True).count() < 60
        out = substring.without_repeats(df).collect()
        assert len(out) == copies + 1 and {r["n_removed"] for r in out if r["doc"] == 2} == {300}
