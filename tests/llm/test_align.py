import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accrualkit.llm import align, queries

from cases import CLASHING, document_frame, odd_texts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def models():
    a = tokenizers.Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def spelled(models, text):
    """Whole-text ids and bytes of both sides, or nothing."""
    a, b = models
    if not text:
        return []
    raw = " " + text
    left = a.encode(raw, add_special_tokens=False)
    right = [(i, p) for i in b.encode(text) for p in [b.id_to_piece(i)]]
    signs = align._byte_of_sign()
    left = [(i, bytes(signs[c] for c in a.id_to_token(i))) for i in left.ids]
    right = [(i, bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode()) for i, p in right]
    same = all(b"".join(x[1] for x in side) == raw.encode() for side in (left, right))
    return [left, right] if same else []


def ranges(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(models, texts):
    """The result of each text, link by link."""
    found, counts = [], Counter()
    for text in texts:
        both = spelled(models, text)
        left, right = [ranges(side) for side in both] if both else ([], [])
        links = [(x[0], y[0]) for x in left for y in right if x[1] < y[2] and y[1] < x[2]] if len(left) < 600 else _walk(left, right)
        common = sorted({x[2] for x in left} & {y[2] for y in right})
        sides = [[[] for _ in common] for _ in (left, right)]
        for side, out in zip((left, right), sides, strict=True):
            for t in side:
                out[bisect_left(common, t[2])].append(str(t[0]))
        groups = [",".join(x) + "|" + ",".join(y) for x, y in zip(*sides, strict=True)]
        counts.update(links)
        found.append((len(left), len(right), len(groups), links, ";".join(groups)))
    highest = defaultdict(int)
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links), text)
        for n_a, n_b, n_groups, links, text in found
    ]


def _walk(left, right):
    out, i, j = [], 0, 0
    while i < len(left) and j < len(right):
        out.append((left[i][0], right[j][0]))
        x, y = left[i][2], right[j][2]
        i, j = i + (x <= y), j + (y <= x)
    return out


def rows_of(df, digest=False, **options):
    out = align.align(df, F.col("text"), [F.col("doc_id"), F.col("text")], BYTES, PIECES, digest, **options)
    return [(r["doc_id"], r["text"], tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "grouping"))) for r in out.collect()]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(max_size=40), st.text(alphabet="ab. \n\t'1é　▁\x1c\x00中<>|", max_size=50)))
def test_stretches_give_the_ids_of_whole_texts(models, text):
    pair = align.own_pair(BYTES, PIECES)
    assert pair.cuts
    (want,) = plain(models, [text])
    stretches, (numbers,) = pair.batch([text])
    own = [stretches[i] for i in numbers]
    got = (sum(s.n_a for s in own), sum(s.n_b for s in own), sum(s.n_groups for s in own), sum(len(s.pairs) for s in own) // 8)
    assert (*got, ";".join(s.grouping for s in own)) == (*want[:4], want[6])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(61, 64))
def test_pointer_jumping_finds_the_components(a, b, end):
    a, b = sorted({*a, end}), sorted({*b, end})
    label = align.terminals(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    want = [a.index(next(c for c in common if c >= e)) for e in [*a, *b]]
    assert label.tolist() == want
    at_a, at_b, _ = align.links(np.array(a), np.array(b))
    overlap = {(i, j) for i in range(len(a)) for j in range(len(b)) if max((0, *a)[i], (0, *b)[j]) < min(a[i], b[j])}
    assert set(zip(at_a.tolist(), at_b.tolist(), strict=True)) == overlap and len(at_a) == len(overlap)


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40, 0])
def test_rows_equal_the_plain_alignment(spark, models, monkeypatch, frequent):
    rng = random.Random(8)
    words = "the of token Tokenizer, alignment. don't 12345 naïve 中文字 \U0001f600 é \n\n \t x▁y <unk> </s>".split(" ")
    texts = ["".join(rng.choice([" ", " ", " ", "  ", ""]) + rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(60)]
    rows = [*enumerate([*texts, *texts[:9], None, "", " ", "\n x", "<|endoftext|>", "▁", "a▁b"])]
    df = document_frame(spark, rows).repartition(3)
    want = plain(models, [t for _, t in rows])
    got = sorted(rows_of(df, frequent=frequent), key=lambda r: r[0])
    assert [(i, t, w) for (i, t), w in zip(rows, want, strict=True)] == got


def test_odd_documents_and_clashing_columns(spark, models):
    docs = document_frame(spark, odd_texts(), extra=True)
    out = align.align(docs, F.col("text"), [F.col(c) for c in docs.columns], BYTES, PIECES, digest=True)
    rows = out.collect()
    assert set(CLASHING) < set(out.columns) and len(rows) == docs.count()
    want = plain(models, [r["text"] for r in rows])
    for r, w in zip(rows, want, strict=True):
        text = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"], r["grouping"]) == (*w[:6], text)


def test_empty_table(spark):
    assert rows_of(document_frame(spark, [])) == []


def test_query_against_the_plain_alignment(spark, models):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {d["doc_id"]: w for d, w in zip(docs, plain(models, [d["text"] for d in docs]), strict=True)}
    got = queries.op12_align(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        w = want[r["doc_id"]]
        text = hashlib.sha256(w[6].encode()).hexdigest() if w[6] else ""
        assert tuple(r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) == (*w[:6], text)
