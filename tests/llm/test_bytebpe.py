import hashlib
import random
import time

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from accrualkit.llm import bytebpe, queries

from cases import document_frame, odd_texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
NATIVE = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bytebpe.read_ranks(RANKS), special_tokens={})


def ids_of(packed):
    return [int.from_bytes(packed[i : i + 4], "little") for i in range(0, len(packed), 4)]


def encoded(text):
    return ids_of(bytebpe.own_encoder(RANKS, PATTERN).encode(text))


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=60), st.text(alphabet="abeinst '\n\t.,1\x1c　é中", max_size=80)))
def test_ids_equal_the_librarys(text):
    assert encoded(text) == NATIVE.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_any_bytes_merge_as_by_rank(piece):
    vocabulary = bytebpe.vocabulary(RANKS)
    assert vocabulary.piece(piece) == ([vocabulary.ranks[piece]] if piece in vocabulary.ranks else vocabulary.merged(piece))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "aa", "ab", "ba", "aab", "bb", "abab", "bba", "aaaa", "babb"]), unique=True), st.text("abc", max_size=24))
def test_vocabularies_that_no_training_made(tokens, text):
    # unreachable tokens and ranks in any order: merging by rank is the definition
    ranks = {bytes([b]): b for b in range(256)} | {t.encode(): 256 + i for i, t in enumerate(t for t in tokens if len(t) > 1)}
    vocabulary = bytebpe.Vocabulary(ranks)
    piece = text.encode()
    for left in ranks.values():
        for right in (97, 98, max(ranks.values())):
            if left > 255:
                whole = vocabulary.tokens[left] + vocabulary.tokens[right]
                assert vocabulary.fits(left, right) == (vocabulary.merged(whole) == [left, right])
    in_order = all(vocabulary._edge(t, 0) is not None for t in ranks.values())
    if piece and in_order:
        assert vocabulary.piece(piece) == ([ranks[piece]] if piece in ranks else vocabulary.merged(piece))


def test_long_pieces_take_linear_time():
    vocabulary, rng = bytebpe.vocabulary(RANKS), random.Random(3)
    for letters in ("a", "ab", "etaoinshr"):
        took = []
        for n in (20_000, 200_000):
            piece = "".join(rng.choice(letters) for _ in range(n)).encode()
            begin = time.process_time()
            ids = vocabulary.piece(piece)
            took.append(time.process_time() - begin)
            assert b"".join(vocabulary.tokens[i] for i in ids) == piece
        assert took[1] < 40 * max(took[0], 0.02)


def test_long_texts_are_taken_in_slices(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice(["alpha", " ", "  ", "\n", "beta,", "'s", "12", "\t x"]) for _ in range(5_000))
    monkeypatch.setattr(bytebpe, "SLICE", 64)
    monkeypatch.setattr(bytebpe, "REMEMBERED", 50)
    assert encoded(text) == NATIVE.encode_ordinary(text)


def test_odd_texts_and_clashing_columns(spark):
    rows = [*odd_texts(), (20, "<|endoftext|> is text"), (21, "\x00\x1c\x1d  \r\n x")]
    docs = document_frame(spark, rows, extra=True)
    ids = bytebpe.encoder(RANKS, PATTERN)(F.col("text"))
    out = docs.withColumn("ids", ids).withColumn("back", bytebpe.decoder(RANKS)(F.col("ids"))).withColumn("listed", bytebpe.id_lister()(F.col("ids"))).collect()
    assert len(out) == len(rows) and set(docs.columns) < set(out[0].__fields__)
    for r in out:
        text = r["text"] or ""
        assert bytes(r["back"]).decode() == text
        if len(text) < 10_000:
            assert r["listed"] == ids_of(bytes(r["ids"])) == NATIVE.encode_ordinary(text)


def test_both_ways_in_one_pass(spark):
    docs = document_frame(spark, odd_texts(), extra=True).withColumn("ids", F.lit("x"))
    out = bytebpe.coded(docs, F.col("text"), [F.col(c) for c in docs.columns], RANKS, PATTERN)
    assert out.columns == [*docs.columns[:-1], "input_ids", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(odd_texts()) and all(bytes(r["decoded"]).decode() == (r["text"] or "") and r["input_ids"] == "x" for r in rows)
    assert [bytes(r["ids"]) for r in rows] == [bytebpe.own_encoder(RANKS, PATTERN).encode(r["text"] or "") for r in rows]


def test_empty_table(spark):
    docs = document_frame(spark, [])
    assert bytebpe.coded(docs, F.col("text"), [F.col("doc_id")], RANKS, PATTERN).collect() == []
    assert docs.select(bytebpe.encoder(RANKS, PATTERN)(F.col("text")).alias("ids")).collect() == []


def test_null_ids_and_unknown_ids():
    tokens = bytebpe.vocabulary(RANKS).tokens
    assert bytebpe.decoded(b"", tokens) == b""
    with pytest.raises(ValueError):
        bytebpe.decoded((10**6).to_bytes(4, "little"), tokens)


def test_a_vocabulary_needs_every_byte():
    with pytest.raises(ValueError):
        bytebpe.Vocabulary({b"a": 0})


def test_query_against_the_library(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op11_bytebpe(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids, r = NATIVE.encode_ordinary(d["text"] or ""), got[d["doc_id"]]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((d["text"] or "").encode()).hexdigest()
