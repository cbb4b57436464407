"""Alignment of two tokenizers' tokens by pointer jumping.

A text is encoded by a byte-level BPE (A) and by a piece model (B).  Tokens
are ranges of the same bytes.  Every token points to its farthest-right
overlapping token: the other side's token that holds its last byte, or itself
if nothing reaches further (an A token whose end is also the end of a B
token).  Doubling the pointers (``to = to[to]``) over all tokens at hand at
once ends, after about log2 of the longest chain, with every token pointing
to the terminal token of its component; that token labels the group.  Two
tokens overlap in one stretch between neighbouring ends of either side, so the
links of a text are as many as its distinct ends.

Texts are cut before a space that follows no white space: no piece of either
model reaches over such a cut (checked when the models are read; where a piece
would, whole texts are taken), so no group does either.  The stretches that a
batch of texts has and that are not remembered yet are encoded and aligned
together; those of usual length are remembered in a bounded table.  A stretch
that the models do not spell alike sends its text through as a whole.

A batch of texts is stored as one row: its distinct stretches with their
pairs of ids, and each text as numbers of stretches.  Counts of id pairs over
the corpus are added up by Spark: a task adds its links up first.  To weigh the
links of a text by them, the ``FREQUENT`` most frequent pairs (a fixed number
of entries) go to every task; links of other pairs leave as rows, meet the
counts in a join and are added to their text.

Defined cases: texts that are null or empty, or that the two models do not
spell alike, have no tokens and so zeros and an empty grouping; repeated rows
are aligned one by one and each counts; a very long text makes a batch by
itself, so a task holds one such text with its tokens; an empty table gives an
empty result; kept columns may have any names.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain, compress
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.bytebpe import WHITE
from accrualkit.llm.common import stored

#: From white space to before the next space that follows none; white space at the end of a text stays with the last.
#: Where a text has neither white space before a space nor at its end, these are its parts between spaces.
STRETCH = re.compile(rf"[{WHITE}]*[^{WHITE}]+(?:(?! )[{WHITE}]+[^{WHITE}]+)*(?:[{WHITE}]+\Z)?|[{WHITE}]+")
UNEVEN = re.compile(rf"[{WHITE}] |[{WHITE}]\Z")
#: Stretches of up to so many characters are remembered, and so many of them; so many are learned at a time.
SHORT = 48
REMEMBERED = 300_000
LEARNED = 8192
#: Characters of a batch of texts, about, and batches of a stored file (readers hold a file's rows at once).
CHARACTERS = 1 << 21
FILE_ROWS = 8
#: Pairs whose counts go to every task, at most; steps of a factor of two by which they are chosen.
FREQUENT = 1 << 20
STEPS = 16
#: Characters below which the two libraries are compared on how they cut texts.
AGREEMENT = 0x800
SPACE = "▁"


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as its Latin-1 sign if that is visible, else as the next one from 256."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligned(NamedTuple):
    """A stretch: tokens of either side, groups, their text, and the pair of ids of each link (packed)."""

    n_a: int
    n_b: int
    n_groups: int
    grouping: str
    pairs: bytes


NOTHING = Aligned(0, 0, 0, "", b"")


class Pair:
    """Both models, the bytes of their tokens, and the stretches remembered."""

    def __init__(self, byte_path: str, piece_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = tokenizers.Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        signs = _byte_of_sign()
        with open(byte_path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary = model["vocab"]
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.a_bytes += [b""] * (self.a.get_vocab_size() - len(self.a_bytes))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)
        ]
        plain = [p for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i))]
        whole = self.b.encode(" a  b\n c", out_type=str)
        self.cuts = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain) and "".join(whole).startswith(f"{SPACE}{SPACE}a{SPACE}{SPACE}b")
        self.limit, self.plain = self._by_rank(vocabulary, model.get("merges") or [])
        ids = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = np.array([[i + sign for i in ids] for sign in ",|;"], object)
        self.lengths = [np.array(list(map(len, side)), np.int64) for side in (self.a_bytes, self.b_bytes)]
        self.known: dict[str, Aligned] = {}

    def _by_rank(self, vocabulary: dict[str, int], merges: list) -> tuple[str, tiktoken.Encoding | None]:
        """A character, and a faster encoder of the same ids for texts below it; none unless ids ascend with the merges."""
        made = [vocabulary.get("".join(m if isinstance(m, list) else m.split(" "))) for m in merges]
        pieces = regex.compile(public_tokenizers.PATTERN).findall

        def alike(c: str) -> bool:
            text = f"a{c}1 {c}!{c}"
            return [text[i:j] for _, (i, j) in self.a.pre_tokenizer.pre_tokenize_str(text)] == pieces(text)

        limit = next((i for i in range(AGREEMENT) if not alike(chr(i))), AGREEMENT)
        single = {i for c, i in vocabulary.items() if len(c) == 1}
        ranks = {self.a_bytes[i]: i for i in [*single, *made] if i is not None}
        if None in made or made != sorted(made) or len(ranks) != len(made) + len(single) or any(bytes([b]) not in ranks for b in range(256)):
            return "", None
        return chr(limit), tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _a_ids(self, stretches: list[str]) -> list[list[int]]:
        if self.plain is None:
            return [e.ids for e in self.a.encode_batch([" " + s for s in stretches], add_special_tokens=False)]
        encode, limit = self.plain.encode_ordinary, self.limit
        low = [not s or max(s) < limit for s in stretches]
        rest = iter(self.a.encode_batch([" " + s for s, ok in zip(stretches, low, strict=True) if not ok], add_special_tokens=False))
        return [encode(" " + s) if ok else next(rest).ids for s, ok in zip(stretches, low, strict=True)]

    def learn(self, stretches: list[str]) -> list[Aligned | None]:
        """Each stretch (without the space before it) aligned; None if the models do not spell it alike."""
        out: list[Aligned | None] = []
        for low in range(0, len(stretches), LEARNED):
            part = stretches[low : low + LEARNED]
            a, b = self._a_ids(part), self.b.encode(part, num_threads=1)
            get_a, get_b = self.a_bytes.__getitem__, self.b_bytes.__getitem__
            alike = [b"".join(map(get_a, x)) == (raw := b" " + s.encode()) and b"".join(map(get_b, y)) == raw for s, x, y in zip(part, a, b, strict=True)]
            sides = [list(compress(side, alike)) for side in (a, b)]
            found = aligned(*sides, *self.lengths, self.names)
            out += [next(found) if ok else None for ok in alike]
        return out

    def _cut(self, text: str) -> list[str]:
        """The stretches of a text, each without the space before it."""
        if not self.cuts:
            return [text]
        if text[0] != " " and not UNEVEN.search(text):
            return text.split(" ")
        return [s[1:] for s in STRETCH.findall(" " + text)]

    def batch(self, texts: list[str | None]) -> tuple[list[Aligned], list[list[int]]]:
        """The distinct stretches of the texts, aligned, and each text as their numbers (none if it has no tokens)."""
        cut = [self._cut(t) if t else [] for t in texts]
        needed, known = dict.fromkeys(chain.from_iterable(cut)), self.known
        missing = [s for s in needed if s not in known]
        if missing:
            if len(known) + len(missing) > REMEMBERED:
                known.clear()
                missing = list(needed)
            known.update(zip(missing, self.learn(missing), strict=True))
        stretches = [known[s] for s in needed]
        number = dict(zip(needed, range(len(needed)), strict=True))
        out = [list(map(number.__getitem__, own)) for own in cut]
        odd = {i for i, s in enumerate(stretches) if s is None}
        if odd:
            for i, own in enumerate(out):
                if not odd.isdisjoint(own):
                    (whole,) = self.learn([texts[i]])
                    out[i] = [] if whole is None else [len(stretches)]
                    stretches += [] if whole is None else [whole]
        for s in missing:
            if len(s) > SHORT:
                del known[s]
        return [s or NOTHING for s in stretches], out


@functools.lru_cache(maxsize=1)
def own_pair(byte_path: str, piece_path: str) -> Pair:
    """The models, read once a worker."""
    return Pair(byte_path, piece_path)


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """For each A token, then each B token, the terminal (an A token) of its component, by pointer jumping."""
    n = len(a_ends)
    last_b = np.searchsorted(b_ends, a_ends)  # the B token with the A token's last byte
    reaches = b_ends[last_b] > a_ends
    to = np.concatenate([np.where(reaches, last_b + n, np.arange(n)), np.searchsorted(a_ends, b_ends)])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def links(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A token, B token and end of each overlap, left to right."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


def _grouping(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, names: np.ndarray) -> list[str]:
    """The tokens of all groups as text: ids of a side parted by ``,``, sides by ``|``, groups by ``;`` (each with what follows)."""
    # sides of a group follow one another, groups too; within, the order of the tokens
    a_at = np.arange(len(a)) + np.searchsorted(b_group, a_group)
    b_at = np.arange(len(b)) + np.searchsorted(a_group, b_group, side="right")
    out = np.empty(len(a) + len(b), object)
    for ids, group, at, ending in ((a, a_group, a_at, 1), (b, b_group, b_at, 2)):
        last = np.ones(len(ids), bool)
        last[:-1] = group[1:] != group[:-1]
        out[at] = names[np.where(last, ending, 0), ids]
    return out.tolist()


def aligned(a: list[list[int]], b: list[list[int]], a_lengths: np.ndarray, b_lengths: np.ndarray, names: np.ndarray) -> Iterator[Aligned]:
    """Texts that both sides spell alike, given as ids, aligned all at once (neighbours share an end, so no group spans two)."""
    a_ids, b_ids = (np.fromiter(chain.from_iterable(side), np.int64) for side in (a, b))
    a_row, b_row = (np.concatenate([[0], np.cumsum([len(x) for x in side], dtype=np.int64)]) for side in (a, b))
    a_ends, b_ends = np.cumsum(a_lengths[a_ids]), np.cumsum(b_lengths[b_ids])
    label = terminals(a_ends, b_ends)
    a_group, b_group = label[: len(a_ids)], label[len(a_ids) :]
    spelled = _grouping(a_ids, b_ids, a_group, b_group, names)
    at_a, at_b, ends = links(a_ends, b_ends)
    pairs = (a_ids[at_a] << 32 | b_ids[at_b]).astype("<i8").tobytes()
    link_row = np.searchsorted(ends, np.concatenate([[0], a_ends])[a_row], side="right").tolist()
    group_row = np.concatenate([[0], np.cumsum(a_group == np.arange(len(a_ids)))])[a_row].tolist()
    a_row, b_row = a_row.tolist(), b_row.tolist()
    for i in range(len(a)):
        text = "".join(spelled[a_row[i] + b_row[i] : a_row[i + 1] + b_row[i + 1]])[:-1]
        yield Aligned(
            a_row[i + 1] - a_row[i], b_row[i + 1] - b_row[i], group_row[i + 1] - group_row[i], text, pairs[8 * link_row[i] : 8 * link_row[i + 1]]
        )


def _packed(pair: Pair, texts: list[str | None], kept: pa.Array, digest: bool) -> pa.RecordBatch:
    """A batch of texts as one row."""
    stretches, numbers = pair.batch(texts)
    spelled = [s.grouping for s in stretches]
    grouping = [";".join(map(spelled.__getitem__, own)) for own in numbers]
    if digest:
        grouping = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in grouping]
    flat = np.fromiter(chain.from_iterable(numbers), np.int64)
    sizes = np.array([len(own) for own in numbers], np.int64)
    each = np.array([(s.n_a, s.n_b, s.n_groups, len(s.pairs) // 8) for s in stretches], np.int64).reshape(-1, 4)
    totals = sums(each[flat], sizes)
    columns = {
        "kept": pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
        "grouping": pa.array([grouping], pa.list_(pa.string())),
        "totals": pa.array([totals.astype("<i8").tobytes()], pa.binary()),
        "sizes": pa.array([sizes.astype("<u4").tobytes()], pa.binary()),
        "numbers": pa.array([flat.astype("<u4").tobytes()], pa.binary()),
        "links": pa.array([each[:, 3].astype("<u4").tobytes()], pa.binary()),
        "pairs": pa.array([b"".join([s.pairs for s in stretches])], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


_PACKED = "grouping array<string>, totals binary, sizes binary, numbers binary, links binary, pairs binary"


def sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of successive runs of ``sizes`` values."""
    running = np.concatenate([np.zeros((1, *values.shape[1:]), np.int64), np.cumsum(values, axis=0)])
    ends = np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def _packer(byte_path: str, piece_path: str, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = own_pair(byte_path, piece_path)

        def one(texts: list[str | None], kept: pa.Array) -> pa.RecordBatch:
            gc.disable()  # very many small tuples and no cycles: passes over them find nothing
            try:
                return _packed(pair, texts, kept, digest)
            finally:
                gc.enable()

        for batch in batches:
            texts, held, low = [], 0, 0
            for text in batch.column(0):
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= CHARACTERS:
                    yield one(texts, batch.column(1).slice(low, len(texts)))
                    texts, held, low = [], 0, low + len(texts)
            if texts:
                yield one(texts, batch.column(1).slice(low))
        pair.known.clear()  # the worker goes on to other stages

    return run


def _numbers(batch: pa.RecordBatch, row: int, *names: str) -> list[np.ndarray]:
    kinds = {"totals": "<i8", "pairs": "<i8"}
    return [np.frombuffer(batch.column(n)[row].as_py(), kinds.get(n, "<u4")).astype(np.int64) for n in names]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            numbers, size, pairs = _numbers(batch, row, "numbers", "links", "pairs")
            times = np.repeat(np.bincount(numbers, minlength=len(size)), size)
            pair, own = np.unique(pairs, return_inverse=True)
            n = np.bincount(own, times, len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair[n > 0]), pa.array(n[n > 0])], names=["pair", "n"])


_WEIGHED = "chunk long, place long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, grouping string, rest array<long>, rest_n array<long>"


def _weigher(frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield _weighed(batch, row, *frequent.value)

    return run


def _weighed(batch: pa.RecordBatch, row: int, known: np.ndarray, counts: np.ndarray, best: np.ndarray) -> pa.RecordBatch:
    """The texts of one stored row, a row each, weighed by the counts at hand; other pairs are listed."""
    totals, sizes, numbers, size, pairs = _numbers(batch, row, "totals", "sizes", "numbers", "links", "pairs")
    totals = totals.reshape(-1, 4)
    at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
    hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
    worth = np.stack([hit & best[at], np.where(hit, counts[at], 0)], axis=1) if len(known) else np.zeros((len(pairs), 2), np.int64)
    per_text = sums(sums(worth.astype(np.int64), size)[numbers], sizes)
    rest: list[list[int]] = [[]] * len(sizes)
    rest_n: list[list[int]] = [[]] * len(sizes)
    if not hit.all():
        missed, first = ~hit, np.cumsum(size) - size
        lacking = sums(missed.astype(np.int64), size) > 0
        text = np.repeat(np.arange(len(sizes)), sizes)
        for i in np.unique(text[lacking[numbers]]).tolist():
            own = numbers[np.searchsorted(text, i) : np.searchsorted(text, i, side="right")]
            own = own[lacking[own]]
            found = np.concatenate([pairs[first[j] : first[j] + size[j]][missed[first[j] : first[j] + size[j]]] for j in own.tolist()])
            pair, n = np.unique(found, return_counts=True)
            rest[i], rest_n[i] = pair.tolist(), n.tolist()
    n = len(sizes)
    kept, grouping = batch.column("kept")[row].values, batch.column("grouping")[row].values
    chunk = pa.array([batch.column("chunk")[row].as_py()] * n, pa.int64())
    numbers_of = [pa.array(c) for c in (*totals.T, *per_text.T)]
    lists = [pa.array(x, pa.list_(pa.int64())) for x in (rest, rest_n)]
    names = ["kept", "chunk", "place", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "grouping", "rest", "rest_n"]
    return pa.RecordBatch.from_arrays([kept, chunk, pa.array(np.arange(n)), *numbers_of, grouping, *lists], names=names)


def packed(df: DataFrame, text: Column, keep: Sequence[Column], byte_path: str, piece_path: str, digest: bool = False) -> DataFrame:
    """Batches of texts, a row each: ``keep`` of the texts, their groupings and totals, and the links of their stretches; stored."""
    payload = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(keep)]) if keep else F.lit(None).cast("boolean")
    plain = df.select(text.cast("string").alias("text"), payload.alias("kept"))
    kept = f"array<{plain.schema['kept'].dataType.simpleString()}>"
    return stored(plain.mapInArrow(_packer(byte_path, piece_path, digest), f"kept {kept}, {_PACKED}"), "aligned", compression="zstd", maxRecordsPerFile=str(FILE_ROWS))


def pair_counts(batches: DataFrame) -> DataFrame:
    """pair (A id in the high 32 bits, B id in the low ones), n, and whether no pair of its B id has a higher n; stored."""
    partial = batches.select("numbers", "links", "pairs").mapInArrow(_count, "pair long, n long")
    counts = stored(partial.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b")
    highest = counts.groupBy(b).agg(F.max("n").alias("highest"))
    return stored(counts.select("*", b).join(highest, "b").select("pair", "n", (F.col("n") == F.col("highest")).alias("best")), "counts")


def align(
    df: DataFrame, text: Column, keep: Sequence[Column], byte_path: str, piece_path: str, digest: bool = False, frequent: int = FREQUENT,
) -> DataFrame:
    """``keep`` of each row with n_a, n_b, n_groups, n_links, n_best, count_sum and grouping.

    ``grouping`` is the text ``a1,a2|b1;a3|b2,b3`` of the groups, or its
    sha256 with ``digest`` (empty for a row without tokens).
    """
    spark = df.sparkSession
    names = df.select(*keep).columns if keep else []
    batches = packed(df, text, keep, byte_path, piece_path, digest)
    counts = pair_counts(batches)
    # at most ``frequent`` entries of 17 bytes: the pairs from the lowest step on that leaves no more
    step = F.floor(F.log2("n") * STEPS)
    sizes = sorted(counts.groupBy(step.alias("step")).count().collect(), reverse=True)
    total = np.cumsum([r["count"] for r in sizes])
    steps = [r["step"] for r, n in zip(sizes, total, strict=True) if n <= frequent]
    common = counts.filter(step >= (steps[-1] if steps else 1 << 20)).toArrow()
    columns = [common.column(c).to_numpy() for c in ("pair", "n", "best")]
    order = np.argsort(columns[0])
    listed = spark.sparkContext.broadcast(tuple(c[order] for c in columns))
    kept = batches.schema["kept"].dataType.elementType.simpleString()
    rows = batches.withColumn("chunk", F.monotonically_increasing_id())
    weighed = stored(rows.mapInArrow(_weigher(listed), f"kept {kept}, {_WEIGHED}"), "weighed")
    each = weighed.select("chunk", "place", F.explode(F.arrays_zip("rest", "rest_n")).alias("r"))
    rest = each.select("chunk", "place", F.col("r.rest").alias("pair"), F.col("r.rest_n").alias("times"))
    met = rest.join(counts, "pair").groupBy("chunk", "place").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum")
    )
    both = weighed.join(met, ["chunk", "place"], "left")
    add = lambda c, more: (F.col(c) + F.coalesce(more, F.lit(0))).alias(c)
    own = [F.col(f"kept.c{i}").alias(c) for i, c in enumerate(names)]
    return both.select(*own, "n_a", "n_b", "n_groups", "n_links", add("n_best", "more_best"), add("count_sum", "more_sum"), "grouping")
