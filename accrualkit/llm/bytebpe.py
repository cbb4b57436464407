"""Byte-level BPE encoding and decoding by backtracking over longest matches.

The vocabulary (a rank file: base64 of a token's bytes, and its rank) becomes
an Aho-Corasick automaton over the bytes read as Latin-1.  One pass over a
piece gives the longest token that starts at each byte.  The encoder then
walks from the left: it takes the longest token that is compatible with the
one before it, and steps back to a shorter token, or to the token before, when
nothing fits.  Two adjacent tokens are compatible if merging their bytes by
rank gives back these two; that is remembered for each pair.  A row of
reachable tokens whose neighbours are all compatible is the row that merging
by rank ends with, and a byte from which no row reaches the end is marked, so
it is tried once: the time is linear in the piece, however long it is.

Texts are cut into pieces by the pattern of the vocabulary, each piece is
encoded by itself, and a piece that is a token is that token.  Pieces do not
span a step from a letter or sign to white space, or from a letter or digit to
a sign, so texts are first cut there, and the ids of a short stretch are
remembered in a bounded table; long stretches are encoded anew.  The pattern
is one that takes a space and letters as a piece, as those of byte-level
vocabularies do.

``encoder`` and ``decoder`` are column functions, ``coded`` does both in one
pass and keeps the other columns; ids travel as a binary of
little-endian unsigned 32-bit numbers (``id_lister`` makes an array of them).

Defined cases: a null text counts as empty and has no ids; an empty text has
none; very long texts are taken in slices, so a task holds the text, its ids
and a bounded table; repeated rows are encoded one by one to equal ids; an
empty table gives an empty result; the functions take and return columns, so
other columns of the table, whatever their names, are not touched.  A text is
encoded as text throughout: strings of special tokens are ordinary.  Ids
outside the vocabulary cannot be decoded and raise ValueError.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator, Sequence
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.common import set_apart

#: White space of Unicode, as the patterns of byte-level vocabularies understand it.
WHITE = "\t-\r \x85\xa0  -     　"
#: White space and the letters or digits after it if a sign follows them, else all up to the next white space.
STRETCH = re.compile(rf"[{WHITE}]*[^\W_]+(?=[!-/:-@\[-`{{-~])|[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Stretches of up to so many characters are remembered, and so many of them.
SHORT = 48
REMEMBERED = 250_000
PAIRS = 300_000
#: Bytes of ids that leave a task at a time, about.
PART_BYTES = 1 << 23
#: Stretches that are joined at a time.
SLICE = 1 << 16


class Vocabulary:
    """Tokens by rank, their automaton, and which of them may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary holds every single byte")
        self.ranks = ranks
        self.count = max(ranks.values()) + 1
        self.tokens: list[bytes | None] = [None] * self.count
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = [ranks[bytes([b])] for b in range(256)]
        self.reach = [len(token or b"") - 1 for token in self.tokens]
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            if len(token) > 1:
                self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.packed = [rank.to_bytes(4, "little") for rank in range(self.count)]
        self.shorter = [self._prefix(token) for token in self.tokens]
        self._pairs: dict[int, bool] = {}
        self._edges: dict[int, list[int] | None] = {}

    def _prefix(self, token: bytes | None) -> int:
        """The longest token that ``token`` begins with, itself not counted; -1 if there is none."""
        for end in range(len(token or b"") - 1, 0, -1):
            if (rank := self.ranks.get(token[:end])) is not None:
                return rank
        return -1

    def merged(self, piece: bytes, parts_left: int = 1) -> list[int]:
        """``piece`` merged by rank, lowest and then leftmost first, until ``parts_left`` parts are left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > parts_left:
            best, at = self.count, -1
            for i in range(len(parts) - 1):
                rank = self.ranks.get(parts[i] + parts[i + 1], self.count)
                if rank < best:
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> list[int]:
        """The two tokens that merge into ``token`` last; more, or one, if merging never makes it that way."""
        return self.merged(self.tokens[token], 2)

    def _edge(self, token: int, side: int) -> list[int] | None:
        """The tokens that end (side 1) or begin (side 0) ``token`` while it grows, the byte first.

        None if merging does not make it, or not in the order of ranks.
        """
        if (key := token * 2 + side) not in self._edges:
            grown: list[int] | None = [token]
            while grown and self.reach[grown[-1]]:
                halves = self._halves(grown[-1])
                ordered = len(halves) == 2 and all(not self.reach[h] or h < grown[-1] for h in halves)
                grown = [*grown, halves[side]] if ordered else None
            self._edges[key] = grown and grown[::-1]
        return self._edges[key]

    def fits(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives back these two."""
        key = left * self.count + right
        if (known := self._pairs.get(key)) is None:
            if len(self._pairs) >= PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._fits(left, right)
        return known

    def _fits(self, left: int, right: int) -> bool:
        ends, begins = self._edge(left, 1), self._edge(right, 0)
        if ends is None or begins is None:
            return self.merged(self.tokens[left] + self.tokens[right]) == [left, right]
        tokens, i, j = self.tokens, 0, 0
        while True:
            across = self.ranks.get(tokens[ends[i]] + tokens[begins[j]], self.count)
            grow_left = ends[i + 1] if i + 1 < len(ends) else self.count
            grow_right = begins[j + 1] if j + 1 < len(begins) else self.count
            # equal ranks merge from the left: the left token's own, the one across, the right token's own
            if across < grow_left and across <= grow_right and across < self.count:
                return False
            if grow_left == grow_right == self.count:
                return True
            if grow_left <= grow_right:
                i += 1
            else:
                j += 1

    def piece(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        n, count, reach, shorter, pairs = len(piece), self.count, self.reach, self.shorter, self._pairs
        longest = [*map(self.single.__getitem__, piece), -1]
        if len(self.automaton):
            for end, token in self.automaton.iter(piece.decode("latin-1")):
                longest[end - reach[token]] = token  # ends ascend, so the longest is written last
        dead, out, at, token, last = bytearray(n + 1), [], 0, longest[0], -1
        while at < n:
            while token >= 0:
                if not dead[at + reach[token] + 1]:
                    if last < 0:
                        break
                    fit = pairs.get(last * count + token)
                    if self.fits(last, token) if fit is None else fit:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += reach[token] + 1
                last, token = token, longest[at]
            else:
                dead[at] = 1
                token = out.pop()
                at -= reach[token] + 1
                last = out[-1] if out else -1
        return out


class Encoder(dict):
    """Ids of texts, packed; as a dict it remembers those of short stretches."""

    def __init__(self, vocabulary: Vocabulary, pattern: str) -> None:
        super().__init__()
        self.vocabulary = vocabulary
        self.pieces = regex.compile(pattern).finditer

    def _packed(self, stretch: str) -> bytes:
        vocabulary = self.vocabulary
        if (stretch[1:] if stretch[0] == " " else stretch).isalpha():  # one piece
            ids = vocabulary.piece(stretch.encode())
        else:
            ids = [i for m in self.pieces(stretch) for i in vocabulary.piece(m.group().encode())]
        return b"".join(map(vocabulary.packed.__getitem__, ids))

    def __missing__(self, stretch: str) -> bytes:
        packed = self._packed(stretch)
        if len(stretch) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[stretch] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit numbers."""
        if len(text) <= SLICE:
            return b"".join(map(self.__getitem__, STRETCH.findall(text)))
        stretches, out = STRETCH.finditer(text), bytearray()
        while part := b"".join(self[m.group()] for m in islice(stretches, SLICE)):
            out += part
        return bytes(out)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@functools.lru_cache(maxsize=2)
def token_list(path: str) -> list[bytes | None]:
    """The bytes of each id of a rank file, which is all that decoding needs; read once a worker."""
    ranks = read_ranks(path)
    out: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a rank file, read once a worker."""
    return Vocabulary(read_ranks(path))


@functools.lru_cache(maxsize=2)
def own_encoder(path: str, pattern: str) -> Encoder:
    return Encoder(vocabulary(path), pattern)


def encoder(path: str, pattern: str):
    """A column function: the packed ids of a text.  ``path`` is the same on every machine."""

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = own_encoder(path, pattern)
        for texts in batches:
            yield pa.array([own.encode(t.as_py() or "") for t in texts], pa.binary())

    return encode


def decoder(path: str):
    """A column function: the bytes that packed ids stand for (null for null)."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokens = token_list(path)
        for packed in batches:
            yield pa.array([None if p is None else decoded(p, tokens) for p in (x.as_py() for x in packed)], pa.binary())

    return decode


def decoded(packed: bytes, tokens: list[bytes | None]) -> bytes:
    ids = np.frombuffer(packed, "<u4")
    parts, out = range(0, len(ids), SLICE), []
    for low in parts:
        try:
            out.append(b"".join(map(tokens.__getitem__, ids[low : low + SLICE].tolist())))
        except (IndexError, TypeError) as unknown:
            raise ValueError("an id is not in the vocabulary") from unknown
    return b"".join(out)


def coded(df: DataFrame, text: Column, keep: Sequence[Column], path: str, pattern: str) -> DataFrame:
    """``keep`` of each row, its packed ids, and the bytes decoded from them: both ways in one pass over the texts.

    Kept columns called ids or decoded come out as ``input_ids`` and ``input_decoded``.
    """
    names = set_apart(df.select(*keep), "ids", "decoded").columns
    plain = df.select(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(keep)]).alias("kept"), text.cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = own_encoder(path, pattern)
        tokens = own.vocabulary.tokens

        def part(kept: pa.Array, ids: list[bytes]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([kept, pa.array(ids, pa.binary()), pa.array([decoded(i, tokens) for i in ids], pa.binary())], names=["kept", "ids", "decoded"])

        for batch in batches:
            ids, held, low = [], 0, 0
            for t in batch.column(1):
                ids.append(own.encode(t.as_py() or ""))
                held += len(ids[-1])
                if held >= PART_BYTES:
                    yield part(batch.column(0).slice(low, len(ids)), ids)
                    ids, held, low = [], 0, low + len(ids)
            if ids:
                yield part(batch.column(0).slice(low), ids)

    both = plain.mapInArrow(run, f"kept {plain.schema['kept'].dataType.simpleString()}, ids binary, decoded binary")
    return both.select(*[F.col(f"kept.c{i}").alias(c) for i, c in enumerate(names)], "ids", "decoded")


def id_count(packed: Column) -> Column:
    return (F.octet_length(packed) / 4).cast("long")


def id_lister():
    """A column function: packed ids as an array of numbers."""

    @F.arrow_udf("array<long>")
    def listed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for packed in batches:
            ids = [None if p is None else np.frombuffer(p, "<u4").astype(np.int64) for p in (x.as_py() for x in packed)]
            yield pa.array(ids, pa.list_(pa.int64()))

    return listed
