"""Benchmark decontamination by size-partitioned MinHash containment search.

Which documents contain a short test item?  An item is the set of its five-word
shingles (words: letters, digits and underscores, lower-cased); a document
contains it if at least 0.8 of that set occurs in the document.

Jaccard similarity says nothing here, since a document may be a thousand times
as long as an item.  So containment is estimated from the item's side: its
MinHash sketch is the shingles with the smallest hashes, and each is looked up
in the document.  Items are partitioned by size; the sketch of a partition is
longer than the number of shingles that an item of that size may miss, so a
contained item always has hits (at least ``sketch - allowed misses``) and no
link is lost.  A partition is skipped for documents too short to contain its
items.  Candidates are verified by exact shingle containment on the words
themselves.

The items are the query set.  They go to the tasks in blocks of about
``BLOCK_WORDS`` words, however many there are; each block meets all documents,
and a document is handled alone, so no key gathers rows.  What a block finds is
written before the next block is read, so the driver and the plan hold one.

Defined cases: an item of fewer than five words has one shingle, its whole
word sequence; an item without words (or null) is contained nowhere; repeated
rows are searched and reported like any others, but an item row that repeats
another exactly is searched once; null ids are returned as null; a null or empty text
contains nothing, a very long one is searched whole, in one task; empty tables
of documents or items give no finds; ``without_items`` keeps all columns,
whatever their names are.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.common import fresh, mix64, stored

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
#: Sketch entries beyond the number that a contained item may miss.
SPARE = 3
#: Words of the items that are sent to the tasks at once, about.
BLOCK_WORDS = 1_000_000

_WORD = re.compile(r"\w+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def _rolled(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words; runs with an unknown word (hash 0) get 0."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, known = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(k):
        part = hashes[i : i + n]
        out = (out ^ part) * _FACTOR
        out ^= out >> np.uint64(29)
        known &= part != 0
    return np.where(known, out | np.uint64(1), np.uint64(0))


class ItemIndex:
    """The sketches of a block of items, partitioned by size, and their shingles for the verification."""

    def __init__(self, items: list[tuple[int | None, str | None]], shingle_words: int, containment: float):
        self.word_hash: dict[str, int] = {}
        self.items = []  # (id, words per shingle, shingles, needed)
        posts: dict[tuple[int, int], dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        hits: list[int] = []
        for item_id, text in items:
            words = words_of(text)
            if not words:
                continue
            for w in words:
                self.word_hash.setdefault(w, mix64(xxhash.xxh64_intdigest(w.encode())) | 1)
            k = min(shingle_words, len(words))
            shingles = set(zip(*(words[i:] for i in range(k)), strict=False))
            size = len(shingles)
            needed = math.ceil(containment * size - 1e-9)
            partition = size.bit_length()  # sizes of 2**(b-1) to 2**b - 1
            largest = 2**partition - 1
            sketch = min(size, largest - math.ceil(containment * largest - 1e-9) + SPARE)
            hits.append(sketch - (size - needed))
            at = len(self.items)
            self.items.append((item_id, k, shingles, needed))
            hashed = _rolled(np.array([self.word_hash[w] for w in words], np.uint64), k)
            for h in np.unique(hashed)[:sketch].tolist():
                posts[k, partition][h].append(at)
        self.hits = np.array(hits, np.int64)
        # per partition: shortest document in shingles, sorted sketch hashes, where their items are
        self.partitions = []
        for (k, b), table in sorted(posts.items()):
            keys = np.array(sorted(table), np.uint64)
            ends = np.cumsum([len(table[int(h)]) for h in keys])
            shortest = math.ceil(containment * 2 ** (b - 1) - 1e-9)
            self.partitions.append((k, shortest, keys, ends, np.array([i for h in keys for i in table[int(h)]], np.int64)))

    def contained(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item, shared shingles, shingles of the item) for each item that ``text`` contains."""
        words = words_of(text)
        known = self.word_hash
        hashes = np.fromiter((known.get(w, 0) for w in words), np.uint64, len(words))
        rolled: dict[int, np.ndarray] = {}
        found: list[int] = []
        for k, shortest, keys, ends, items in self.partitions:
            if len(words) - k + 1 < shortest:
                continue
            if k not in rolled:
                h = _rolled(hashes, k)
                rolled[k] = np.unique(h[h != 0])
            at = np.searchsorted(keys, rolled[k])
            at = at[at < len(keys)] if len(at) and at[-1] == len(keys) else at
            hit = at[keys[at] == rolled[k][: len(at)]]
            if len(hit):
                met = np.concatenate([items[(ends[i - 1] if i else 0) : ends[i]] for i in hit])
                which, count = np.unique(met, return_counts=True)
                found += which[count >= self.hits[which]].tolist()
        out, own = [], {}
        for i in found:
            item_id, k, shingles, needed = self.items[i]
            if k not in own:
                own[k] = set(zip(*(words[j:] for j in range(k)), strict=False))
            shared = len(shingles & own[k])
            if shared >= needed:
                out.append((item_id, shared, len(shingles)))
        return out


def item_blocks(items: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, str | None]]]:
    """The distinct items in blocks of about ``block_words`` words, one at a time."""
    plain = items.select(F.col("item_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    words = F.size(F.split(F.coalesce("text", F.lit("")), r"\s+"))
    total = plain.agg(F.sum(words)).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    for b in range(blocks):
        part = plain.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).distinct()
        yield sorted(((r["id"], r["text"]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))


_FOUND = pa.schema([("id", pa.int64()), ("item_id", pa.int64()), ("shared", pa.int64()), ("shingles", pa.int64())])


def _search(index: ItemIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (doc, *match)
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                for match in index.contained(text.as_py())
            ]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FOUND, strict=True)], schema=_FOUND)

    return run


def contained_items(
    docs: DataFrame, items: DataFrame, shingle_words: int = SHINGLE_WORDS, containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """id, item_id, shared, shingles, containment: one row for each document and item that it contains."""
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in item_blocks(items, block_words):
        if found is not None:  # one block at a time, in the plan as on the driver
            found = stored(found, "contained")
        part = plain.mapInArrow(_search(ItemIndex(block, shingle_words, containment)), "id long, item_id long, shared long, shingles long")
        found = part if found is None else found.unionByName(part)
    return found.withColumn("containment", F.col("shared") / F.col("shingles"))


def without_items(
    docs: DataFrame, items: DataFrame, shingle_words: int = SHINGLE_WORDS, containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` without the rows that contain an item; all columns kept."""
    (clean,) = fresh(docs, "clean")
    left = docs
    for block in item_blocks(items, block_words):
        if left is not docs:
            left = stored(left, "clean")
        none_of = _none_of(ItemIndex(block, shingle_words, containment))
        left = left.withColumn(clean, none_of(F.col("text").cast("string"))).filter(F.col(clean)).drop(clean)
    return left


def _none_of(index: ItemIndex):
    @F.arrow_udf("boolean")
    def none_of(text: pa.Array) -> pa.Array:
        return pa.array([not index.contained(t.as_py()) for t in text], pa.bool_())

    return none_of
