"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A fingerprint is 64 bits, that is 8 positional bytes.  Two fingerprints that
differ in at most 2 bits differ in at most 2 bytes, so they are guaranteed to
share 6 positional bytes.  The index therefore posts each distinct fingerprint
under every choice of 6 positions (28 lists: position set and the bytes there):
a list holds only fingerprints that reach the guaranteed minimum, and none
that shares single frequent bytes.  Pairs from short lists are tallied (shared
positional bytes), kept at 6 or more, and verified by their bit distance.  As a
list is keyed by 6 positions at once, the index has done the filtering: every
tallied pair has 6, and the verification decides.

A list has at most 2**16 members, since they can only differ in two bytes.
Long lists are not paired: each member is posted under its remaining 16 bits
and the 16 values one bit away, and linked to the smallest member that it
meets there.  Two values meet exactly if they differ in at most 2 bits, so
the components are the same with 17 rows per member.

Components come from alternating large-star and small-star rounds, each
written to the shared folder.

Defined cases: a text that is null or has no word has fingerprint zero; equal
fingerprints always link; a null id never names a component (a component
whose ids are all null has a null id); a very long text is hashed whole, in
one task; an empty table gives an empty result; columns beyond doc_id and text
are not read (``one_of_each`` keeps them, whatever their names are).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.llm.common import fresh, stored

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
BYTES = 8
#: Lists of up to so many fingerprints are paired, longer ones linked through one-bit neighbours.
PAIRED_LIST = 32
_CHUNK = 1 << 18


def fingerprint(text: bytes | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of a UTF-8 text as an unsigned 64-bit number."""
    words = (text or b"").lower().split()  # bytes: lower-cases A-Z, splits at 20 09-0D
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < words_per_shingle:
        return digest(join(words), HASH_SEED)
    n = len(words) - words_per_shingle + 1
    ones = np.zeros(64, np.int64)
    for low in range(0, n, _CHUNK):
        part = words[low : min(n, low + _CHUNK) + words_per_shingle - 1]
        shifted = [part[i:] for i in range(words_per_shingle)]
        h = np.array([digest(join(t), HASH_SEED) for t in zip(*shifted, strict=False)], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(ones * 2 > n, bitorder="little")
    return int.from_bytes(bits.tobytes(), "little")


def _fingerprints(words_per_shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.large_binary())
            fps = np.fromiter((fingerprint(t.as_py(), words_per_shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["id", "h", "fp"])

    return run


def fingerprints(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """id, h (a hash of the text, to tell rows apart) and fp (the 64 bits as a signed long) of each row."""
    text = F.col("text").cast("string")
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64(text).alias("h"), text.alias("text"))
    return plain.mapInArrow(_fingerprints(words_per_shingle), "id long, h long, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _masks(max_bits: int) -> list[int]:
    """For each choice of positions that may differ, the bits that must agree."""
    full = (1 << 64) - 1
    return [full & ~sum(0xFF << (8 * i) for i in odd) for odd in combinations(range(BYTES), max_bits)]


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the 8 positional bytes are equal."""
    x = a.bitwiseXOR(b)
    return sum(((F.shiftrightunsigned(x, 8 * i).bitwiseAND(F.lit(255))) == 0).cast("int") for i in range(BYTES))


def links(distinct: DataFrame, max_bits: int = MAX_BITS, paired_list: int = PAIRED_LIST) -> DataFrame:
    """Edges u > v between distinct fingerprints (column fp) whose components are those of all links."""
    if not 1 <= max_bits <= 2:
        raise ValueError("the one-bit neighbours of long lists serve distances of 1 and 2")
    masks = _masks(max_bits)
    # (masked bytes, which positions): the post of a fingerprint in one list
    posts = F.array(*[F.struct(F.lit(i).alias("at"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bytes")) for i, m in enumerate(masks)])
    posted = distinct.select("fp", F.explode(posts).alias("post")).select("fp", "post.at", "post.bytes")
    size = F.count("*").over(Window.partitionBy("at", "bytes"))
    lists = stored(posted.withColumn("n", size).filter(F.col("n") > 1), "lists")

    short = lists.filter(F.col("n") <= paired_list)
    a, b = short.select("at", "bytes", F.col("fp").alias("u")), short.select("at", "bytes", F.col("fp").alias("v"))
    pairs = a.join(b, ["at", "bytes"]).filter(F.col("u") > F.col("v"))
    tallied = pairs.filter(shared_bytes(F.col("u"), F.col("v")) >= BYTES - max_bits)
    near = tallied.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits).select("u", "v")

    # one-bit neighbours of the bits that the list leaves open (for a distance of 1, from one side only)
    open_bits = F.array(*[F.array(*[F.lit(_signed(1 << bit)) for bit in range(64) if not m >> bit & 1]) for m in masks])
    flips = F.concat(F.array(F.lit(0).cast("long")), F.element_at(open_bits, F.col("at") + 1))
    long = lists.filter(F.col("n") > paired_list)
    around = long.select("at", "fp", F.explode(flips).alias("flip")).select("at", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("value"))
    smallest = F.min("fp").over(Window.partitionBy("at", "value"))
    met = around.withColumn("v", smallest).filter(F.col("fp") > F.col("v")).select(F.col("fp").alias("u"), "v")
    if max_bits == 1:
        met = met.filter(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= 1)
    return near.unionByName(met).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root for each node of ``edges`` (u, v): root is the smallest node that it reaches."""
    edges, before = stored(edges.select("u", "v"), "edges"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter(F.col("u") != F.col("v")).distinct(), "large")
        # u > v throughout: the small neighbours of u are all its v
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        edges = stored(small.select("e.u", "e.v").filter(F.col("u") != F.col("v")).distinct(), "small")
        state = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state


def near_duplicates(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """id, h, fp, component (smallest id reachable), copies (rows of that fingerprint) for each row."""
    rows = stored(fingerprints(docs, words_per_shingle), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("copies")), "classes")
    roots = components(links(classes.select("fp"), max_bits))
    rooted = stored(
        classes.join(roots, classes["fp"] == roots["node"], "left").select(
            "fp", "first", "copies", F.coalesce("root", "fp").alias("root")
        ),
        "rooted",
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component"))
    lookup = stored(rooted.join(named, "root").select("fp", "root", "copies", "component"), "named")
    return rows.join(lookup, "fp").select("id", "h", "fp", "root", "component", "copies")


def one_of_each(docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row left of each component: one of its smallest id.

    Only if no row of a component has an id, one of those without stays.
    """
    found = near_duplicates(docs, words_per_shingle, max_bits)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "h"))
    k_id, k_h, h, n = fresh(docs, "kept_id", "kept_h", "h", "nth")
    kept = found.groupBy("root").agg(best.alias("b")).select(F.col("b.id").alias(k_id), F.col("b.h").alias(k_h))
    keyed = docs.withColumn(h, F.xxhash64(F.col("text").cast("string")))
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(k_id)) & (F.col(h) == F.col(k_h))
    nth = F.row_number().over(Window.partitionBy(k_id, k_h).orderBy(k_h))
    left = keyed.join(stored(kept, "kept"), same).withColumn(n, nth).filter(F.col(n) == 1)
    return left.select(*docs.columns)
