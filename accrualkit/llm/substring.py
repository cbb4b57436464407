"""Exact substring deduplication over a range-partitioned sparse suffix array.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts
in a document with a smaller id.  The suffixes of all texts are too many to
ship, so they are sampled by content: of the ``ANCHOR``-byte blocks inside a
``LENGTH``-byte window, the one with the smallest hash (the leftmost of equal
ones) is the window's anchor.  Equal windows have the same anchor at the same
offset wherever they occur, and consecutive windows share theirs, so about one
suffix in 14 stands for all of them.

Round 1 sorts these suffixes by two leading tokens, the anchor block and the
stretch of text that its windows span (both hashed), then by document.
Sampled splitters range-partition them, each bucket is sorted locally by
multikey quicksort, and neighbours are compared: a stretch that also occurs in
an earlier document is removed as it stands.  If an anchor has several
different stretches, their first occurrences go on.

Round 2 takes the bytes of those stretches, range-partitioned by anchor, and
sorts their single windows by all bytes (leading tokens of 8 bytes), again by
local multikey quicksort and comparison of neighbours: a window is removed if
an earlier document has it.  Stretches of an anchor too frequent for one
bucket are taken apart first, and their windows range-partitioned by all
tokens and the document.

Splitters of round 1 and of single windows hold the document as the last
token, so a passage that a third of all documents share is split between
buckets like any other range.  Buckets are compared across their boundaries:
anchors that a splitter cuts always go on to round 2, and the windows that a
splitter cuts take their smallest document from all buckets involved.

Hashes of 91 bits stand for stretches in round 1; round 2 compares bytes.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose
nothing; a null id is larger than any other, and such documents are not
compared with each other, and neither are rows that repeat an id; columns
other than doc_id and text are ignored; rows alike in both are searched once; a very
long text is taken apart in parts; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.common import bounded_sample, stored

LENGTH, ANCHOR = 50, 24
#: Text bytes per bucket of round 1, and window rows per bucket of round 2, about.
BUCKET_BYTES, BUCKET_WINDOWS = 8 << 20, 1 << 19
#: Text that a task takes apart at once, about.
PART_BYTES = 4 << 20
#: Rows sampled for the splitters: so many per bucket, and at least.
SAMPLES_PER_BUCKET, SAMPLES = 8, 20_000
_SLICE = 1 << 18
_LAST_ID = (1 << 63) - 1
_LEAF = 1 << 14
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xFF51AFD7ED558CCD, 0xD6E8FEB86659FD93)]


# --- sampled suffixes -------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position of ``data`` on, as a number (a view)."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,))


def anchors(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Sampled suffixes of the texts ``data[offsets[i]:offsets[i + 1]]``, slice by slice.

    For each run of windows with one anchor: (text, first window, windows,
    anchor token, stretch token).  The stretch token includes the number of windows.
    """
    for low in range(0, len(data), _SLICE):
        part = data[low : low + _SLICE + LENGTH - 1]
        n = len(part) - LENGTH + 1
        if n <= 0:
            break
        valid = np.ones(n, bool)
        first, last = np.searchsorted(offsets, [low, low + n + LENGTH])
        for end in offsets[max(0, first) : last].tolist():
            valid[max(0, end - LENGTH + 1 - low) : max(0, end - low)] = False
        w = _words(part)
        m = len(part) - ANCHOR + 1
        h = w[:m] * _M[0] + w[8 : m + 8] * _M[1] + w[16 : m + 16] * _M[2]
        h ^= h >> np.uint64(32)
        h *= _M[3]
        least = (h & np.uint64(0xFFFFFFFFFF000000)) | np.arange(m, dtype=np.uint64)
        width, span = LENGTH - ANCHOR + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if span < width:
            rest = width - span
            least = np.minimum(least[:-rest], least[rest:])
        at = (least & np.uint64(0xFFFFFF)).astype(np.int32)
        fresh = np.ones(n, bool)
        fresh[1:] = (at[1:] != at[:-1]) | ~valid[:-1]
        ended = np.ones(n, bool)
        ended[:-1] = fresh[1:] | ~valid[1:]
        start, stop = np.flatnonzero(fresh & valid), np.flatnonzero(ended & valid)
        if not len(start):
            continue
        runs = stop - start + 1
        token = np.zeros(len(start), np.uint64)
        head, tail = start, stop + LENGTH  # the stretch is part[head:tail]
        for step in (*range(0, LENGTH - 8, 8), LENGTH - 8):
            for word in (w[head + step], w[tail - LENGTH + step]):
                token = (token ^ word) * _M[4]
                token ^= token >> np.uint64(31)
        token = (token * _M[0] >> np.uint64(21)) << np.uint64(5) | runs.astype(np.uint64)
        anchor = (h[at[start]] * _M[1]) >> np.uint64(16)
        begin = start + low
        text = np.searchsorted(offsets, begin, side="right") - 1
        yield text, begin - offsets[text], runs, anchor, token


def multikey_quicksort(tokens: list[np.ndarray]) -> np.ndarray:
    """Order of the rows by ``tokens``, most significant first.

    Rows are split in three by a pivot of the current token; the middle part,
    equal in it, goes on with the next token.  Small parts are sorted at once.
    """
    done, stack = [], [(np.arange(len(tokens[0])), 0)]
    while stack:
        rows, depth = stack.pop()
        if len(rows) <= _LEAF or depth == len(tokens):
            if depth < len(tokens) and len(rows) > 1:
                rows = rows[np.lexsort([t[rows] for t in reversed(tokens[depth:])])]
            done.append(rows)
            continue
        key = tokens[depth][rows]
        pivot = np.sort(key[:: max(1, len(key) // 101)])[len(key[:: max(1, len(key) // 101)]) // 2]
        less, more = key < pivot, key > pivot
        stack += [(rows[more], depth), (rows[~(less | more)], depth + 1), (rows[less], depth)]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def _bucket_of(splitters: list[np.ndarray], tokens: list[np.ndarray]) -> np.ndarray:
    """How many splitters (rows of sorted token columns) are at or below each row."""
    low = np.zeros(len(tokens[0]), np.int64)
    high = np.full(len(tokens[0]), len(splitters[0]), np.int64)
    while len(splitters[0]) and (open_ := low < high).any():
        middle = np.minimum((low + high) // 2, len(splitters[0]) - 1)
        below, equal = np.zeros(len(low), bool), np.ones(len(low), bool)
        for s, t in zip(splitters, tokens, strict=True):
            v = s[middle]
            below |= equal & (v < t)
            equal &= v == t
        up = open_ & (below | equal)
        low, high = np.where(up, middle + 1, low), np.where(open_ & ~up, middle, high)
    return low


def _splitters(rows: list[tuple[int, ...]], buckets: int, types: list) -> list[np.ndarray]:
    """``buckets`` - 1 evenly spaced rows of the sorted sample, as token columns."""
    rows = sorted(rows)
    picked = [rows[i * len(rows) // buckets] for i in range(1, buckets)] if rows else []
    return [np.array([r[k] for r in picked], t) for k, t in enumerate(types)]


def _texts(batch: pa.RecordBatch, column: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; the texts stand one after another."""
    array = pa.concat_arrays([batch.column(column).cast(pa.large_binary())])
    if array.null_count:
        array = array.fill_null(b"")
    offsets = np.frombuffer(array.buffers()[1], np.int64, len(array) + 1, array.offset * 8)
    raw = array.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and len(offsets) > 1 else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


# --- round 1: suffixes by anchor and stretch --------------------------------


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in parts of about ``PART_BYTES`` of text, one row at least."""
    for batch in batches:
        sizes = np.cumsum(_texts(batch, column)[1][1:])
        low = 0
        while low < batch.num_rows:
            high = int(np.searchsorted(sizes, (sizes[low - 1] if low else 0) + PART_BYTES, side="right"))
            high = min(batch.num_rows, max(low + 1, high))
            yield batch.slice(low, high - low)
            low = high


def _suffix_rows(splitters: list[np.ndarray] | None, nth: int, with_uid: bool):
    """Rows (bucket, k1, k2, doc, uid if needed) of every ``nth`` suffix.

    k1 = anchor and head of the stretch token, k2 = its rest and the position.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 2):
            docs = batch.column(0).fill_null(_LAST_ID).to_numpy(zero_copy_only=False)
            uids = batch.column(1).to_numpy(zero_copy_only=False)
            for found in anchors(*_texts(batch, 2)):
                text, begin, _, anchor, stretch = (c[::nth] for c in found)
                doc = docs[text]
                k1 = anchor << np.uint64(16) | stretch >> np.uint64(32)
                k2 = (stretch & np.uint64(0xFFFFFFFF)) << np.uint64(32) | begin.astype(np.uint64)
                bucket = _bucket_of(splitters, [k1, k2 >> np.uint64(32), doc]) if splitters is not None else np.zeros(len(doc), np.int64)
                columns = {"bucket": bucket.astype(np.int32), "k1": _signed(k1), "k2": _signed(k2), "doc": doc}
                if with_uid:
                    columns["uid"] = uids[text]
                yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in columns.items()})

    return run


_ROWS_DDL = "bucket int, k1 long, k2 long, doc long"


def _whole(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray] | None:
    """The columns of a bucket (bounded by the splitters)."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return None
    return [np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in got]) for i in range(got[0].num_columns)]


def _compare_suffixes(cut_anchors: np.ndarray):
    """Of a bucket: removed stretches (no anchor), and first occurrences of stretches that go on (with their anchor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _whole(batches)
        if columns is None:
            return
        k1, k2, doc, uid = columns[1].view(np.uint64), columns[2].view(np.uint64), columns[3], columns[-1]
        head = k2 >> np.uint64(32)
        order = multikey_quicksort([k1, head, doc])
        k1, k2, head, doc, uid = k1[order], k2[order], head[order], doc[order], uid[order]
        anchor = k1 >> np.uint64(16)
        new_anchor = np.r_[True, anchor[1:] != anchor[:-1]]
        new_stretch = new_anchor | np.r_[True, (k1[1:] != k1[:-1]) | (head[1:] != head[:-1])]
        stretch_of = np.cumsum(new_stretch) - 1
        firsts = np.flatnonzero(new_stretch)
        least = doc[firsts][stretch_of]
        anchor_of = np.cumsum(new_anchor) - 1
        ends = np.flatnonzero(new_anchor)
        stretches = np.add.reduceat(new_stretch.astype(np.int64), ends)
        low, high = np.minimum.reduceat(doc, ends), np.maximum.reduceat(doc, ends)
        cut = np.isin(anchor[ends], cut_anchors)
        goes_on = (((stretches > 1) & (low < high)) | cut)[anchor_of]
        removed, further = doc > least, goes_on & (doc == least)
        keep = np.flatnonzero(removed | further)
        spans = (k2[keep] & np.uint64(0xFFFFFFFF)) << np.uint64(5) | head[keep] & np.uint64(31)
        for i in range(0, len(keep), 1 << 18):
            s = slice(i, i + (1 << 18))
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[keep[s]]), pa.array(uid[keep[s]]), pa.array(_signed(spans[s])), pa.array(anchor[keep[s]].astype(np.int64), mask=removed[keep[s]])],
                names=["doc", "uid", "span", "anchor"],
            )

    return run


# --- round 2: single windows by their bytes ---------------------------------

_TOKENS = -(-LENGTH // 8)


def window_tokens(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The ``LENGTH`` bytes from each position on, as big-endian tokens of 8 bytes (the last one shorter)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    words = _words(padded)
    out = []
    for k in range(_TOKENS):
        token = words[at + 8 * k].byteswap()
        left = LENGTH - 8 * k
        out.append(token >> np.uint64(8 * (8 - left)) if left < 8 else token)
    return out


def _open_spans(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, span, anchor) of each open stretch: column 3 lists span and anchor."""
    spans = batch.column(3)
    values = spans.flatten()
    row = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(spans.offsets)))
    return row, *(values.field(i).to_numpy(zero_copy_only=False) for i in range(2))


def _stretch_rows(splitters: np.ndarray, with_uid: bool):
    """Rows (bucket, stretch, begin, doc, uid if needed) of the open stretches; buckets are ranges of anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 2):
            data, offsets = _texts(batch, 2)
            row, span, anchor = _open_spans(batch)
            begin = span >> 5
            start, length = begin + offsets[row], (span & 31) + LENGTH - 1
            ends = np.cumsum(length)
            picked = data[np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)]
            stretch = pa.Array.from_buffers(
                pa.binary(), len(span), [None, pa.py_buffer(np.r_[0, ends].astype(np.int32)), pa.py_buffer(picked.tobytes())]
            )
            columns = {"bucket": pa.array(np.searchsorted(splitters, anchor, side="right").astype(np.int32)), "stretch": stretch, "begin": pa.array(begin)}
            columns["doc"] = pa.array(batch.column(0).to_numpy(zero_copy_only=False)[row])
            if with_uid:
                columns["uid"] = pa.array(batch.column(1).to_numpy(zero_copy_only=False)[row])
            yield pa.RecordBatch.from_pydict(columns)

    return run


_STRETCH_DDL = "bucket int, stretch binary, begin long, doc long"


def _compare_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a bucket with whole anchors: the windows that an earlier document has, as runs."""
    got = [b for b in batches if b.num_rows]
    if not got:
        return
    table = pa.Table.from_batches(got).combine_chunks().to_batches()[0]
    data, offsets = _texts(table, 1)
    begin, doc, uid = (table.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, table.num_columns - 1))
    windows = np.diff(offsets) - LENGTH + 1
    which = np.repeat(np.arange(len(windows)), windows)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(windows) - windows, windows)
    tokens, own = window_tokens(data, offsets[which] + nth), doc[which]
    order = multikey_quicksort([*tokens, own])
    new = np.zeros(len(order), bool)
    for t in tokens:
        t = t[order]
        new[1:] |= t[1:] != t[:-1]
    new[0] = True
    least = own[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    late = np.zeros(len(order), bool)
    late[order] = own[order] > least
    first = late & ~np.r_[False, late[:-1] & (nth[1:] > 0)]
    last = late & ~np.r_[late[1:] & (nth[1:] > 0), False]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    yield pa.RecordBatch.from_arrays([pa.array(uid[which[a]]), pa.array((begin[which[a]] + nth[a]) << 5 | (b - a + 1))], names=["uid", "span"])


def _window_rows(splitters: list[np.ndarray] | None, with_uid: bool):
    """Rows (bucket, t0.., begin, doc, uid if needed) of the open windows of each text: columns doc, uid, text, spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches, 2):
            data, offsets = _texts(batch, 2)
            row, span, _ = _open_spans(batch)
            runs = span & 31
            which = np.repeat(np.arange(len(span)), runs)
            nth = np.arange(len(which)) - np.repeat(np.cumsum(runs) - runs, runs)
            begin, row = (span >> 5)[which] + nth, row[which]
            doc = batch.column(0).to_numpy(zero_copy_only=False)[row]
            tokens = window_tokens(data, begin + offsets[row])
            bucket = _bucket_of(splitters, [*tokens, doc]) if splitters is not None else np.zeros(len(doc), np.int64)
            columns = {"bucket": bucket.astype(np.int32), **{f"t{k}": _signed(t) for k, t in enumerate(tokens)}, "begin": begin, "doc": doc}
            if with_uid:
                columns["uid"] = batch.column(1).to_numpy(zero_copy_only=False)[row]
            for i in range(0, len(doc), 1 << 17):
                yield pa.RecordBatch.from_pydict({k: pa.array(v[i : i + (1 << 17)]) for k, v in columns.items()})

    return run


_WINDOWS_DDL = "bucket int, " + ", ".join(f"t{k} long" for k in range(_TOKENS)) + ", begin long, doc long"
_UID_DDL = ", uid long"


def _compare_windows(splitters: list[np.ndarray]):
    """Of a bucket: the windows that an earlier document has (cut -1), and those whose first occurrence
    may be in another bucket (cut: the first splitter with these bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = _whole(batches)
        if columns is None:
            return
        tokens = [c.view(np.uint64) for c in columns[1 : 1 + _TOKENS]]
        begin, doc, uid = columns[1 + _TOKENS], columns[2 + _TOKENS], columns[-1]
        order = multikey_quicksort([*tokens, doc])
        tokens, doc, uid, begin = [t[order] for t in tokens], doc[order], uid[order], begin[order]
        new = np.r_[True, np.any([t[1:] != t[:-1] for t in tokens], axis=0)]
        group, firsts = np.cumsum(new) - 1, np.flatnonzero(new)
        least = doc[firsts][group]
        cut = np.full(len(firsts), -1, np.int64)
        if len(splitters[0]):
            at = _bucket_of(splitters[:-1], [t[firsts] for t in tokens])
            last, same = np.maximum(at - 1, 0), at > 0  # the last splitter at or below these bytes
            for s, t in zip(splitters[:-1], tokens, strict=True):
                same &= s[last] == t[firsts]
            cut = np.where(same, last, -1)
        pending = (doc == least) & (cut[group] >= 0)
        keep = np.flatnonzero((doc > least) | pending)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[keep]), pa.array(uid[keep]), pa.array(begin[keep] << 5 | 1), pa.array(np.where(pending, cut[group], -1)[keep])],
            names=["doc", "uid", "span", "cut"],
        )

    return run


# --- the operator -----------------------------------------------------------


def removed_spans(docs: DataFrame, with_uid: bool, bucket_bytes: int = BUCKET_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """uid, span of all removed stretches of ``docs`` (doc, uid, text): span = 32 * begin + windows.

    ``with_uid`` says whether uid differs from doc and has to travel as well.
    """
    (total,) = docs.agg(F.sum(F.octet_length("text"))).first()
    buckets = max(1, -(-(total or 0) // bucket_bytes))
    ddl = _ROWS_DDL + _UID_DDL * with_uid
    rows: list = []
    if buckets > 1:
        wanted = max(SAMPLES, SAMPLES_PER_BUCKET * buckets)
        sample = bounded_sample(docs, F.col("uid"), wanted // 16).mapInArrow(_suffix_rows(None, 16, with_uid), ddl).limit(4 * wanted)
        rows = [(r["k1"] % (1 << 64), r["k2"] % (1 << 64) >> 32, r["doc"]) for r in sample.select("k1", "k2", "doc").collect()]
    splitters = _splitters(rows, buckets, [np.uint64, np.uint64, np.int64])
    cut_anchors = np.unique(splitters[0] >> np.uint64(16))
    suffixes = docs.mapInArrow(_suffix_rows(splitters, 1, with_uid), ddl)
    compared = suffixes.repartitionById(buckets, F.col("bucket")).mapInArrow(
        _compare_suffixes(cut_anchors), "doc long, uid long, span long, anchor long"
    )
    round1 = stored(compared, "suffixes")
    found = round1.filter("anchor is null").select("uid", "span")
    return found.unionByName(_round2(docs, round1.filter("anchor is not null"), with_uid, bucket_windows))


def _round2(docs: DataFrame, open_rows: DataFrame, with_uid: bool, bucket_windows: int) -> DataFrame:
    """uid, span of the windows of open stretches (doc, uid, span, anchor) that an earlier document has."""
    n_windows = F.sum(F.col("span").bitwiseAND(F.lit(31)))
    (windows,) = open_rows.agg(n_windows).first()
    buckets = max(1, -(-(windows or 0) // bucket_windows))
    # anchors that fill a bucket alone: no more than there are buckets
    frequent = [r["anchor"] for r in open_rows.groupBy("anchor").agg(n_windows.alias("n")).filter(F.col("n") > bucket_windows).collect()]
    is_frequent = F.col("anchor").isin(frequent) if frequent else F.lit(False)
    usual = open_rows.filter(~is_frequent)
    picked = sorted(r["anchor"] for r in bounded_sample(usual, F.struct("uid", "span"), max(SAMPLES, SAMPLES_PER_BUCKET * buckets)).select("anchor").collect())
    splitters = np.unique(np.array([picked[i * len(picked) // buckets] for i in range(1, buckets)] if picked else [], np.int64))
    rows = _with_text(docs, usual).mapInArrow(_stretch_rows(splitters, with_uid), _STRETCH_DDL + _UID_DDL * with_uid)
    found = stored(rows.repartitionById(len(splitters) + 1, F.col("bucket")).mapInArrow(_compare_stretches, "uid long, span long"), "stretches")
    if frequent:
        found = found.unionByName(_single_windows(docs, open_rows.filter(is_frequent), with_uid, bucket_windows))
    return found


def _with_text(docs: DataFrame, some: DataFrame, small: bool = False) -> DataFrame:
    """doc, uid, text, spans (span and anchor of each stretch in ``some``)."""
    spans = some.groupBy(F.col("uid").alias("open_uid")).agg(F.collect_list(F.struct("span", "anchor")).alias("spans"))
    joined = docs.join(F.broadcast(spans) if small else spans, docs["uid"] == F.col("open_uid"))
    return joined.select(F.coalesce("doc", F.lit(_LAST_ID)).alias("doc"), "uid", "text", "spans")


def _single_windows(docs: DataFrame, open_rows: DataFrame, with_uid: bool, bucket_windows: int) -> DataFrame:
    """As ``_round2``, for anchors too frequent for one bucket: windows are dealt to buckets one by one."""
    ddl = _WINDOWS_DDL + _UID_DDL * with_uid
    (windows,) = open_rows.agg(F.sum(F.col("span").bitwiseAND(F.lit(31)))).first()
    buckets = max(1, -(-(windows or 0) // bucket_windows))
    some = bounded_sample(open_rows, F.struct("uid", "span"), max(SAMPLES, SAMPLES_PER_BUCKET * buckets) // 8)
    got = _with_text(docs, some, small=True).mapInArrow(_window_rows(None, with_uid), ddl).select(*[f"t{k}" for k in range(_TOKENS)], "doc").collect()
    splitters = _splitters([(*(x % (1 << 64) for x in r[:-1]), r[-1]) for r in got], buckets, [*[np.uint64] * _TOKENS, np.int64])
    rows = _with_text(docs, open_rows).mapInArrow(_window_rows(splitters, with_uid), ddl)
    compared = stored(
        rows.repartitionById(buckets, F.col("bucket")).mapInArrow(_compare_windows(splitters), "doc long, uid long, span long, cut long"), "windows"
    )
    pending = compared.filter("cut >= 0")
    # one row per splitter at most
    first = F.broadcast(pending.groupBy("cut").agg(F.min("doc").alias("first")))
    late = pending.join(first, "cut").filter(F.col("doc") > F.col("first"))
    return compared.filter("cut < 0").select("uid", "span").unionByName(late.select("uid", "span"))


def _cut_text(text: bytes, spans: np.ndarray) -> tuple[int, int, int, bytes]:
    """(bytes, removed bytes, removed runs, what is left)."""
    if not len(spans):
        return len(text), 0, 0, text
    begin = spans >> 5
    steps = np.zeros(len(text) + 1, np.int32)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + (spans & 31) + LENGTH - 1, -1)
    gone = np.cumsum(steps[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return len(text), int(gone.sum()), runs, np.frombuffer(text, np.uint8)[~gone].tobytes()


def _kept(with_bytes: bool):
    names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_bytes]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            texts, spans = batch.column(1).cast(pa.large_binary()), batch.column(2)
            for doc, text, s in zip(batch.column(0).to_pylist(), texts, spans, strict=True):
                values = s.values.to_numpy(zero_copy_only=False) if s.is_valid else np.zeros(0, np.int64)
                n, removed, runs, left = _cut_text(text.as_py() or b"", values)
                out.append((doc, n, removed, runs, hashlib.sha256(left).hexdigest(), *[left] * with_bytes))
            types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * with_bytes
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * len(types), types, strict=True)], names=names)

    return run


def without_repeats(docs: DataFrame, with_bytes: bool = False, bucket_bytes: int = BUCKET_BYTES, bucket_windows: int = BUCKET_WINDOWS) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes themselves) for each row."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))
    # ids tell rows apart unless some are repeated or null
    repeated = bool(plain.groupBy("doc").count().filter((F.col("count") > 1) | F.col("doc").isNull()).head(1))
    plain = plain.select("doc", (F.xxhash64("doc", "text") if repeated else F.col("doc")).alias("uid"), "text")
    # rows alike in both have the same spans: they are searched once
    spans = removed_spans(plain.distinct() if repeated else plain, repeated, bucket_bytes, bucket_windows)
    per_text = spans.groupBy(F.col("uid").alias("cut_uid")).agg(F.collect_list("span").alias("spans"))
    joined = plain.join(per_text, plain["uid"] == F.col("cut_uid"), "left").select("doc", "text", "spans")
    ddl = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_bytes
    return joined.mapInArrow(_kept(with_bytes), ddl)
