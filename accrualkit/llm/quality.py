"""Quality classifier: a generalised additive model with pairwise interactions.

The log-odds of a text are a constant plus one number per feature and one per
chosen pair of features, each read from a lookup table over bins.  The tables
are learned by cyclic boosting: round after round, each feature in turn gets a
shallow tree over its bins, fitted to what is left unexplained and added with
a small rate, so correlated features share the credit.  Then the pairs whose
joint table explains most of the rest are boosted in the same way with shallow
trees over both.  Scoring is bin lookups and additions for whole batches.

The features are computed from the whole text alone.  Learning uses a bounded
sample (``TRAIN_ROWS``) of the labelled rows; every row is scored.

Defined cases: a null text scores like an empty one; without labels of both
kinds the score is the constant (0.5 if there are none); repeated rows score
alike; a very long text is read whole, in one task; an empty table gives an
empty result; columns beyond id, text and label are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.common import labelled_texts

#: Labelled rows to learn from, at most (about).
TRAIN_ROWS = 20_000
THRESHOLD = 0.7
BINS, PAIR_BINS, PAIRS = 48, 10, 6
ROUNDS, PAIR_ROUNDS, RATE, LEAF_ROWS = 250, 80, 0.08, 5

FEATURES = (
    "bytes", "words", "word_length", "upper", "digits", "stops", "exclamations", "symbols", "bars", "beyond_ascii",
    "distinct_words", "repeated_trigrams", "repeated_lines", "line_words", "top_word", "entropy", "short_words", "open_words",
)

_UPPER, _LOWER, _DIGITS = (np.arange(a, b + 1) for a, b in ((65, 90), (97, 122), (48, 57)))
_STOPS = np.frombuffer(b".,;:?", np.uint8)
_SYMBOLS = np.frombuffer(b"$%&*#@^~=+<>{}[]\\/_", np.uint8)


def features(text: bytes | None) -> list[float]:
    """The feature values of a UTF-8 text, in the order of ``FEATURES``."""
    text = text or b""
    words, n = text.split(), len(text)
    if not words:
        return [math.log1p(n), 0.0] + [0.0] * (len(FEATURES) - 2)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    m = len(words)
    upper, lower = int(count[_UPPER].sum()), int(count[_LOWER].sum())
    counted = Counter(words)
    triples = m - 2
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = count[count > 0] / n
    return [
        math.log1p(n), math.log1p(m), (n - m) / m, upper / max(1, upper + lower), int(count[_DIGITS].sum()) / n,
        int(count[_STOPS].sum()) / m, int(count[33]) / m, int(count[_SYMBOLS].sum()) / m, int(count[124]) / m,
        int(count[128:].sum()) / n, len(counted) / m,
        1 - len(set(zip(words, words[1:], words[2:], strict=False))) / triples if triples > 0 else 0.0,
        1 - len(set(lines)) / len(lines), math.log1p(m / len(lines)), max(counted.values()) / m,
        float(-(share * np.log2(share)).sum()), sum(len(w) <= 3 for w in counted) / len(counted),
        sum(not 97 <= w[-1] <= 122 for w in words) / m,
    ]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AdditiveModel:
    constant: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin of a feature -> its bin in pair tables
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(c, x[:, f], side="right") for f, c in enumerate(self.cuts)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.constant)
        if self.tables:
            bins = self.bins(x)
            for table, b in zip(self.tables, bins, strict=True):
                out += table[b]
            for (f, g), table in zip(self.pairs, self.pair_tables, strict=True):
                out += table[self.coarse[f][bins[f]], self.coarse[g][bins[g]]]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.logit(x))


def _gain(g, h):
    return g * g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, int]:
    """(gain, first bin of the right side) of the best cut of a row of bins; (0, 0) if none."""
    gl, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    if not len(gl):
        return 0.0, 0
    total = _gain(g.sum(), h.sum())
    gain = _gain(gl, hl) + _gain(g.sum() - gl, h.sum() - hl) - total
    gain[(nl < LEAF_ROWS) | (n.sum() - nl < LEAF_ROWS)] = 0.0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 0 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Leaf value for each bin of a tree of depth 2 over ordered bins."""
    out = np.zeros(len(g))

    def grow(low: int, high: int, depth: int) -> None:
        gain, cut = _best_cut(g[low:high], h[low:high], n[low:high]) if depth else (0.0, 0)
        if gain > 0:
            grow(low, low + cut, depth - 1)
            grow(low + cut, high, depth - 1)
        elif depth < 2:
            out[low:high] = g[low:high].sum() / (h[low:high].sum() + 1.0)

    grow(0, len(g), 2)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[float, np.ndarray]:
    """(gain, leaf values) of a tree over two features: a cut of one, then a cut of the other on each side."""
    best = (0.0, np.zeros_like(g))
    for turned in (False, True):
        a, b, c = (x.T if turned else x for x in (g, h, n))
        for cut in range(1, len(a)):
            gain, table = -_gain(a.sum(), b.sum()), np.zeros_like(a)
            for part in (slice(0, cut), slice(cut, len(a))):
                rows = [x[part].sum(0) for x in (a, b, c)]
                _, at = _best_cut(*rows)
                for side in (slice(0, at), slice(at, len(rows[0]))):
                    if rows[2][side].sum() >= LEAF_ROWS:
                        gain += _gain(rows[0][side].sum(), rows[1][side].sum())
                        table[part, side] = rows[0][side].sum() / (rows[1][side].sum() + 1.0)
            if gain > best[0]:
                best = gain, table.T if turned else table
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """The model learned from features ``x`` and labels ``y``."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.5
        return AdditiveModel(constant=math.log(rate / (1 - rate)))
    model = AdditiveModel(constant=math.log(y.mean() / (1 - y.mean())))
    levels = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(x[:, f], levels)) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    bins = model.bins(x)
    sizes = [np.bincount(b, minlength=len(t)) for b, t in zip(bins, model.tables, strict=True)]
    logit = np.full(len(y), model.constant)
    for _ in range(ROUNDS):
        for f, b in enumerate(bins):
            p = _sigmoid(logit)
            g, h = (np.bincount(b, w, len(sizes[f])) for w in (y - p, p * (1 - p)))
            step = RATE * _tree(g, h, sizes[f])
            model.tables[f] += step
            logit += step[b]
    model.coarse = [np.minimum(np.arange(len(t)) * PAIR_BINS // max(1, len(t)), PAIR_BINS - 1) for t in model.tables]
    rough = [c[b] for c, b in zip(model.coarse, bins, strict=True)]

    def sums(f: int, g: int, *weights: np.ndarray) -> list[np.ndarray]:
        cell = rough[f] * PAIR_BINS + rough[g]
        return [np.bincount(cell, w, PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for w in weights]

    p, one = _sigmoid(logit), np.ones(len(y))
    strength = {}
    for f in range(len(bins)):
        for g in range(f + 1, len(bins)):
            strength[f, g] = _pair_tree(*sums(f, g, y - p, p * (1 - p), one))[0]
    model.pairs = sorted(strength, key=lambda k: -strength[k])[:PAIRS]
    model.pair_tables = [np.zeros((PAIR_BINS, PAIR_BINS)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (f, g) in enumerate(model.pairs):
            p = _sigmoid(logit)
            step = RATE * _pair_tree(*sums(f, g, y - p, p * (1 - p), one))[1]
            model.pair_tables[k] += step
            logit += step[rough[f], rough[g]]
    return model


def _matrix(texts: pa.Array) -> np.ndarray:
    rows = [features(t.as_py()) for t in texts.cast(pa.large_binary())]
    return np.array(rows, np.float64).reshape(len(rows), len(FEATURES))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = _matrix(batch.column(0))
        rows = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES), pa.array(x.ravel()))
        yield pa.RecordBatch.from_arrays([rows, batch.column(1)], names=["x", "y"])


def train(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int = TRAIN_ROWS) -> AdditiveModel:
    """The model of ``label``, learned where crc32(doc_id) mod ``divisor`` is not ``held_out``."""
    sample = labelled_texts(docs, labels, label, divisor, held_out, rows)
    got = sample.select("text", "y").mapInArrow(_extract, "x array<double>, y int").toArrow()
    x = np.array(got.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = got.column("y").to_numpy().astype(np.float64)
    order = np.lexsort((*x.T, y))  # sums of floats in one order, however the rows arrive
    return fit(x[order], y[order])


def scorer(model: AdditiveModel):
    """A column function: score of a text."""

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(text)))

    return score
