"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A text is read in overlapping windows of ``WINDOW`` words.  Each word enters
as its own embedding (words of the training sample) beside the mean embedding
of its character n-grams (3 to 5 bytes of the word in angle brackets, hashed),
so unknown forms of a known stem are seen as well.  A gated recurrent unit
runs over the window in each direction, attention weighs the joint states, and
a linear layer gives the window's log-odds.  A text is as toxic as its worst
window; two numbers fitted on whole training texts turn that into a
probability.

Labels belong to texts, not windows.  So training alternates: the worst window
of every text and random windows of clean texts make the examples, and after a
few epochs they are picked again.  The embeddings start from the log-odds of
words and n-grams in toxic texts.

Learning uses a bounded sample of rows (``TRAIN_ROWS`` texts).  Its texts stay
whole and with Spark: tasks go through all windows of a text and return the
worst one (by the log-odds of its words at first, by the network later) and the
random ones that were drawn; the driver holds only these.  Scoring reads every
window of every text as well, in chunks of bounded size however long a text is.

Defined cases: a text that is null or has no word gets the score of an empty
window; without labels of both kinds all scores are the share of toxic ones
(0 if there are none); repeated rows score alike; a very long text is read
whole, window by window, in one task; an empty table gives an empty result;
columns beyond id, text and label are not read (``without_toxic`` keeps them,
whatever their names are).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from accrualkit.llm.common import MASK64, fresh, labelled_texts, stored
from accrualkit.llm.grams import WordRows
from accrualkit.llm.grams import char_grams as grams_of_words

THRESHOLD = 0.5
WINDOW, STRIDE = 32, 16
HIDDEN, WORD_DIM, CHAR_DIM, ATTENTION = 8, 6, 8, 8
GRAM_BITS = 15
GRAM_BUCKETS = 1 << GRAM_BITS
#: Bounds of the training sample.
TRAIN_ROWS, VOCABULARY = 4_000, 30_000
EPOCHS, STEPS, BATCH, RATE = 24, 400, 128, 0.01  # so many epochs and steps at least
#: Words, and windows, that are handled at once in scoring.
CHUNK_WORDS, CHUNK_WINDOWS, CACHE_WORDS = 1 << 17, 4096, 1 << 18

_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def char_grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, index of its word) of every 3 to 5 byte gram of ``<word>``."""
    return grams_of_words(words, 3, 5, GRAM_BITS)


def window_starts(n: int) -> np.ndarray:
    """Starts of the windows over ``n`` words: the last one reaches the end."""
    return np.arange(0, max(1, n - WINDOW + STRIDE), STRIDE) if n else np.zeros(0, np.int64)


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Network:
    """Parameters, forward and backward pass."""

    def __init__(self, vocabulary: dict[str, int], rng: np.random.Generator):
        self.vocabulary = vocabulary  # word -> row of ``words``; row 0 is any other word
        d = WORD_DIM + CHAR_DIM
        near = lambda *shape: (rng.standard_normal(shape) * (0.3 / math.sqrt(shape[0]) if len(shape) > 1 else 0.1)).astype(np.float32)
        self.p = {"words": near(len(vocabulary) + 1, WORD_DIM) * 0.1, "grams": near(GRAM_BUCKETS, CHAR_DIM) * 0.1}
        for side in "fb":
            self.p |= {f"w{side}": near(d, 3 * HIDDEN) * 2, f"u{side}": near(HIDDEN, 3 * HIDDEN) * 2, f"c{side}": np.zeros(3 * HIDDEN, np.float32)}
        self.p |= {"a": near(2 * HIDDEN, ATTENTION) * 2, "v": near(ATTENTION), "o": near(2 * HIDDEN), "bias": np.zeros(1, np.float32)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, words: list[str], grams: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """Input vector of each word: its embedding and the mean of its n-grams'."""
        bucket, owner = grams or char_grams(words)
        out = np.empty((len(words), WORD_DIM + CHAR_DIM), np.float32)
        known = self.vocabulary
        out[:, :WORD_DIM] = self.p["words"][np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))]
        n = np.maximum(1, np.bincount(owner, minlength=len(words)))
        picked = self.p["grams"][bucket]
        for k in range(CHAR_DIM):
            out[:, WORD_DIM + k] = np.bincount(owner, picked[:, k], len(words)) / n
        return out

    def project(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x @ self.p["wf"] + self.p["cf"], x @ self.p["wb"] + self.p["cb"]

    def _run(self, table: np.ndarray, ids: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None) -> np.ndarray:
        """States (time, window, HIDDEN) over the steps of ``ids`` in their order."""
        steps, h = ids.shape[1], np.zeros((len(ids), HIDDEN), np.float32)
        out = np.empty((steps, len(ids), HIDDEN), np.float32)
        for t in range(steps):
            x, hu = table[ids[:, t]], h @ u
            gates = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            n = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            m = mask[:, t, None]
            if keep is not None:
                keep.append((h, z, r, n, hu[:, 2 * HIDDEN :], m))
            h = np.where(m, n + z * (h - n), h)
            out[t] = h
        return out

    def forward(self, tables, ids, mask, keep: dict | None = None) -> np.ndarray:
        """Log-odds of each window; ``tables`` are the projected inputs that ``ids`` points into."""
        p, kf, kb = self.p, ([] if keep is not None else None), ([] if keep is not None else None)
        f = self._run(tables[0], ids, mask, p["uf"], kf)
        b = self._run(tables[1], ids[:, ::-1], mask[:, ::-1], p["ub"], kb)[::-1]
        s = np.concatenate([f, b], axis=2)  # time, window, 2 HIDDEN
        e = np.tanh(s @ p["a"])
        weight = np.where(mask.T, e @ p["v"], -1e9)
        weight = np.exp(weight - weight.max(0))
        weight *= mask.T
        weight /= np.maximum(weight.sum(0), 1e-9)
        pooled = np.einsum("tw,twh->wh", weight, s)
        if keep is not None:
            keep |= {"f": kf, "b": kb, "s": s, "e": e, "weight": weight, "pooled": pooled}
        return pooled @ p["o"] + p["bias"][0]

    def _back(self, side: str, kept: list, ds: np.ndarray, grads: dict) -> np.ndarray:
        """Gradient of the projected inputs (time, window, 3 HIDDEN), given those of the states."""
        u, dh = self.p[f"u{side}"], np.zeros_like(ds[0])
        dx = np.empty((*ds.shape[:2], 3 * HIDDEN), np.float32)
        du = np.zeros_like(u)
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, n, hn, m = kept[t]
            dh = dh + ds[t]
            d = np.where(m, dh, 0)
            dn = d * (1 - z) * (1 - n * n)
            dz = d * (h - n) * z * (1 - z)
            dr = dn * hn * r * (1 - r)
            dx[t, :, :HIDDEN], dx[t, :, HIDDEN : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :] = dz, dr, dn
            dhu = np.concatenate([dz, dr, dn * r], axis=1)
            du += h.T @ dhu
            dh = np.where(m, d * z + dhu @ u.T, dh)
        grads[f"u{side}"] = du
        return dx

    def gradients(self, words: list[str], grams, ids: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the weighted logistic loss for windows over ``words``."""
        p, grads, keep = self.p, {}, {}
        x = self.inputs(words, grams)
        logit = self.forward(self.project(x), ids, mask, keep)
        dl = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
        grads["o"], grads["bias"] = keep["pooled"].T @ dl, np.array([dl.sum()], np.float32)
        dpooled = dl[:, None] * p["o"]
        s, e, a = keep["s"], keep["e"], keep["weight"]
        ds = a[:, :, None] * dpooled
        da = np.einsum("twh,wh->tw", s, dpooled)
        dscore = a * (da - (a * da).sum(0))
        de = dscore[:, :, None] * p["v"] * (1 - e * e)
        grads["v"] = np.einsum("tw,twk->k", dscore, e)
        grads["a"] = np.einsum("twh,twk->hk", s, de)
        ds += de @ p["a"].T
        dx = np.zeros((len(words), WORD_DIM + CHAR_DIM), np.float32)
        for side, part, order in (("f", ds[:, :, :HIDDEN], ids), ("b", ds[::-1, :, HIDDEN:], ids[:, ::-1])):
            dproj = self._back(side, keep[side], part, grads)
            flat = order.T.ravel()
            summed = np.stack([np.bincount(flat, dproj[:, :, k].ravel(), len(words)) for k in range(3 * HIDDEN)], 1).astype(np.float32)
            grads[f"w{side}"], grads[f"c{side}"] = x.T @ summed, summed.sum(0)
            dx += summed @ p[f"w{side}"].T
        rows = np.fromiter((self.vocabulary.get(w, 0) for w in words), np.int64, len(words))
        grads["words"] = np.stack([np.bincount(rows, dx[:, k], len(p["words"])) for k in range(WORD_DIM)], 1)
        bucket, owner = grams
        dg = (dx[:, WORD_DIM:] / np.maximum(1, np.bincount(owner, minlength=len(words)))[:, None])[owner]
        grads["grams"] = np.stack([np.bincount(bucket, dg[:, k], GRAM_BUCKETS) for k in range(CHAR_DIM)], 1)
        return grads


class Scorer:
    """Window log-odds of whole texts, with a bounded cache of projected words."""

    def __init__(self, net: Network):
        self.net, self.empty = net, float(net.p["bias"][0])
        self.rows = WordRows(lambda words: np.concatenate(net.project(net.inputs(words)), axis=1), 6 * HIDDEN, CACHE_WORDS)

    def windows(self, pieces: list[list[str]]) -> list[np.ndarray]:
        """Log-odds of the windows of each word list (up to ``CHUNK_WORDS`` words altogether)."""
        flat = self.rows.indices([w for p in pieces for w in p])
        begins = np.cumsum([0, *map(len, pieces)])
        starts = [window_starts(len(p)) for p in pieces]
        first = np.concatenate([s + b for s, b in zip(starts, begins[:-1], strict=True)]).astype(np.int64)
        last = np.repeat(begins[1:], [len(s) for s in starts])
        out = np.empty(len(first), np.float64)
        for low in range(0, len(first), CHUNK_WINDOWS):
            part = slice(low, low + CHUNK_WINDOWS)
            at = first[part, None] + np.arange(WINDOW)
            mask = at < last[part, None]
            out[part] = self.values(flat[np.minimum(at, len(flat) - 1)], mask)
        return np.split(out, np.cumsum([len(s) for s in starts])[:-1])

    def values(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return self.net.forward((self.rows.table[:, : 3 * HIDDEN], self.rows.table[:, 3 * HIDDEN :]), ids, mask)

    def worst(self, texts: Iterator[str | list[str] | None], found: list[list[str]] | None = None) -> np.ndarray:
        """Log-odds of the worst window of each text (or its words); of an empty window where there is none.

        ``found`` gets the words of these windows.
        """
        best: list[float] = []
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def flush():
            nonlocal held
            if waiting:
                for (doc, piece), logits in zip(waiting, self.windows([p for _, p in waiting]), strict=True):
                    at = int(logits.argmax())
                    if logits[at] > best[doc]:
                        best[doc] = float(logits[at])
                        if found is not None:
                            found[doc] = piece[at * STRIDE : at * STRIDE + WINDOW]
            waiting.clear()
            held = 0

        for doc, text in enumerate(texts):
            words = text if isinstance(text, list) else words_of(text)
            best.append(-math.inf if words else self.empty)
            if found is not None:
                found.append([])
            step = CHUNK_WORDS // 2 // STRIDE * STRIDE
            for low in range(0, len(words), step):
                piece = words[low : low + step + WINDOW - STRIDE]
                if low and len(piece) <= WINDOW - STRIDE:
                    break  # the windows before have read these words
                if held + len(piece) > CHUNK_WORDS:
                    flush()
                waiting.append((doc, piece))
                held += len(piece)
        flush()
        return np.array(best)

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        return _sigmoid(np.clip(self.net.scale * self.worst(texts) + self.net.shift, -30, 30))


def _association(with_it: np.ndarray, without: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """How strongly occurrence in toxic texts stands out: log-odds, but no more than the evidence allows.

    The evidence is half the signed root of the likelihood ratio statistic.
    """
    odds = np.log((with_it + 0.3) / (n1 + 0.6)) - np.log((without + 0.3) / (n0 + 0.6))
    total = with_it + without
    ratio = np.zeros(len(odds))
    for got, n in ((with_it, n1), (without, n0)):
        expected = total * (n / (n1 + n0))
        ratio += np.where(got > 0, got * np.log(np.maximum(got, 1e-9) / np.maximum(expected, 1e-9)), 0)
    evidence = np.sqrt(np.maximum(0, 2 * ratio)) / 2
    return np.clip(np.sign(odds) * np.minimum(np.abs(odds), evidence), -2, 4)


class Hints(Scorer):
    """Values of windows before there is a network: the two strongest hints among the words."""

    def __init__(self, known: dict[str, float], other: float, gram_odds: np.ndarray):
        def hints(words: list[str]) -> np.ndarray:
            bucket, owner = char_grams(words)
            own = np.zeros(len(words))
            np.maximum.at(own, owner, gram_odds[bucket])
            return (own + np.fromiter((known.get(w, other) for w in words), np.float64, len(words)))[:, None]

        self.empty = 0.0
        self.rows = WordRows(hints, 1, CACHE_WORDS)

    def values(self, ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        return np.sort(np.where(mask, self.rows.table[ids, 0], 0), axis=1)[:, -2:].sum(1)


class Sample:
    """Labelled training texts (id, h, text, y) of a table; what looks at whole texts runs in its tasks."""

    def __init__(self, rows: DataFrame):
        self.rows = rows

    def run(self, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> pa.Table:
        return self.rows.mapInArrow(each, schema).toArrow()

    def totals(self, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], key: str, least: int) -> pa.Table:
        """Sums of ``toxic`` and ``clean`` by the first column ``key``, where they make ``least`` or more."""
        got = self.rows.mapInArrow(each, f"{key}, toxic long, clean long").groupBy(key.split()[0])
        return got.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") + F.col("clean") >= least).toArrow()


class HeldSample(Sample):
    """The same for word lists in memory."""

    def __init__(self, texts: list[list[str]], y: np.ndarray):
        n = len(texts)
        columns = {"id": pa.array(range(n), pa.int64()), "h": pa.array([0] * n, pa.int64()), "text": pa.array([" ".join(t) for t in texts], pa.string()), "y": pa.array(np.asarray(y, np.int32))}
        self.batch = pa.RecordBatch.from_pydict(columns)

    def run(self, each, schema):
        return pa.Table.from_batches(each(iter([self.batch])))

    def totals(self, each, key, least):
        name = key.split()[0]
        got = self.run(each, key).group_by(name).aggregate([("toxic", "sum"), ("clean", "sum")])
        sums = pa.table({name: got.column(name), "toxic": got.column("toxic_sum"), "clean": got.column("clean_sum")})
        return sums.filter(pa.array(np.add(*(sums.column(c).to_numpy() for c in ("toxic", "clean"))) >= least))


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], int, list[str]]]:
    """((id, h), y, words) of each text."""
    for i, h, y, text in zip(*(batch.column(c).to_pylist() for c in ("id", "h", "y")), batch.column("text"), strict=True):
        yield (i, h), y, words_of(text.as_py())


def _about(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, h and y of each text, and whether it has a word."""
    for batch in batches:
        has = pa.array([bool(_WORD.search(t.as_py() or "")) for t in batch.column("text")], pa.bool_())
        yield pa.RecordBatch.from_arrays([*map(batch.column, ("id", "h", "y")), has], names=["id", "h", "y", "has"])


def _word_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, y, words in _rows_of(batch):
            own = pa.array(list(dict.fromkeys(words)), pa.string())
            yield pa.RecordBatch.from_arrays([own, *(pa.array(np.full(len(own), n, np.int64)) for n in (y, 1 - y))], names=["word", "toxic", "clean"])


def _gram_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, GRAM_BUCKETS), np.int64)
    for batch in batches:
        for _, y, words in _rows_of(batch):
            own, seen = list(dict.fromkeys(words)), np.zeros(GRAM_BUCKETS, bool)
            for low in range(0, len(own), CHUNK_WORDS):
                seen[char_grams(own[low : low + CHUNK_WORDS])[0]] = True
            counts[y] += seen
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(GRAM_BUCKETS)), pa.array(counts[1]), pa.array(counts[0])], names=["bucket", "toxic", "clean"])


CANDIDATES = "id long, h long, y int, nth int, value double, words string"


def _candidates(scorers: Callable[[], dict[int, Scorer]], wanted: dict[tuple[int, int], int], turn: int):
    """A pass over all windows of all texts: the worst one (nth 0) by the scorer of the text's label, and
    as many random ones (nth 1 and on) as are ``wanted`` of the text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_label = scorers()
        for batch in batches:
            labels = batch.column("y").to_numpy()
            for label, scorer in by_label.items():
                keys, found, random = [], [], []

                def texts(own=batch.filter(pa.array(labels == label)), keys=keys, random=random):
                    for key, _, words in _rows_of(own):
                        keys.append(key)
                        if words and key in wanted:
                            starts = window_starts(len(words))
                            drawn = np.random.default_rng([key[0] & MASK64, key[1] & MASK64, turn]).choice(starts, wanted[key])
                            random += [(key, n, math.nan, words[s : s + WINDOW]) for n, s in enumerate(drawn.tolist(), 1)]
                        yield words

                values = scorer.worst(texts(), found)
                out = [(k, 0, v, w) for k, v, w in zip(keys, values.tolist(), found, strict=True)] + random
                columns = [[k[0] for k, *_ in out], [k[1] for k, *_ in out], [label] * len(out), *([r[c] for r in out] for c in (1, 2)), [" ".join(r[3]) for r in out]]
                types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "h", "y", "nth", "value", "words"])

    return each


def fit(texts: list[list[str]], y: np.ndarray, seed: int = 5) -> Network:
    """Train on word lists and their labels."""
    return learn(HeldSample(texts, y), seed)


def learn(sample: Sample, seed: int = 5) -> Network:
    """Train on the texts of ``sample``."""
    rng = np.random.default_rng(seed)
    about = sample.run(_about, "id long, h long, y int, has boolean").sort_by([("id", "ascending"), ("h", "ascending")])
    y, has = about.column("y").to_numpy(), about.column("has").to_numpy()
    n1, n0 = int(y.sum()), int((1 - y).sum())
    if not n1 or not n0:
        net = Network({}, rng)
        share = min(1 - 1e-6, max(1e-6, n1 / max(1, n1 + n0)))
        net.scale, net.shift = 0.0, math.log(share / (1 - share))
        return net
    keys = list(zip(about.column("id").to_pylist(), about.column("h").to_pylist(), strict=True))
    toxic, clean = np.flatnonzero((y == 1) & has), np.flatnonzero((y == 0) & has)

    # embeddings start from log-odds: of words by texts, of n-grams by texts
    seen = sample.totals(_word_texts, "word string", 2)
    words, with_it, without = seen.column("word").to_pylist(), *(seen.column(c).to_numpy() for c in ("toxic", "clean"))
    word_odds = _association(with_it, without, n1, n0)
    common = sorted(range(len(words)), key=lambda i: (-with_it[i] - without[i], words[i]))[:VOCABULARY]
    net = Network({words[w]: i + 1 for i, w in enumerate(common)}, rng)
    net.p["words"][1:, 0] = 0.3 * word_odds[common]
    grams = sample.totals(_gram_texts, "bucket long", 0).sort_by("bucket")
    gram_odds = _association(*(grams.column(c).to_numpy() for c in ("toxic", "clean")), n1, n0)
    net.p["grams"][:, 0] = 0.6 * gram_odds
    known = {w: max(0.0, odds) for w, odds in zip(words, word_odds.tolist(), strict=True)}
    # any other word is in no other text, so the label of its text tells its odds
    other = max(0.0, float(_association(np.ones(1), np.zeros(1), n1, n0)[0]))

    def batch_of(picked: list[list[str]]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct words, their positions by window, mask) of windows."""
        index: dict[str, int] = {}
        at, mask = np.zeros((len(picked), WINDOW), np.int64), np.zeros((len(picked), WINDOW), bool)
        for k, part in enumerate(picked):
            at[k, : len(part)], mask[k, : len(part)] = [index.setdefault(w, len(index)) for w in part], True
        return list(index), at, mask

    per_epoch = max(1, -(-min(5 * len(toxic), 4 * len(toxic) + len(clean)) // BATCH))
    epochs = max(EPOCHS, -(-STEPS // per_epoch))
    turn = max(4, epochs // 6)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        if epoch % turn == 0:
            drawn = [rng.choice(clean, min(len(clean), len(toxic)), replace=False) for _ in range(turn)]
            scorers = (lambda: {0: Hints(known, 0.0, gram_odds), 1: Hints(known, other, gram_odds)}) if epoch == 0 else (lambda: dict.fromkeys((0, 1), Scorer(net)))
            got = sample.run(_candidates(scorers, dict(Counter(keys[t] for d in drawn for t in d)), epoch), CANDIDATES)
            got = got.sort_by([("id", "ascending"), ("h", "ascending"), ("nth", "ascending")])
            positive, hard, random = [], [], {}
            for *key, label, nth, part in zip(*(got.column(c).to_pylist() for c in ("id", "h", "y", "nth", "words")), strict=True):
                if nth:
                    random.setdefault(tuple(key), []).append(part.split())
                elif part:
                    (positive if label else hard).append(part.split())
        easy = [random[keys[t]].pop() for t in drawn[epoch % turn]]
        hard_now = [hard[i] for i in rng.choice(len(hard), min(len(hard), 3 * len(positive)), replace=False)]
        windows = positive + hard_now + easy
        target = np.r_[np.ones(len(positive)), np.zeros(len(windows) - len(positive))].astype(np.float32)
        order = rng.permutation(len(windows))
        for low in range(0, len(order), BATCH):
            part = order[low : low + BATCH]
            distinct, at, mask = batch_of([windows[i] for i in part])
            weight = np.where(target[part] == 1, 2.0, 1.0).astype(np.float32)
            grads = net.gradients(distinct, char_grams(distinct), at, mask, target[part], weight)
            step += 1
            rate = RATE * min(1.0, step / 50) * (1 - 0.9 * epoch / epochs)
            norm = math.sqrt(sum(float((g.astype(np.float64) ** 2).sum()) for g in grads.values()))
            for k, g in grads.items():
                g = g / max(1.0, norm)
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                net.p[k] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    got = sample.run(_candidates(lambda: dict.fromkeys((0, 1), Scorer(net)), {}, epochs), CANDIDATES).sort_by([("id", "ascending"), ("h", "ascending")])
    _calibrate(net, got.column("value").to_numpy(), got.column("y").to_numpy())
    return net


def _calibrate(net: Network, x: np.ndarray, y: np.ndarray) -> None:
    """Scale and shift of the log-odds ``x`` of the worst windows of whole texts, by logistic regression."""
    mean, spread = x.mean(), max(1e-6, x.std())
    z, a, b = (x - mean) / spread, 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(np.clip(a * z + b, -30, 30))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - y) * z).sum() + 1e-3 * a, (p - y).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        da, db = np.linalg.solve(hess, g)
        a, b = min(40.0, max(0.0, a - max(-2.0, min(2.0, da)))), b - max(-2.0, min(2.0, db))
    net.scale, net.shift = a / spread, b - a * mean / spread


def train(docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, rows: int = TRAIN_ROWS) -> Network:
    """The network for ``label``, learned where crc32(doc_id) mod ``divisor`` is not ``held_out``."""
    sample = labelled_texts(docs, labels, label, divisor, held_out, rows)
    rows = sample.select("id", F.xxhash64("text").alias("h"), "text", "y").repartition(docs.sparkSession.sparkContext.defaultParallelism)
    return learn(Sample(stored(rows, "toxicity-sample")))


def scorer(net: Network):
    """A column function: score of a text."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Scorer(net)
        for texts in batches:
            yield pa.array(own.scores(t.as_py() for t in texts))

    return score


def without_toxic(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns kept."""
    (score,) = fresh(docs, "score")
    return docs.withColumn(score, scorer(net)(F.col("text").cast("string"))).filter(F.col(score) < threshold).drop(score)
