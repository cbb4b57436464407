"""Language identification of mixed-language text.

Runs of letters are cut into words where the script changes.  Script ranges
narrow the candidates of each word to the languages seen in its script; a
script that is rare in a language (under ``SCRIPT_SHARE`` of its words) speaks
against it by its share, but does not rule it out.  Each candidate scores the word: hashed character n-grams and, for
common words, the word itself, as log-probabilities learned per language.
Viterbi over the words, with a penalty for switching, labels spans; the
language of a text is the one whose spans have the most letters.

Every labelled language is learned, from a bounded sample (``TEXTS`` of its
distinct texts) reduced to its ``WORDS`` most frequent words.  Labels belong to texts and texts are
mixed, so the counts are taken twice: the second time without the words that
the first model gives to another language.  Every text is labelled as a whole.

Defined cases: a null text or one without a letter is ``und`` with score 0, as
is any text if nothing could be learned; a word in a script that no language
uses counts for no language; ties go to the more frequent language in the
sample, then the smaller name; repeated rows are labelled alike; an empty table
gives an empty result; a very long text is labelled whole, in one task; other
columns are not read.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from accrualkit.llm.common import stored
from accrualkit.llm.grams import WordRows, char_grams

UNKNOWN = "und"
#: Bounds of what is learned from.
TEXTS, WORDS = 2_000, 30_000
GRAM_LOW, GRAM_HIGH, GRAM_BITS = 1, 4, 16
#: Log-odds that a switch of language costs, and the most that one word says against a language.
SWITCH, WORST = 8.0, 12.0
#: Share of a language's words below which a script speaks against it, the more the rarer it is there.
SCRIPT_SHARE = 0.02
#: Words handled at once with up to ``CHUNK_LANGUAGES`` languages (fewer words with more), and words scored at once with one.
CHUNK_WORDS, CHUNK_LANGUAGES, SCORED_WORDS = 1 << 19, 64, 1 << 22

_WORD = re.compile(r"[^\W\d_]+")
# First code points of script blocks and the script from there on
SCRIPTS = (
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"),
    (0x0600, "Arabic"), (0x0700, "other"), (0x0750, "Arabic"), (0x0780, "other"), (0x08A0, "Arabic"),
    (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"),
    (0x0E00, "Thai"), (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"),
    (0x1100, "Hangul"), (0x1200, "Ethiopic"), (0x13A0, "other"), (0x1780, "Khmer"), (0x1800, "Mongolian"),
    (0x18B0, "other"), (0x1C90, "Georgian"), (0x1CC0, "other"), (0x1D00, "Latin"), (0x1F00, "Greek"),
    (0x2000, "Latin"), (0x2E80, "Han"), (0x3040, "Kana"), (0x3100, "Han"), (0x3130, "Hangul"), (0x3190, "Han"),
    (0x31F0, "Kana"), (0x3400, "Han"), (0xA000, "other"), (0xA640, "Cyrillic"), (0xA720, "Latin"), (0xA800, "other"),
    (0xAC00, "Hangul"), (0xD800, "other"), (0xF900, "Han"), (0xFB00, "Latin"), (0xFB1D, "Hebrew"), (0xFB50, "Arabic"),
    (0xFF21, "Latin"), (0xFF66, "Kana"), (0xFFA0, "Hangul"), (0x10000, "other"), (0x20000, "Han"),
)
_STARTS = [s for s, _ in SCRIPTS]
#: A character beyond the first block, which has one script.
_BEYOND = re.compile(f"[^\\0-{chr(SCRIPTS[1][0] - 1)}]")


def script_of(word: str) -> str:
    """Script of the first letter (words have one script)."""
    return SCRIPTS[bisect_right(_STARTS, ord(word[0])) - 1][1]


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters of one script."""
    text = (text or "").lower()
    found = _WORD.findall(text)
    if not _BEYOND.search(text):
        return found
    return ["".join(run) for w in found for _, run in (groupby(w, script_of) if _BEYOND.search(w) else [("", w)])]


@dataclass
class LanguageModel:
    languages: list[str] = field(default_factory=list)
    #: Of each language: its scripts, and what a word in one loses for it (0 for a usual script).
    scripts: list[dict[str, float]] = field(default_factory=list)
    grams: np.ndarray = field(default_factory=lambda: np.zeros((1 << GRAM_BITS, 0), np.float32))
    words: dict[str, int] = field(default_factory=dict)
    #: Log-share of an unseen word in each language, and the best log-share of each of ``words``.
    unseen: np.ndarray = field(default_factory=lambda: np.zeros(0))
    best: np.ndarray = field(default_factory=lambda: np.zeros(0))
    #: (begin in ``seen_in`` by word, languages the word was seen in, log-shares there).
    begins: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    seen_in: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    shares: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def word_scores(self, known: np.ndarray) -> np.ndarray:
        """Log-scores of some of ``words`` as wholes, by language."""
        out = np.clip(self.unseen - self.best[known, None], -6, 0)
        n = self.begins[known + 1] - self.begins[known]
        at = np.repeat(self.begins[known + 1] - np.cumsum(n), n) + np.arange(n.sum())
        row = np.repeat(np.arange(len(known)), n)
        out[row, self.seen_in[at]] = np.clip(self.shares[at] - self.best[known][row], -6, 0)
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        """Log-score of each word in each language, 0 for the best; then its number of letters."""
        step = max(1, SCORED_WORDS // max(1, len(self.languages)))
        return np.concatenate([self._scores(words[low : low + step]) for low in range(0, max(1, len(words)), step)])

    def _scores(self, words: list[str]) -> np.ndarray:
        n, k = len(words), len(self.languages)
        bucket, owner = char_grams(words, GRAM_LOW, GRAM_HIGH, GRAM_BITS)
        count = np.bincount(owner, minlength=n)
        picked = self.grams[bucket]
        out = np.stack([np.bincount(owner, picked[:, j], n) for j in range(k)], 1) / np.sqrt(np.maximum(1, count))[:, None]
        known = np.fromiter((self.words.get(w, -1) for w in words), np.int64, n)
        out[known >= 0] += self.word_scores(known[known >= 0])
        letters = np.fromiter((sum(map(str.isalpha, w)) for w in words), np.float32, n)
        own = [script_of(w) for w in words]
        names, script = np.unique(own, return_inverse=True) if own else (np.array([]), np.zeros(0, np.int64))
        if len(names):
            out += np.array([[scripts.get(s, -np.inf) for scripts in self.scripts] for s in names.tolist()])[script]
        best = out.max(1, keepdims=True)
        nowhere = ~np.isfinite(best[:, 0]) | (letters == 0)
        out = np.maximum(out - np.where(np.isfinite(best), best, 0), -WORST)
        out[nowhere] = 0.0
        return np.concatenate([out, np.where(nowhere, 0, letters)[:, None], letters[:, None]], 1).astype(np.float32)


def learn(counts: list[tuple[str, str, int]], languages: list[str]) -> LanguageModel:
    """A model from (language, word, count), twice counted."""
    if not languages or not counts:
        return LanguageModel()
    place = {name: j for j, name in enumerate(languages)}
    vocabulary = sorted({w for _, w, _ in counts})
    index = {w: i for i, w in enumerate(vocabulary)}
    word = np.fromiter((index[w] for _, w, _ in counts), np.int64, len(counts))
    lang = np.fromiter((place[name] for name, _, _ in counts), np.int32, len(counts))
    order = np.lexsort((lang, word))
    word, lang, n = word[order], lang[order], np.fromiter((n for *_, n in counts), np.float64, len(counts))[order]
    scripts, script = np.unique([script_of(w) for w in vocabulary], return_inverse=True)
    own = [np.flatnonzero(lang == j) for j in range(len(languages))]

    def model(weights: np.ndarray) -> LanguageModel:
        total = np.maximum(1.0, np.bincount(lang, weights, len(languages)))
        used, grams = [], np.empty((1 << GRAM_BITS, len(languages)), np.float32)
        for j, at in enumerate(own):
            share = np.bincount(script[word[at]], weights[at], len(scripts)) / total[j]
            used.append({s: max(-WORST, min(0.0, math.log(x / SCRIPT_SHARE))) for s, x in zip(scripts.tolist(), share.tolist(), strict=True) if x})
            # frequent words should not drown the rest: n-grams count word types by the root of their tokens
            bucket, owner = char_grams([vocabulary[i] for i in word[at]], GRAM_LOW, GRAM_HIGH, GRAM_BITS)
            g = np.bincount(bucket, np.sqrt(weights[at])[owner], 1 << GRAM_BITS)
            grams[:, j] = np.log((g + 0.2) / (g.sum() + 0.2 * (1 << GRAM_BITS)))
        common = np.bincount(word, weights, len(vocabulary)) >= 3
        kept = common[word]
        frequent = np.flatnonzero(common)
        room = total + 0.2 * len(vocabulary)
        shares, unseen = np.log((weights[kept] + 0.2) / room[lang[kept]]), np.log(0.2 / room)
        begins = np.r_[0, np.cumsum(np.bincount(word[kept], minlength=len(vocabulary))[frequent])]
        best = np.maximum(np.maximum.reduceat(shares, begins[:-1]), unseen.max()) if len(frequent) else np.zeros(0)
        return LanguageModel(languages, used, grams, {vocabulary[i]: k for k, i in enumerate(frequent)}, unseen, best, begins, lang[kept], shares)

    first = model(n)
    kept = np.empty(len(n), bool)
    step = max(1, SCORED_WORDS // len(languages))
    for low in range(0, len(vocabulary), step):
        part = slice(*np.searchsorted(word, (low, low + step)))
        kept[part] = first.scores(vocabulary[low : low + step])[word[part] - low, lang[part]] > -SWITCH / 2
    return model(np.where(kept, n, 0.05 * n))


def viterbi(scores: np.ndarray, lengths: np.ndarray, penalty: float = SWITCH) -> np.ndarray:
    """Best label of each word; the texts' words stand one after another in ``scores`` (words, labels)."""
    begins = np.cumsum(lengths) - lengths
    order = np.argsort(-lengths, kind="stable")
    begins, lengths = begins[order], lengths[order]
    labels = np.zeros(len(scores), np.int32)
    if not len(lengths) or not lengths[0]:
        return labels
    active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")  # texts with more than t words
    value = np.zeros((len(lengths), scores.shape[1]), np.float32)
    switched, source = [], []
    for t, n in enumerate(active.tolist()):
        v = value[:n]
        if t:
            best = v.argmax(1)
            jump = v[np.arange(n), best, None] - np.float32(penalty)
            switched.append(jump > v)
            source.append(best.astype(np.int32))
            v = np.maximum(v, jump)
            v -= v.max(1, keepdims=True)
        value[:n] = v + scores[begins[:n] + t]
    current = value.argmax(1).astype(np.int32)
    for t in range(len(active) - 1, -1, -1):
        n = int(active[t])
        labels[begins[:n] + t] = current[:n]
        if t:
            jumped = switched[t - 1][np.arange(n), current[:n]]
            current[:n] = np.where(jumped, source[t - 1], current[:n])
    return labels


class Labeller:
    """Labels whole texts, in chunks of about ``CHUNK_WORDS`` words (fewer if there are many languages)."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.chunk = max(1, CHUNK_WORDS * CHUNK_LANGUAGES // max(CHUNK_LANGUAGES, len(model.languages)))
        self.rows = WordRows(model.scores, len(model.languages) + 2, self.chunk)

    def _chunk(self, texts: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(labels of all words, letters that count, letters)."""
        flat = [w for t in texts for w in t]
        parts = []
        for low in range(0, len(flat), self.chunk):  # a text may be longer than a chunk
            at = self.rows.indices(flat[low : low + self.chunk])
            parts.append(self.rows.table[at])
        scored = np.concatenate(parts) if parts else np.zeros((0, len(self.model.languages) + 2), np.float32)
        labels = viterbi(scored[:, :-2], np.array([len(t) for t in texts], np.int64))
        return labels, scored[:, -2], scored[:, -1]

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """(language, start, end) of maximal runs of words of one language, in characters of the text."""
        found = []  # (word, start, end)
        for m in _WORD.finditer(text or ""):
            at = m.start()
            for _, run in groupby(m[0], lambda c: script_of(c.lower())):
                word = "".join(run)
                found.append((word, at, at + len(word)))
                at += len(word)
        if not found or not self.model.languages:
            return []
        labels, _, _ = self._chunk([[w.lower() for w, _, _ in found]])
        out: list[tuple[str, int, int]] = []
        for (_, start, end), label in zip(found, labels.tolist(), strict=True):
            name = self.model.languages[label]
            if out and out[-1][0] == name:
                out[-1] = (name, out[-1][1], end)
            else:
                out.append((name, start, end))
        return out

    def predict(self, texts: Iterator[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        if not self.model.languages:
            names = [UNKNOWN for _ in texts]
            return names, [0.0] * len(names)
        waiting, held = [], 0

        def flush():
            if not waiting:
                return
            labels, letters, all_letters = self._chunk(waiting)
            begins = np.cumsum([0, *map(len, waiting)])
            text = np.repeat(np.arange(len(waiting)), np.diff(begins))
            k = len(self.model.languages)
            own = np.bincount(text * k + labels, letters, len(waiting) * k).reshape(len(waiting), k)
            total = np.bincount(text, all_letters, len(waiting))
            for row, n in zip(own, total, strict=True):
                best = int(row.argmax())
                names.append(self.model.languages[best] if n else UNKNOWN)
                scores.append(float(min(1.0, row[best] / n)) if n else 0.0)

        for text in texts:
            words = words_of(text)
            if held + len(words) > self.chunk:
                flush()
                waiting, held = [], 0
            waiting.append(words)
            held += len(words)
        flush()
        return names, scores


def train(docs: DataFrame, texts: int = TEXTS, words: int = WORDS) -> LanguageModel:
    """The model of the labelled ``docs`` (text, lang); rows without a language are ignored."""
    known = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter("lang is not null and text is not null")
    hashed = F.xxhash64("text", F.lit(11))
    distinct = known.groupBy("lang", hashed.alias("h")).agg(F.count("*").alias("n"))
    frequent = distinct.groupBy("lang").agg(F.sum("n").alias("rows"), F.count("*").alias("texts")).orderBy(F.desc("rows"), "lang").collect()
    if not frequent:
        return LanguageModel()
    grain = 1 << 30
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(grain, int(grain * texts / r["texts"]) + 1)) for r in frequent], "lang string, share long")
    picked = F.pmod(hashed, F.lit(grain)) < F.col("share")
    sample = known.join(F.broadcast(shares), "lang").filter(picked).select("text", "lang").distinct()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                found, n = np.unique(np.array(words_of(text.as_py()), object), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found.tolist(), pa.string()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])

    totals = sample.mapInArrow(counted, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    top = stored(totals.withColumn("nth", nth).filter(F.col("nth") <= words).select("lang", "word", "n"), "words").toArrow()
    counts = sorted(zip(*(top.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True))
    return learn(counts, [r["lang"] for r in frequent])


def predictor(model: LanguageModel):
    """A column function: struct of lang and score of a text."""

    @F.arrow_udf("lang string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Labeller(model)
        for texts in batches:
            names, scores = own.predict(t.as_py() for t in texts)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["lang", "score"])

    return predict
