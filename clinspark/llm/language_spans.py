"""Language of texts and of spans inside them: scripts narrow the candidates, word scores and a switching penalty decide.

Each word has a log-probability under the letter sequences of every learned language.  The scripts of its letters leave
only languages in whose training text that script is common.  Viterbi over the words of a text, with a penalty for every change of
language, labels each word; the language with most letters is that of the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.workers import map_arrow, map_pandas

#: First and last code point of the ranges in which a script's letters lie.
SCRIPT_RANGES = {
    "latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0xAA), (0xBA, 0xBA), (0xC0, 0x24F), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x531, 0x58F)],
    "hebrew": [(0x590, 0x5FF), (0xFB1D, 0xFB4F)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF), (0x31F0, 0x31FF)],
    "han": [(0x2E80, 0x2FDF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3134F)],
}
_STARTS, _ENDS, _SCRIPTS = np.array(sorted((lo, hi, i) for i, ranges in enumerate(SCRIPT_RANGES.values()) for lo, hi in ranges)).T
OTHER_SCRIPT = len(SCRIPT_RANGES)
_NO_LETTER = re.compile(r"[^\w\n]+|[\d_]+")
#: Hashed letter sequences of one to three letters.
FEATURES = 1 << 15
#: Texts of each language that a model is learned from, about, at most.
PER_LANG = 500
#: A worker remembers the scores of so many words.
CACHE = 300_000
UNDETERMINED = "und"
#: A language fits down to ``FIT_BELOW + FIT_FEW / sqrt(places)`` under its learned texts, in natural logarithms a place.
FIT_BELOW = 2.5
FIT_FEW = 30.0


def scripts_of(points: np.ndarray) -> np.ndarray:
    """The number of the script of each code point."""
    at = np.maximum(np.searchsorted(_STARTS, points, "right") - 1, 0)
    inside = (points >= _STARTS[at]) & (points <= _ENDS[at])
    return np.where(inside, _SCRIPTS[at], OTHER_SCRIPT)


def letters_of(words: list[str]) -> list[str]:
    """The letters of each word, in lower case."""
    found = _NO_LETTER.sub("", "\n".join(words).lower()).split("\n")
    return [w if w.isalpha() or not w else "".join(c for c in w if c.isalpha()) for w in found]


def _features(letters: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For words of letters: the features of every place (place x 3, ``FEATURES`` where there is none), the code points, and the first place of
    each word.  A word's places are its letters and the gap behind it; a place stands for the one, the two and the three letters that end
    there, just behind, and one later."""
    points = np.frombuffer(f" {' '.join(letters)} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    before, here, after = points[:-1], points[1:], np.append(points[2:], np.uint64(32))

    def hashed(*parts: np.ndarray) -> np.ndarray:
        h = np.full(len(here), len(parts), np.uint64)
        for part in parts:
            h = (h + part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h % np.uint64(FEATURES)).astype(np.int64)

    gap, whole = here == 32, before == 32
    single = np.where(gap, FEATURES, hashed(here))
    double = np.where(gap & whole, FEATURES, hashed(before, here))
    triple = np.where(gap, FEATURES, hashed(before, here, after))
    ends = np.flatnonzero(gap)
    return np.stack([single, double, triple], axis=1), here, np.concatenate(([0], ends[:-1] + 1))


class Model:
    """Learned languages, log-probabilities of features (features x languages) and the scripts each language uses; ``level`` is the mean
    log-probability of a place in the texts each language was learned from."""

    def __init__(self, langs: list[str], logs: np.ndarray, scripts: np.ndarray, prior: np.ndarray, level: np.ndarray | None = None):
        self.langs, self.prior = langs, prior
        self.level = np.zeros(len(langs)) if level is None else level
        self.logs = np.vstack([logs, np.zeros((1, len(langs)))]).astype(np.float32)
        self.unused = np.array([sum(1 << i for i, used in enumerate(row) if not used) for row in scripts], np.int64)

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(words x languages, letters)``; the best language of a word has score 0, and so has each of a word without letters."""
        return self.word_fits(words)[:2]

    def word_fits(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As :meth:`word_scores`, then the log-probability of each word in its best language, which its scores are relative to, and its
        letters in scripts that some language uses."""
        letters = letters_of(words)
        places, points, first = _features(letters)
        totals = np.add.reduceat(self.logs[places].sum(axis=1), first, axis=0)
        scripts = 1 << scripts_of(points)
        used = np.bitwise_or.reduceat(np.where(points == 32, 0, scripts), first)
        barred = (used[:, None] & self.unused[None, :]) != 0
        # a word in scripts that no language uses together leaves all of them
        barred &= ~barred.all(axis=1, keepdims=True)
        totals = np.where(barred, totals.min(axis=1, keepdims=True) - 20, totals)
        peaks = totals.max(axis=1, keepdims=True)
        totals -= peaks
        lengths = np.fromiter(map(len, letters), np.int64, len(letters))
        totals[lengths == 0] = 0
        nowhere = np.bitwise_and.reduce(self.unused)
        known = np.add.reduceat((points != 32) & ((scripts & nowhere) == 0), first, dtype=np.int64)
        return totals, lengths, np.where(lengths == 0, 0, peaks[:, 0]), known


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int = PER_LANG, script_share: float = 0.01) -> Model:
    """A model of the labelled rows of ``docs``, from about ``per_lang`` texts of each language at most: those with the
    smallest checksums of their ids.  The counts, features x languages, are added up on the executors."""
    rows = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.crc32(F.col(id_col).cast("string").cast("binary")).alias("mark")).filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((FEATURES, 0)), np.zeros((0, OTHER_SCRIPT + 1), bool), np.zeros(0))
    # a checksum is spread evenly, so a bound on it takes about ``per_lang`` texts; all of them where there are fewer
    bounds = {k: int(min(1.0, per_lang / n) * 2**32) for k, n in sizes.items()}
    bound = F.element_at(F.create_map(*(F.lit(x) for pair in bounds.items() for x in pair)), F.col("lang"))
    sample = rows.filter(F.coalesce("mark", F.lit(0)) < bound).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                words.setdefault(lang, Counter()).update(text.split())
        for lang, found in words.items():
            places, points, first = _features(letters_of(list(found)))
            times = np.repeat(list(found.values()), np.diff(first, append=len(points)))
            sums = np.bincount(places.ravel(), np.repeat(times, 3), FEATURES + 1)[:FEATURES]
            letters = np.bincount(scripts_of(points), np.where(points == 32, 0, times), OTHER_SCRIPT + 1)
            gaps = times[points == 32].sum() - sum(n for n, w in zip(found.values(), np.diff(first, append=len(points)), strict=True) if w == 1)
            sums = np.concatenate([sums, letters, [gaps]]).astype(np.int64)
            at = np.flatnonzero(sums)
            yield pd.DataFrame({"lang": lang, "at": at, "n": sums[at]})

    langs = sorted(sizes)
    total = np.zeros((FEATURES + OTHER_SCRIPT + 2, len(langs)))
    for r in map_pandas(sample, count, "lang string, at int, n long").groupBy("lang", "at").agg(F.sum("n").alias("n")).collect():
        total[r["at"], langs.index(r["lang"])] = r["n"]
    counts, letters, ends = total[:FEATURES], total[FEATURES:-1], total[-1]
    logs = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * FEATURES))
    share = letters / np.maximum(letters.sum(axis=0), 1)
    prior = np.log([sizes[x] / sum(sizes.values()) for x in langs])
    # the row of gaps counts the ends of words, where a place has no script
    places = np.maximum(ends + letters.sum(axis=0), 1)
    return Model(langs, logs, (share >= script_share).T, prior, (counts * logs).sum(axis=0) / places)


def best_paths(scores: np.ndarray, lengths: np.ndarray, prior: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of every word, texts one after the other; ``scores`` has words x languages, each text one word or more.

    Texts advance together, word by word, the longest first."""
    order = np.argsort(-lengths, kind="stable")
    starts, sizes = (np.cumsum(lengths) - lengths)[order], lengths[order]
    alive = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), "right")
    best = scores[starts] + prior
    stay = np.ones(scores.shape, bool)  # whether the best path to this language came from the same one
    jump = np.zeros(len(scores), np.int32)  # and else from which
    for t in range(1, int(sizes[0])):
        n = alive[t]
        at, now = starts[:n] + t, best[:n]
        other = now.max(axis=1, keepdims=True) - penalty
        stay[at] = now >= other
        jump[at] = now.argmax(axis=1)
        best[:n] = np.maximum(now, other) + scores[at]
    path = np.empty(len(scores), np.int32)
    current = best.argmax(axis=1)
    for t in range(int(sizes[0]) - 1, -1, -1):
        n = alive[t]
        at, now = starts[:n] + t, current[:n]
        path[at] = now
        if t:
            current[:n] = np.where(stay[at, now], now, jump[at])
    return path


class Labeller:
    """Labels texts with a model, and remembers the scores of words."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.langs)), np.float32)
        self.letters = np.zeros(0, np.int64)
        self.peaks, self.known = np.zeros(0), np.zeros(0, np.int64)

    def _words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all words, and how many each text has."""
        words = [(t or "").split() for t in texts]
        new = list(set(chain.from_iterable(words)).difference(self.index))
        if new:
            scores, letters, peaks, known = self.model.word_fits(new)
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
            self.peaks, self.known = np.concatenate([self.peaks, peaks]), np.concatenate([self.known, known])
        lengths = np.array([len(w) for w in words], np.int64)
        return np.fromiter(map(self.index.__getitem__, chain.from_iterable(words)), np.int64, lengths.sum()), lengths

    def label(self, texts: list[str | None], fits: bool = False) -> list[tuple]:
        """``(language, score, spans)`` of each text; a span is a language and its first and last word.

        With ``fits`` three more of each: the fit, the share of letters in scripts that some language uses, and the largest share of such
        letters in spans of one language that fits.  A place is a letter or the end of a word.  The fit is the mean log-probability of a
        place in the language of its span, less the mean in the texts which that language was learned from: about 0 for these.  A
        language fits where the same mean over its spans is at most ``FIT_BELOW`` under 0, and on few places more, as chance has it."""
        made: list[tuple] = [(UNDETERMINED, 0.0, [], 0.0, 0.0, 0.0) if fits else (UNDETERMINED, 0.0, [])] * len(texts)
        langs = self.model.langs
        if not langs:
            return made
        if len(self.index) > CACHE:
            self.forget()
        # word lists are made for a few texts at a time; their numbers take less room
        parts = [self._words(texts[at : at + 256]) for at in range(0, len(texts), 256)]
        rows, lengths = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        starts = np.cumsum(lengths) - lengths
        order = [int(i) for i in np.argsort(-lengths, kind="stable") if lengths[i] and self.letters[rows[starts[i] : starts[i] + lengths[i]]].any()]
        at = 0
        while at < len(order):
            # texts of similar length, as many as hold about 250,000 words
            some = order[at : at + max(1, 250_000 // int(lengths[order[at]]))]
            at += len(some)
            own = [rows[starts[i] : starts[i] + lengths[i]] for i in some]
            paths = best_paths(self.scores[np.concatenate(own)], lengths[some], self.model.prior, self.penalty)
            ends = np.cumsum(lengths[some])
            for i, words, path in zip(some, own, np.split(paths, ends[:-1]), strict=True):
                weight = np.bincount(path, self.letters[words], len(langs))
                cut = np.flatnonzero(np.diff(path))
                begins, lasts = [0, *(cut + 1).tolist()], [*cut.tolist(), len(path) - 1]
                spans = [(langs[path[a]], a, b) for a, b in zip(begins, lasts, strict=True)]
                made[i] = (langs[int(weight.argmax())], float(weight.max() / weight.sum()), spans, *(self._fits(words, path) if fits else ()))
        return made

    def _fits(self, words: np.ndarray, path: np.ndarray) -> tuple[float, float, float]:
        letters, n = self.letters[words], len(self.model.langs)
        places = np.bincount(path, np.where(letters > 0, letters + 1, 0), n)
        known = np.bincount(path, self.known[words], n)
        over = np.bincount(path, self.peaks[words] + self.scores[words, path], n) - places * self.model.level
        fine = over >= -(FIT_BELOW * places + FIT_FEW * np.sqrt(places))
        return float(over.sum() / places.sum()), float(known.sum() / letters.sum()), float((known * fine).max() / letters.sum())


def language_spans(docs: DataFrame, model: Model, text_col: str = "text", penalty: float = 8.0, added: tuple[str, ...] = ("lang_pred", "score", "spans"), fits: tuple[str, ...] = ()) -> DataFrame:
    """``docs`` with the language, its score (the share of letters in spans of that language) and the spans added, under
    the names in ``added``; two names leave out the spans.  The score compares the learned languages with each other and says nothing of
    others; three names in ``fits`` add the fit, the share of letters in known scripts and the largest share of a language that fits
    (:meth:`Labeller.label`).

    A span is a language and the numbers of its first and last word, words being what white space separates.  A null text, or one
    without a letter, is ``und`` with score 0 and no spans; so is every text if no language was learned.  Texts are read whole.
    Added columns replace others of their names, and all other columns stay."""
    with_spans = len(added) == 3
    names = [c for c in docs.columns if c not in added and c not in fits]
    fields = [docs.schema[c].dataType.simpleString() for c in names]
    span = pa.list_(pa.struct([("lang", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(model, penalty)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):  # together at most so many texts, which may be long
                some = batch.slice(at, 4096)
                found = labeller.label(some.column("_text").to_pylist(), bool(fits))
                made = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
                if with_spans:
                    made.append(pa.array([[{"lang": a, "first": b, "last": c} for a, b, c in f[2]] for f in found], span))
                made += [pa.array([f[3 + i] for f in found], pa.float64()) for i in range(len(fits))]
                kept = [some.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=[*(f"_{i}" for i in range(len(names))), *added, *fits])

    kinds = ["string", "double", *(["array<struct<lang:string,first:int,last:int>>"] if with_spans else []), *(["double"] * len(fits))]
    rows = docs.select(*(F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(names)), F.col(text_col).alias("_text"))
    schema = ", ".join([*(f"_{i} {k}" for i, k in enumerate(fields)), *(f"{a} {k}" for a, k in zip([*added, *fits], kinds, strict=True))])
    return map_arrow(rows, work, schema).select(*(F.col(f"_{i}").alias(c) for i, c in enumerate(names)), *added, *fits)
