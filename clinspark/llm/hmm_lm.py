"""A hidden Markov language model over words: Baum-Welch on all training texts, exact likelihoods by the forward recursion.

States emit symbols.  The most frequent words are symbols of their own; each other word belongs to a class by its last two bytes and
is drawn within the class in proportion to its count plus one, with one share left for words never seen.  So tables of
bounded size go to the tasks, yet every word has its exact count: frequent ones from a table of bounded length, the rest by a join.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored
from clinspark.llm.workers import map_arrow

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Stands for the end of a text among the words; no word holds a space.
END = b" "
#: Words that are symbols, words whose counts go to every task, classes of other words.
SYMBOLS, HEAD, CLASSES = 8192, 1 << 17, 128
#: Words that a task counts before it hands them on.
FLUSH = 500_000
#: Training cuts longer texts into sequences of so many symbols; scoring never does.
TRAIN_LENGTH = 256
#: Tokens of the texts with which a state begins, and how many texts are looked at for that, for each state.
SEED_TOKENS, SEED_TEXTS = 50, 64


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``(w, n)``: how often each word occurs, and the end of a text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def handed() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], names=["w", "n"])
            found.clear()
            return made

        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update(words_of(text))
            found[END] += batch.num_rows
            if len(found) > FLUSH:
                yield handed()
        if found:
            yield handed()

    return map_arrow(docs.select(F.col(text_col).alias("text")), work, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Exact counts of the head of the vocabulary, and sums for the rest."""

    counts: DataFrame  # (w, n) of every word
    total: int
    distinct: int
    head: list[bytes]  # by falling count; the first ``symbols`` are symbols, one of them the end if any text was seen
    head_counts: np.ndarray
    symbols: int
    class_tokens: np.ndarray
    class_words: np.ndarray

    @property
    def size(self) -> int:
        return self.symbols + CLASSES

    @property
    def class_logs(self) -> np.ndarray:
        """log10 of what a word's count plus one is divided by in its class."""
        return np.log10(self.class_tokens + self.class_words + 1)


class _Index(dict):
    """Numbers of words, -1 for others."""

    def __missing__(self, word: bytes) -> int:
        return -1


def class_of(word: bytes) -> int:
    return zlib.crc32(word[-2:]) % CLASSES


def _class_column(word: str) -> Column:
    return (F.crc32(F.substring(F.col(word), -2, 2)) % CLASSES).cast("int")


def vocabulary(train: DataFrame, text_col: str = "text", symbols: int = SYMBOLS, head: int = HEAD) -> Vocabulary:
    counts = stored(count_words(train, text_col), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # steps of falling counts, some 4,000 at most, tell down to which one the head reaches; so only the head itself is collected
    step = F.when(F.col("n") < 1000, F.col("n")).otherwise(F.floor(1000 + 64 * F.log2(F.col("n") / 1000))).cast("long")
    steps = counts.groupBy(step.alias("s")).count().collect()
    room, least = head - 1, 0
    for r in sorted(steps, key=lambda r: -r["s"]):
        room -= r["count"]
        if room < 0:
            least = r["s"] + 1
            break
    # the end is a symbol however rare it is
    top = counts.filter((step >= least) | (F.col("w") == F.lit(END))).collect()
    top.sort(key=lambda r: (bytes(r["w"]) != END, -r["n"], bytes(r["w"])))
    listed = [bytes(r["w"]) for r in top]
    own = min(symbols, len(listed))
    sums = counts.withColumn("c", _class_column("w")).groupBy("c").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).collect()
    tokens, kinds = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in sums:
        tokens[r["c"]], kinds[r["c"]] = r["n"], r["k"]
    head_counts = np.array([r["n"] for r in top], dtype=np.float64)
    for w, n in zip(listed[:own], head_counts[:own], strict=True):
        tokens[class_of(w)] -= n
        kinds[class_of(w)] -= 1
    return Vocabulary(counts, total, distinct, listed, head_counts, own, tokens, kinds)


def encoded(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """A row for each of ``docs`` (``id``, ``train``, ``text``): its symbols, sums over words of the head, and the other words with
    their numbers.

    ``base``: sum of log10(count + 1); ``own``: the same for words drawn from a class; ``rest``: sum of the
    divisors' log10 of all words drawn from a class; ``known``: tokens seen in training, so far."""
    n_own, class_logs = vocab.symbols, vocab.class_logs
    index = _Index(zip(vocab.head, range(len(vocab.head)), strict=True))
    symbol = np.concatenate([np.arange(n_own), [n_own + class_of(w) for w in vocab.head[n_own:]], [0]]).astype(np.int16)
    logs = np.append(np.log10(vocab.head_counts + 1), 0.0)
    drawn = np.append(np.arange(len(vocab.head)) >= n_own, False)

    def lists(parts: list, lengths: list[int], kind: pa.DataType) -> pa.Array:
        return pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(lengths))).astype(np.int32), pa.array(parts, kind))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1000):
                some = batch.slice(begin, 1000)
                made, rows, others, times, sizes = [], [], [], [], []
                for text in some.column("text").to_pylist():
                    words = words_of(text)
                    words.append(END)
                    at = np.fromiter(map(index.__getitem__, words), np.int32, len(words))
                    symbols, lacking = symbol[at], np.flatnonzero(at < 0)
                    missing = [words[i] for i in lacking.tolist()]
                    other, rest = Counter(missing), 0.0
                    if missing:
                        classes = np.array([class_of(w) for w in missing])
                        symbols[lacking] = n_own + classes
                        rest = class_logs[classes].sum()
                    inside = at[drawn[at]]
                    rest += class_logs[symbol[inside] - n_own].sum()
                    made.append(symbols)
                    rows.append((len(words), len(words) - len(lacking), logs[at].sum(), logs[inside].sum(), rest))
                    others += other
                    times += other.values()
                    sizes.append(len(other))
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
                sums = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(some.column(c) for c in ("rid", "id", "train")), lists(np.concatenate(made), [len(m) for m in made], pa.int16()),
                        *sums, lists(others, sizes, pa.binary()), lists(times, sizes, pa.int32()),
                    ],
                    names=["rid", "id", "train", "symbols", "n_tokens", "known", "base", "own", "rest", "other", "times"],
                )

    kind = docs.schema["id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "id", "train", "text")
    schema = f"rid long, id {kind}, train boolean, symbols array<smallint>, n_tokens long, known long, base double, own double, rest double, other array<binary>, times array<int>"
    return map_arrow(rows, work, schema)


@dataclass
class Hmm:
    start: np.ndarray  # states
    occupied: np.ndarray  # states: how likely each is within a text
    moves: np.ndarray  # states x states
    emits: np.ndarray  # states x symbols


def _sequences(batch: pa.RecordBatch, longest: int | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(rows, alive, symbols, first)`` in groups of sequences of similar length, the longest first.

    ``symbols`` holds the first symbols of all sequences of the group, then the second ones, and so on; ``alive`` tells how many sequences
    there are at each step, ``rows`` the text of each and ``first`` whether it begins its text."""
    column = batch.column("symbols")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
    begins = np.concatenate(([0], ends[:-1]))
    rows = np.arange(len(ends))
    first = np.ones(len(ends), bool)
    if longest:
        n = -(-(ends - begins) // longest)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        rows, begins, ends = np.repeat(rows, n), np.repeat(begins, n) + nth * longest, np.repeat(ends, n)
        ends, first = np.minimum(begins + longest, ends), nth == 0
    order = np.argsort(begins - ends, kind="stable")
    lengths = (ends - begins)[order]
    at = 0
    while at < len(order):
        # as many sequences as hold about 250,000 symbols
        some = order[at : at + max(1, min(2048, 250_000 // int(lengths[at])))]
        at += len(some)
        size = (ends - begins)[some]
        alive = np.searchsorted(-size, -np.arange(1, size[0] + 1), "right")
        step = np.repeat(np.arange(size[0]), alive)
        nth = np.arange(len(step)) - np.repeat(np.cumsum(alive) - alive, alive)
        yield rows[some], alive, flat[begins[some][nth] + step].astype(np.int64), first[some]


def _forward(hmm: Hmm, alive: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each step its range of places, the scaled forward probabilities there and their scales."""
    emits = np.ascontiguousarray(hmm.emits.T)
    now = np.where(first[:, None], hmm.start, hmm.occupied)
    begin = 0
    for t, n in enumerate(alive.tolist()):
        now = (now[:n] @ hmm.moves if t else now) * emits[symbols[begin : begin + n]]
        total = now.sum(axis=1)
        now /= total[:, None]
        yield begin, begin + n, now, total
        begin += n


def _expected(hmm: Hmm, alive: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Expected starts, visits, moves and emissions of some sequences."""
    states, size = hmm.emits.shape
    alpha, later = np.empty((len(symbols), states)), np.empty((len(symbols), states))
    for begin, end, now, total in _forward(hmm, alive, symbols, first):
        alpha[begin:end] = now
        later[begin:end] = total[:, None]
    np.divide(np.ascontiguousarray(hmm.emits.T)[symbols], later, out=later)  # what a place emits, scaled
    beta, moves = np.ones_like(alpha), np.zeros((states, states))
    ends = np.cumsum(alive)
    back = np.ascontiguousarray(hmm.moves.T)
    for t in range(len(alive) - 1, 0, -1):
        begin, end = ends[t - 1], ends[t]
        before = begin - alive[t - 1]
        n = end - begin
        after = later[begin:end] * beta[begin:end]
        moves += alpha[before : before + n].T @ after
        np.matmul(after, back, out=beta[before : before + n])
    alpha *= beta  # the probability of each state at each place
    emits = np.stack([np.bincount(symbols, alpha[:, k], size) for k in range(states)])
    return alpha[: alive[0]][first].sum(axis=0), alpha.sum(axis=0), hmm.moves * moves, emits


def first_emissions(texts: DataFrame, size: int, symbol_share: np.ndarray, states: int) -> np.ndarray:
    """What each state emits at first: half the symbols of some texts of its own, half those of all.

    Texts are taken in the order of a hash of their symbols, equal ones once, so that the choice depends on what the texts hold and not on where
    they lie.  A state takes texts until they have ``SEED_TOKENS`` tokens, one if it is that long and several if texts are short; where
    too few are left, its symbols are weighed by a hash instead, as equal states would stay equal.  Of the texts only
    their lengths and the number of each symbol reach the driver."""
    hashed = texts.select(F.xxhash64("symbols").alias("h"), "n_tokens", "symbols")
    chosen = hashed.select("h").distinct().orderBy("h").limit(states * SEED_TEXTS)
    # a table of bounded length, that of limit()
    some = stored(hashed.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["h"]), "seed-texts")
    taken, state, held = {}, 0, 0
    for r in some.select("h", "n_tokens").orderBy("h").collect():
        if state < states:
            taken[r["h"]] = state
            held += r["n_tokens"]
            if held >= SEED_TOKENS:
                state, held = state + 1, 0
    emits = np.tile(symbol_share, (states, 1))
    found = np.zeros((states, size))
    if taken:
        named = texts.sparkSession.createDataFrame(list(taken.items()), "h long, state int")
        counts = some.join(F.broadcast(named), "h").select("state", F.explode("symbols").alias("symbol")).groupBy("state", "symbol").count()
        for r in counts.collect():
            found[r["state"], r["symbol"]] = r["count"]
    for k in range(states):
        if found[k].any():
            emits[k] = 0.5 * emits[k] + 0.5 * found[k] / found[k].sum()
        if k >= state:
            weight = np.array([zlib.crc32(f"{k} {i}".encode()) % 1024 for i in range(size)]) + 512
            emits[k] = emits[k] * weight / (emits[k] * weight).sum()
    return emits


def baum_welch(texts: DataFrame, size: int, symbol_share: np.ndarray, states: int = 8, rounds: int = 5, weight: float = 50.0) -> Hmm:
    """A model learned from ``symbols`` of all rows of ``texts``.

    Every task adds up what it expects of its texts, Spark adds up the tasks, and states x symbols numbers reach the
    driver each round.  Every state begins with the symbols of texts of its own (see :func:`first_emissions`).
    ``weight`` symbols, shared out as in all texts, are added to what each state emits, so that it can emit any."""
    emits = first_emissions(texts, size, symbol_share, states)
    moves = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(moves, 0.9 if states > 1 else 1.0)
    hmm = Hmm(np.full(states, 1 / states), np.full(states, 1 / states), moves, emits)
    for _ in range(rounds):
        here = hmm

        def work(batches: Iterator[pa.RecordBatch], here: Hmm = here) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(states), np.zeros(states), np.zeros((states, states)), np.zeros((states, size))]
            for batch in batches:
                for _, alive, symbols, first in _sequences(batch, TRAIN_LENGTH):
                    for total, part in zip(sums, _expected(here, alive, symbols, first), strict=True):
                        total += part
            flat = np.concatenate([s.ravel() for s in sums])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(flat[at])], names=["at", "v"])

        flat = np.zeros(2 * states + states * states + states * size)
        summed = map_arrow(texts.select("symbols"), work, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        flat[summed.column("at").to_numpy()] = summed.column("v").to_numpy()
        start, seen, moved, emitted = np.split(flat, np.cumsum([states, states, states * states]))
        if not seen.any():
            break
        start, seen, moved = start + 1, seen + 1, moved.reshape(states, states) + 1
        emitted = emitted.reshape(states, size) + weight * symbol_share
        hmm = Hmm(start / start.sum(), seen / seen.sum(), moved / moved.sum(axis=1, keepdims=True), emitted / emitted.sum(axis=1, keepdims=True))
    return hmm


def _likelihoods(texts: DataFrame, hmm: Hmm) -> DataFrame:
    """``texts`` with ``forward``, the log10 probability of the symbols, in place of ``symbols``."""
    names = [c for c in texts.columns if c != "symbols"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows)
            for rows, alive, symbols, first in _sequences(batch, None):
                for _, _, _, total in _forward(hmm, alive, symbols, first):
                    found[rows[: len(total)]] += np.log10(total)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found)], names=[*names, "forward"])

    schema = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names)
    return map_arrow(texts, work, f"{schema}, forward double")


def scored(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", states: int = 8, rounds: int = 5, symbols: int = SYMBOLS, head: int = HEAD) -> DataFrame:
    """``(id, n_tokens, n_known, train_tokens, base_score, score)`` for every row of ``docs``, learned from those where ``train``, a condition on
    ``id_col``, is true.

    ``base_score`` is the log10 probability under the words' counts plus one; ``score`` that under the model.  Null and
    empty texts have the end alone.  Rows that repeat an id or a text are rows of their own.  If nothing can be learned, every
    word counts as unseen.  An empty table gives an empty table; other columns are not read.  Scores depend on what the rows hold and not on
    how they are dealt to partitions, but for the last digits of sums."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    vocab = vocabulary(docs.filter("train"), "text", symbols, head)
    texts = stored(encoded(docs, vocab), "encoded-texts")
    share = np.concatenate([vocab.head_counts[: vocab.symbols] + 1, vocab.class_tokens + 1])
    hmm = baum_welch(texts.filter("train"), vocab.size, share / share.sum(), states, rounds)
    each = texts.select("rid", F.explode(F.arrays_zip("other", "times")).alias("o")).select("rid", F.col("o.other").alias("w"), F.col("o.times").alias("times"))
    tails = (
        each.join(vocab.counts, "w").groupBy("rid")
        .agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("tail"), F.sum("times").alias("tail_known"))
    )
    forward = _likelihoods(texts.drop("other", "times"), hmm)
    tail = F.coalesce("tail", F.lit(0.0))
    divisor = float(np.log10(vocab.total + vocab.distinct + 1))
    return forward.join(tails, "rid", "left").select(
        "id", "n_tokens", (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"), F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + tail - F.col("n_tokens") * F.lit(divisor)).alias("base_score"),
        (F.col("forward") + F.col("own") + tail - F.col("rest")).alias("score"),
    )
