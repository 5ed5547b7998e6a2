"""Byte passages that occur more than once anywhere in a corpus, found with suffix arrays.

A passage is a string of ``window`` bytes.  Every window is assigned to the smallest hash among its ``gram``-byte strings;
equal windows have equal strings and so the same key, and consecutive windows of a text mostly share one, so
a text falls into runs of windows.  Runs are counted by key and by content first: a key that occurs once is done,
and so is a content that occurs alone or alone twice.  What remains, different contents under one key, is
joined to texts of about a megabyte that hold whole keys, and each is sorted as a suffix array in two stages.  A key with more
contents than one task should hold is cut again by longer strings, in the end by whole windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored
from clinspark.llm.workers import map_pandas

WINDOW = 400
#: Lengths of the strings that give the keys, one for each level of hot keys.  The last must be the window.
GRAMS = (100, 300, 400)
#: Contents of one key that a task sorts at most, and windows of one run.
KEY_LIMIT, RUN_LIMIT = 4096, 4096
#: Bytes that are sorted at a time, if one key has no more; windows that are cut at a time.
SORT_BYTES, CHUNK = 1 << 20, 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_LOW = np.uint64((1 << 20) - 1)


# ---------------------------------------------------------------- runs of windows


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    for powers, base in ((up, _BASE), (down, inverse)):
        powers[0] = 1
        done = 1
        while done < n:  # powers[done:] from powers[:done]
            step = min(done, n - done)
            powers[done : done + step] = powers[:step] * np.uint64(pow(base, done, 1 << 64))
            done += step
    return up, down


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every ``gram`` consecutive bytes."""
    up, down = _powers(max(1 << 20, 1 << len(data).bit_length()))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    if width == 1:
        return values
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def runs(data: bytes, window: int, gram: int) -> Iterator[tuple[int, int, int, bool]]:
    """``(first, windows, key, several)`` for every run of windows of one key, of at most ``RUN_LIMIT`` windows.

    ``several``: the key's string stands at more than one place of the run, so the run may repeat itself."""
    total = len(data) - window + 1
    for begin in range(0, max(total, 0), CHUNK):
        count = min(CHUNK, total - begin)
        octets = np.frombuffer(data, np.uint8, count + window - 1, begin)
        hashes = _gram_hashes(octets, gram)
        ranked = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
        place = (_sliding_min(ranked, window - gram + 1) & _LOW).astype(np.int64)
        key = hashes[place]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(first, append=count)
        if (size > RUN_LIMIT).any():
            pieces = [np.arange(a, a + n, RUN_LIMIT) for a, n in zip(first, size, strict=True)]
            first = np.concatenate(pieces)
            size = np.diff(first, append=count)
        several = place[first] != place[first + size - 1]
        yield from zip((first + begin).tolist(), size.tolist(), key[first].view(np.int64).tolist(), several.tolist(), strict=True)


def _cut(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """``(t, p, m, key, c1, c2, several)`` for the runs of ``texts`` (``t``, ``data``); ``c1``, ``c2`` digest the content."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, digests = [], []
            for t, data in zip(batch["t"], batch["data"], strict=True):
                for p, m, key, several in runs(data, window, gram):
                    rows.append((t, p, m, key, several))
                    digests.append(hashlib.blake2b(data[p : p + m + window - 1], digest_size=16).digest())
            if rows:
                made = pd.DataFrame(rows, columns=["t", "p", "m", "key", "several"])
                both = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield made.assign(c1=both[:, 0], c2=both[:, 1])[["t", "p", "m", "key", "c1", "c2", "several"]]

    schema = "t string, p long, m int, key long, c1 long, c2 long, several boolean"
    return map_pandas(texts.select("t", "data"), work, schema)


# ---------------------------------------------------------------- suffix array in two stages


def _sort_rising(codes: np.ndarray, rising: np.ndarray, depth: int) -> np.ndarray:
    """The places in ``rising``, those of suffixes smaller than their successors, sorted by the suffix, to ``depth`` at least.

    The strings between neighbouring places are named in order; pairs of names are then sorted with doubled reach."""
    buffer, ends = codes.tobytes(), np.append(rising[1:] + 1, len(codes))
    pieces = [buffer[a:b] for a, b in zip(rising.tolist(), ends.tolist(), strict=True)]
    # where one piece is the start of another, its last place rises and the other's falls there: it is the greater one
    names = {s: i for i, s in enumerate(sorted(set(pieces), key=lambda s: s + b"\xff"))}
    rank = np.fromiter((names[s] for s in pieces), np.int64, len(pieces))
    step, n = 1, len(rising)
    while True:
        follow = np.zeros(n, np.int64)
        follow[: max(n - step, 0)] = rank[step:] + 1
        pair = rank * (int(rank.max()) + 2) + follow
        order = np.argsort(pair)
        ahead = pair[order]
        new = np.concatenate(([0], np.cumsum(ahead[1:] != ahead[:-1])))
        rank = np.empty(n, np.int64)
        rank[order] = new
        step *= 2
        if new[-1] == n - 1:
            return rising[order]
        reach = np.append(rising, [len(codes)] * step)[step : step + n] - rising
        tied = np.flatnonzero(new[1:] == new[:-1])
        if (reach[order[tied]] >= depth).all():
            return rising[order]


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes of ``codes`` (unsigned bytes that end with a 0, the smallest), in the order of their first
    ``depth`` codes.

    Only suffixes smaller than their successors are sorted.  A scan over the buckets of first codes induces
    the others: the suffix before each sorted one joins its own bucket next, if it falls."""
    n = len(codes)
    differ = np.flatnonzero(codes[1:] != codes[:-1])
    turn = np.append(differ, n - 1)[np.searchsorted(differ, np.arange(n))]
    after = np.append(codes, 0)
    rises = codes[turn] < after[turn + 1]
    rises[n - 1] = False
    rising = np.flatnonzero(rises)
    sorted_rising = _sort_rising(codes, rising, depth) if len(rising) else rising
    heads = codes[sorted_rising]
    waiting: dict[int, list[np.ndarray]] = {int(codes[n - 1]): [np.array([n - 1])]}
    out = []
    for c in np.unique(codes).tolist():
        current = np.concatenate(waiting.pop(c)) if c in waiting else np.empty(0, np.int64)
        falling = [current]
        while len(current):
            current = current[current > 0] - 1
            current = current[codes[current] == c]
            falling.append(current)
        bucket = np.concatenate([*falling, sorted_rising[np.searchsorted(heads, c) : np.searchsorted(heads, c, "right")]])
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        lead = codes[before]
        before, lead = before[lead > c], lead[lead > c]
        order = np.argsort(lead, kind="stable")
        before, lead = before[order], lead[order]
        if not len(lead):
            continue
        cuts = np.flatnonzero(np.concatenate(([True], lead[1:] != lead[:-1])))
        for a, b in zip(cuts, [*cuts[1:], len(lead)], strict=True):
            waiting.setdefault(int(lead[a]), []).append(before[a:b])
    return np.concatenate(out)


def common_prefixes(codes: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """The common prefix of each suffix in ``order`` with the one before, up to the next 0 and ``depth`` at most."""
    n = len(codes)
    ends = np.flatnonzero(codes == 0)
    room = ends[np.searchsorted(ends, np.arange(n))] - np.arange(n)
    padded = codes.tobytes() + bytes(depth + 16)
    words = np.ndarray((n + depth + 8,), "<u8", padded, strides=(1,))
    a, b = order[:-1], order[1:]
    found = np.minimum(np.minimum(room[a], room[b]), depth)
    active = np.flatnonzero(found)
    for step in range(0, depth, 8):
        differ = words[a[active] + step] ^ words[b[active] + step]
        unequal = differ != 0
        # the number of low zero bytes of the difference is the number of equal codes
        low = differ[unequal] & -differ[unequal]
        at = active[unequal]
        found[at] = np.minimum(found[at], step + (np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3))
        active = active[~unequal]
        active = active[found[active] > step + 8]
        if not len(active):
            break
    return np.concatenate(([0], found))


def repeated_starts(pieces: list[bytes], window: int) -> list[np.ndarray]:
    """For each piece, a UTF-8 string, the starts of windows that occur anywhere else in ``pieces``."""
    lengths = np.array([len(p) for p in pieces])
    codes = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)  # no byte of UTF-8 is 0xff: it becomes 0
    order = suffix_array(codes, window)
    equal = common_prefixes(codes, order, window)[1:] >= window
    marks = np.zeros(len(codes), bool)
    marks[order[:-1][equal]] = True
    marks[order[1:][equal]] = True
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    return [np.flatnonzero(marks[b : b + n]) for b, n in zip(begins, lengths, strict=True)]


def _intervals(starts: np.ndarray) -> list[tuple[int, int]]:
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate(([0], cut + 1))].tolist(), (starts[np.append(cut, len(starts) - 1)] + 1).tolist(), strict=True))


def _sorted_repeats(pieces: DataFrame, window: int) -> DataFrame:
    """``(key, c1, c2, lo, hi)``: ranges of repeated starts in ``pieces`` (``key``, ``c1``, ``c2``, ``piece``)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0

        def done(rows: pd.DataFrame) -> pd.DataFrame:
            out = []
            marks = repeated_starts(rows["piece"].tolist(), window)
            for key, c1, c2, starts in zip(rows["key"], rows["c1"], rows["c2"], marks, strict=True):
                out += [(key, c1, c2, lo, hi) for lo, hi in _intervals(starts)]
            return pd.DataFrame(out, columns=["key", "c1", "c2", "lo", "hi"])

        for batch in batches:
            begin, keys = 0, batch["key"].to_numpy()
            lengths = np.array([len(x) for x in batch["piece"]])
            last = held[-1]["key"].iloc[-1] if held else None
            for i in range(len(batch)):
                if size >= SORT_BYTES and keys[i] != last:
                    held.append(batch.iloc[begin:i])
                    yield done(pd.concat(held))
                    held, size, begin = [], 0, i
                size += lengths[i]
                last = keys[i]
            if begin < len(batch):
                held.append(batch.iloc[begin:])
        if held:
            yield done(pd.concat(held))

    return map_pandas(pieces.select("key", "c1", "c2", "piece").repartition("key").sortWithinPartitions("key"), work, "key long, c1 long, c2 long, lo int, hi int")


# ---------------------------------------------------------------- the distributed search


def _held(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(t, data)`` for the texts in ``wanted``; of copies one row is read, chosen by its ``spread``."""
    rep = texts.groupBy("t").agg(F.min("spread").alias("spread")).join(wanted, "t", "left_semi")
    rep = rep.select(F.col("t").alias("_t"), F.col("spread").alias("_spread"))
    match = (F.col("t") == F.col("_t")) & F.col("spread").eqNullSafe(F.col("_spread"))
    return stored(texts.join(rep, match, "left_semi").select("t", "data"), "texts")


def repeats(texts: DataFrame, window: int = WINDOW, grams: tuple[int, ...] = GRAMS, key_limit: int = KEY_LIMIT) -> tuple[DataFrame, DataFrame]:
    """Ranges ``(t, lo, hi)`` of window starts that occur anywhere else, and ``(t, data)`` of the texts they are in.

    ``texts`` has ``t`` (equal for equal texts), ``data`` and ``spread``, which tells copies apart; each row is a place
    of its own."""
    cut = stored(_cut(texts, window, grams[0]), "runs")
    keys = cut.groupBy("key").agg(F.count(F.lit(1)).alias("_n"), F.max("several").alias("_several")).filter("_n > 1 or _several")
    shared = stored(cut.join(keys.select("key"), "key", "left_semi"), "shared-runs")
    contents = shared.groupBy("key", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("t", "p")).alias("at"), F.first("m").alias("m"), F.max("several").alias("several")
    )
    contents = stored(contents, "contents")
    per_key = contents.groupBy("key").agg(F.count(F.lit(1)).alias("d"), F.max("several").alias("any_several"))
    several = stored(per_key.filter("d > 1 or any_several").select("key", "d"), "mixed-keys")
    texts_held = _held(texts, shared.select("t").distinct())
    pieces = (
        contents.join(several, "key").select("key", "c1", "c2", "d", "m", F.col("at.t").alias("t"), F.col("at.p").alias("p"))
        .join(texts_held, "t")
        .select("key", "c1", "c2", "d", F.expr(f"substring(data, cast(p + 1 as int), m + {window - 1})").alias("piece"))
        .dropDuplicates(["key", "c1", "c2"])
    )
    pieces = stored(pieces, "pieces")
    # at the last level a key is that of a whole window, so its contents are runs of one string's repetitions, at most
    # RUN_LIMIT of them for each period, and all are sorted
    deepest = len(grams) == 1
    found = _sorted_repeats(pieces if deepest else pieces.filter(F.col("d") <= key_limit), window)
    whole = contents.filter("n > 1").select("key", "c1", "c2", F.lit(0).alias("lo"), F.col("m").alias("hi"))
    found = found.unionByName(whole)
    hot = pieces.filter(F.col("d") > key_limit)
    if not deepest and not hot.isEmpty():
        inner = hot.select(F.concat_ws(":", "key", "c1", "c2").alias("t"), F.col("piece").alias("data"), F.lit(None).cast("long").alias("spread"))
        deeper, _ = repeats(inner, window, grams[1:], key_limit)
        part = F.split("t", ":")
        found = found.unionByName(deeper.select(*(part[i].cast("long").alias(c) for i, c in enumerate(("key", "c1", "c2"))), "lo", "hi"))
    places = shared.select("key", "c1", "c2", "t", "p").distinct()
    ranges = stored(found, "repeats").join(places, ["key", "c1", "c2"])
    return ranges.select("t", (F.col("p") + F.col("lo")).cast("int").alias("lo"), (F.col("p") + F.col("hi")).cast("int").alias("hi")), texts_held


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, grams: tuple[int, ...] = GRAMS, key_limit: int = KEY_LIMIT) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``docs``.

    Every byte covered by a string of ``window`` bytes that also starts anywhere else, in any row, is removed; ``kept`` is
    the rest as binary, and null where nothing was removed.  Null texts count as empty.  Rows that repeat an id or are equal are documents of their
    own, and so equal texts of ``window`` bytes or more lose everything.  Shorter texts and empty tables lose nothing.  Other columns are
    not read."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("id"), data.alias("data")).withColumn("sha", F.sha2("data", 256))
    texts = rows.select(F.substring("sha", 1, 32).alias("t"), "data", F.xxhash64("id").alias("spread")).filter(F.length("data") >= window)
    ranges, held = repeats(texts, window, grams, key_limit)
    spans = ranges.groupBy("t").agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("spans"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, data, los, his in zip(batch["t"], batch["data"], batch["los"], batch["his"], strict=True):
                kept, end, n_spans = [], 0, 0
                for lo, hi in zip(los, his, strict=True):
                    if lo > end or not n_spans:
                        n_spans += 1
                        kept.append(data[end:lo])
                    end = max(end, hi + window - 1)
                rest = b"".join([*kept, data[end:]])
                out.append((t, len(data) - len(rest), n_spans, hashlib.sha256(rest).hexdigest(), rest))
            yield pd.DataFrame(out, columns=["t", "n_removed", "n_spans", "kept_sha256", "kept"])

    touched = held.join(spans, "t").select("t", "data", F.col("spans.lo").alias("los"), F.col("spans.hi").alias("his"))
    # stored after the last aggregation: both sides of the join then come straight from a shuffle, and a hot text can be split
    changed = stored(map_pandas(touched, work, "t string, n_removed long, n_spans long, kept_sha256 string, kept binary").dropDuplicates(["t"]), "kept")
    plain = rows.select("id", F.length("data").cast("long").alias("n_bytes"), "sha", F.substring("sha", 1, 32).alias("t"))
    return plain.join(changed, "t", "left").select(
        "id", "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept",
    )
