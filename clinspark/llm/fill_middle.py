"""Texts turned into fill-in-the-middle examples, cut at units counted chunk by chunk.

A rolling hash cuts the bytes of a text into chunks, so that a passage which many texts share falls into the same chunks wherever it
stands.  What a chunk adds to the count of units depends on its own bytes and on one bit of the chunk before it; this
summary is remembered by content, and a lookup compares the whole content.  Sums over the chunks give the number of units and the
chunk in which a cut falls; only that chunk is looked at byte by byte.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.workers import map_arrow

SCHEMA = "doc_id long, n long, form string, prefix_units long, middle_units long, output string"
#: Prefix, suffix and middle are marked by these.
MARKERS = ("<P>", "<S>", "<M>")
#: Bytes that the rolling hash looks at, and bits of it that must be zero at a cut: chunks have about 2 ** CUT_BITS bytes.
WINDOW = 32
CUT_BITS = 9
LEAST, MOST = 128, 4096
#: Bytes hashed at a time, and bytes of chunks after which a worker begins to forget.
SEGMENT = 1 << 20
CACHE_BYTES = 32 << 20
_ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each byte, and the powers of an odd number and of its inverse modulo 2 ** 64."""
    numbers = np.array([int.from_bytes(hashlib.sha256(bytes([b])).digest()[:8], "little") for b in range(256)], np.uint64)
    factors = np.full((2, SEGMENT + WINDOW), [[_ODD], [pow(_ODD, -1, 1 << 64)]], np.uint64)
    factors[:, 0] = 1
    up, down = np.cumprod(factors, axis=1, dtype=np.uint64)
    return numbers, up, down


def cut_places(data: np.ndarray) -> np.ndarray:
    """Places of ``data`` before which the hash of the last ``WINDOW`` bytes allows a cut, ascending."""
    numbers, up, down = _tables()
    found = []
    for at in range(0, len(data), SEGMENT):
        begin = max(0, at - WINDOW + 1)
        part = numbers[data[begin : at + SEGMENT]]
        if len(part) >= WINDOW:
            # sums of number * power make the hash of a window one subtraction, whatever its place
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * down[: len(part)], out=sums[1:])
            hashes = (sums[WINDOW:] - sums[:-WINDOW]) * up[WINDOW - 1 : len(part)]
            found.append(np.flatnonzero(hashes >> np.uint64(64 - CUT_BITS) == 0) + begin + WINDOW)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _code_points(data: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a code point begins at each byte of UTF-8."""
    return (data & 0xC0) != 0x80


def _words(data: np.ndarray, inside: bool) -> np.ndarray:
    """Whether a word ``[^\\x20\\x09-\\x0D]+`` begins at each byte; ``inside`` tells that the byte before is of a word."""
    of_word = (data != 0x20) & ((data < 0x09) | (data > 0x0D))
    begins = of_word.copy()
    begins[1:] &= ~of_word[:-1]
    if inside and len(begins):
        begins[0] = False
    return begins


UNITS = {"code_point": _code_points, "word": _words}


class Counter:
    """Units of texts by their chunks.  ``known`` holds ``(units, whether the first byte begins one only behind a gap, whether the last byte
    is of a word)`` by the content of a chunk, for the chunks of the last two spells."""

    def __init__(self, unit: str):
        self.begins = UNITS[unit]
        self.words = unit == "word"
        self.known: dict[bytes, tuple[int, bool, bool]] = {}
        self.older: dict[bytes, tuple[int, bool, bool]] = {}
        self.held = 0

    def _summary(self, chunk: bytes) -> tuple[int, bool, bool]:
        got = self.known.get(chunk)
        if got is None:
            got = self.older.get(chunk)
            if got is None:
                data = np.frombuffer(chunk, np.uint8)
                starts = self.begins(data, False)
                # isspace() of bytes tells just the six signs that part words
                got = (int(np.count_nonzero(starts)), bool(self.words and starts[0]), self.words and not chunk[-1:].isspace())
            self.known[chunk] = got
            self.held += len(chunk)
            if self.held > CACHE_BYTES:
                self.known, self.older, self.held = {}, self.known, 0
        return got

    def measure(self, text: bytes, places: np.ndarray) -> tuple[list[int], list[int], list[bool]]:
        """Where the chunks of ``text`` begin (and the last ends), units before each, and whether a unit is open there."""
        bounds, units, open_ = [0], [0], [False]
        at, total, inside, size = 0, 0, False, len(text)
        allowed = places.tolist()
        nth = 0
        while at < size:
            low, high = at + LEAST, min(at + MOST, size)
            while nth < len(allowed) and allowed[nth] < low:
                nth += 1
            end = min(allowed[nth], high) if nth < len(allowed) else high
            n, first, last = self._summary(text[at:end])
            total += n - (first and inside)
            at, inside = end, last
            bounds.append(at)
            units.append(total)
            open_.append(inside)
        return bounds, units, open_

    def place(self, text: bytes, chunks: tuple[list[int], list[int], list[bool]], k: int) -> int:
        """The byte at which unit ``k`` begins; the first cut is at the beginning of the text, the last at its end."""
        bounds, units, open_ = chunks
        if k <= 0 or k >= units[-1]:
            return 0 if k <= 0 else len(text)
        j = bisect_right(units, k) - 1
        starts = self.begins(np.frombuffer(text[bounds[j] : bounds[j + 1]], np.uint8), open_[j])
        return bounds[j] + int(np.flatnonzero(starts)[k - units[j]])


@lru_cache(maxsize=2)
def _counter(unit: str) -> Counter:
    return Counter(unit)


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, unit: str = "code_point", rate: int = 90, spm_rate: int = 20, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """``(doc_id, n, form, prefix_units, middle_units, output)``, one row for each document.

    A text of ``n`` units is cut twice at places that depend on ``seed`` and id alone, each among ``0 .. n`` with the same probability:
    ``h1`` to ``h4`` are the first four 8-digit groups of the SHA-256 of ``seed:id``, the cuts ``h1 % (n + 1)`` and
    ``h2 % (n + 1)``.  Of every hundred texts about ``rate`` are rearranged (``h3``), of these ``spm_rate`` to suffix, prefix,
    middle (``spm``, by ``h4``) and the others to prefix, suffix, middle (``psm``).  Texts that are empty or hold a marker stay ``plain``; they are their
    own output and have no cuts.  Units are code points, or words with the white space that follows them.

    A null text is empty; documents without an id share the cuts of the empty id; rows with the same id are treated alike.  Whole
    texts are cut, however long.  Other columns are not read."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {sorted(UNITS)}")
    marks = [m.encode() for m in markers]
    pre, suf, mid = marks

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(unit)
        for batch in batches:
            out: list[tuple] = []
            held = 0
            for number, scalar in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                text = scalar.as_buffer().to_pybytes()
                digest = hashlib.sha256(f"{seed}:{'' if number is None else number}".encode()).hexdigest()
                h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
                chunks = counter.measure(text, cut_places(np.frombuffer(text, np.uint8)))
                n = chunks[1][-1]
                if not text or h3 % 100 >= rate or any(m in text for m in marks):
                    out.append((number, n, "plain", None, None, text))
                else:
                    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                    x, y = counter.place(text, chunks, a), counter.place(text, chunks, b)
                    if h4 % 100 < spm_rate:
                        out.append((number, n, "spm", a, b - a, b"".join((suf, text[y:], pre, text[:x], mid, text[x:y]))))
                    else:
                        out.append((number, n, "psm", a, b - a, b"".join((pre, text[:x], suf, text[y:], mid, text[x:y]))))
                held += len(text)
                if held >= SEGMENT * 8:
                    yield made(out)
                    out, held = [], 0
            if out:
                yield made(out)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([*columns[:5], columns[5].cast(pa.string())], names=[c.split()[0] for c in SCHEMA.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return map_arrow(rows, work, SCHEMA)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text from which ``output`` was made.  As a rearranged text holds no marker, the first one of each kind is the one that was set."""
    pre, suf, mid = (f"\\Q{m}\\E" for m in markers)
    parts = lambda first, second, head: F.split(F.substring(output, F.lit(len(head) + 1), F.length(output)), f"{first}|{second}", 3)
    psm, spm = parts(suf, mid, markers[0]), parts(pre, mid, markers[1])
    return (
        F.when(form == "psm", F.concat(F.get(psm, F.lit(0)), F.get(psm, F.lit(2)), F.get(psm, F.lit(1))))
        .when(form == "spm", F.concat(F.get(spm, F.lit(1)), F.get(spm, F.lit(2)), F.get(spm, F.lit(0))))
        .otherwise(output)
    )


ORACLE = """
WITH doc AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
drawn AS (SELECT doc_id, text, n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM doc),
cut AS (SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
part AS (SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cut)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN (b - a)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM part
"""
