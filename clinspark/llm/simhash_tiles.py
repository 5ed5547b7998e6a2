"""SimHash near-duplicates: fingerprints of word shingles, compared exactly in tiles.

Two fingerprints within ``radius`` bits agree in at least ``blocks - radius`` of ``blocks`` disjoint bit
blocks, so every pair meets under at least one choice of that many blocks.  Each choice and its value is a group; groups
are cut into tiles, and a pair of tiles whose population counts differ by more than the radius is skipped,
since the counts of two words never differ by more than their distance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.components import components
from clinspark.llm.store import stored
from clinspark.llm.tiles import by_group, forest, with_tile_pairs
from clinspark.llm.workers import map_arrow

#: Bytes that end a word.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text, as an unsigned number; zero for a text without words."""
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist(), strict=True)]
    octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``(id, fp)``: ``fp`` holds the 64 bits of the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t, shingle) for t in batch.column("_text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(found.view(np.int64))], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    return map_arrow(read, run, f"id {kind}, fp long")


def _cuts(blocks: int) -> list[int]:
    """Bounds of ``blocks`` bit ranges of nearly equal width."""
    return [round(64 * i / blocks) for i in range(blocks + 1)]


def _plan(values: int, radius: int, tile: int) -> int:
    """The fewest blocks under which a group of evenly spread fingerprints fits a tile; results are the same
    with any number."""
    for blocks in range(radius + 1, 2 * radius + 1):
        if values / 2 ** (64 * (blocks - radius) / blocks) <= tile / 2:
            return blocks
    return 2 * radius


def _near(a: np.ndarray, b: np.ndarray, radius: int, width: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of ``a`` and ``b`` within ``radius`` bits; both sorted by population count."""
    ones_a, ones_b = np.bitwise_count(a), np.bitwise_count(b)
    for i in range(0, len(a), width):
        x = a[i : i + width]
        for j in range(0, len(b), width):
            y = b[j : j + width]
            if int(ones_b[j]) - int(ones_a[i + len(x) - 1]) > radius or int(ones_a[i]) - int(ones_b[j + len(y) - 1]) > radius:
                continue
            p, q = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
            yield p + i, q + j


def links(values: DataFrame, radius: int = 4, tile: int = 2048) -> DataFrame:
    """Links ``(a, b)`` that join the distinct longs in ``fp`` just as all pairs within ``radius`` bits do.

    A dense tile gives the edges of a spanning forest, at most one for each row, in place of all its pairs."""
    blocks = _plan(values.count(), radius, tile)
    cuts = _cuts(blocks)
    masks = [sum(((1 << (cuts[c + 1] - cuts[c])) - 1) << cuts[c] for c in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = values.select(
        "fp", F.explode(F.array(*(F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(signed)))).alias("k")
    ).select("fp", "k.table", "k.part")

    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        if len(group) < 2:
            return None
        words, side = group["fp"].to_numpy().view(np.uint64), group["_t"].to_numpy()
        order = np.argsort(np.bitwise_count(words), kind="stable")
        words, side = words[order], side[order]
        one, two = int(group["_a"].iloc[0]), int(group["_b"].iloc[0])
        rows_a, rows_b = np.flatnonzero(side == one), np.flatnonzero(side == two)
        label = np.arange(len(words))
        for p, q in _near(words[rows_a], words[rows_b], radius):
            p, q = rows_a[p], rows_b[q]
            apart = p != q
            p, q = label[p[apart]], label[q[apart]]
            if len(p) and (p != q).any():
                label = forest(len(words), p, q)[label]
        child = np.flatnonzero(label != np.arange(len(words)))
        return pd.DataFrame({"a": words[child].view(np.int64), "b": words[label[child]].view(np.int64)})

    tiled = with_tile_pairs(keyed, ["table", "part"], "fp", tile)
    return by_group(tiled, ["table", "part", "_a", "_b"], compare, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4, tile: int = 2048) -> DataFrame:
    """``(id, fp, component_id)`` for every row of ``docs``.

    A null or empty text has fingerprint zero, which links like any other.  A text with fewer than ``shingle``
    words is one shingle.  Equal fingerprints always link, so copies are joined by their fingerprint before any
    comparison.  Rows that repeat an id stay rows.  A row without an id keeps a null id; it takes the component of
    its fingerprint.  An empty table gives an empty table; other columns are not read."""
    made = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = stored(made.groupBy("fp").agg(F.min("id").alias("node")), "fingerprint-nodes")
    found = stored(links(nodes.select("fp"), radius, tile), "fingerprint-links")
    ends = components(found)
    best = ends.join(nodes, ends["node"] == nodes["fp"]).groupBy("component").agg(F.min(nodes["node"]).alias("component_id"))
    linked = ends.join(best, "component").select(F.col("node").alias("fp"), "component_id")
    classes = nodes.join(linked, "fp", "left").select("fp", F.coalesce("component_id", nodes["node"]).alias("component_id"))
    # stored, so that both sides of the join come straight from a shuffle and a hot fingerprint can be split
    return made.join(stored(classes, "fingerprint-classes"), "fp")
