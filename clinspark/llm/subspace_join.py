"""Near-duplicate vectors: a pigeonhole join over blocks of rotated coordinates, each pair checked exactly.

Vectors of unit length are rotated to their principal axes and their coordinates dealt to blocks.  Two vectors within a squared
distance D are, in some block, within the share of D that equals the block's share of the variance.  So each block is joined by
range under its own share, in cells of its leading coordinates, and every pair found is checked on the vectors as given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.components import components
from clinspark.llm.store import stored
from clinspark.llm.tiles import by_group, forest, with_tile_pairs
from clinspark.llm.workers import map_pandas

#: Room for rounding in squared distances of unit vectors; the exact check decides.
SLACK = 1e-9

#: A block is cut along its leading coordinates that vary, in standard deviations, by ``CUT`` radii of the block at least: such a cut
#: leaves less than half of the pairs to compare, for twice the rows.  Always along the first one, and along ``MOST_CUTS`` at most.
CUT = 2.0
MOST_CUTS = 3


def _units(vectors: pd.Series) -> np.ndarray:
    x = np.stack(vectors.to_numpy()).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # the square of a very small or large component would vanish or overflow
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def rotation(vectors: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The principal axes of the unit vectors in ``v``, as columns, and their variances, largest first.

    Sums of products are made within partitions and added up; ``size`` times ``size`` numbers reach the driver."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros((size + 1, size + 1)), 0
        for batch in batches:
            x = np.hstack([_units(batch["v"]), np.ones((len(batch), 1))])
            total += x.T @ x
            n += len(batch)
        if n:
            yield pd.DataFrame({"i": np.repeat(np.arange(size + 1), size + 1), "j": np.tile(np.arange(size + 1), size + 1), "s": total.ravel()})

    sums = np.zeros((size + 1, size + 1))
    for r in map_pandas(vectors.select("v"), work, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        sums[r["i"], r["j"]] = r["s"]
    n = max(sums[size, size], 1.0)
    mean = sums[:size, size] / n
    values, axes = np.linalg.eigh(sums[:size, :size] / n - np.outer(mean, mean))
    return axes[:, ::-1], np.maximum(values[::-1], 0)


def _blocks(variance: np.ndarray, count: int) -> list[np.ndarray]:
    """Coordinates dealt out in turn, so that every block leads with one of the largest variances."""
    return [np.arange(b, len(variance), count) for b in range(min(count, len(variance)))]


def _cuts(variance: np.ndarray, dealt: list[np.ndarray], budgets: np.ndarray) -> list[np.ndarray]:
    """The coordinates that cut each block into cells."""
    made = []
    for d, budget in zip(dealt, budgets, strict=True):
        wide = int((np.sqrt(variance[d[:MOST_CUTS]]) >= CUT * np.sqrt(budget)).sum())
        made.append(d[: max(wide, 1)])
    return made


def _rotated(vectors: pd.Series, axes: np.ndarray) -> np.ndarray:
    """Unit vectors along ``axes``; a row comes out the same, to the last bit, in whatever batch it stands."""
    unit = _units(vectors)
    return np.concatenate([(unit[i : i + 512, None, :] * axes.T[None]).sum(axis=2) for i in range(0, len(unit), 512)])


def _close(y: np.ndarray, rows: np.ndarray, cols: np.ndarray, budget: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``rows`` and ``cols`` whose points in ``y`` are within ``budget``, a few too many for lack of digits.

    Both sides are in the order of the leading coordinate, so each strip of rows meets a range of columns."""
    half = 0.5 * (y * y).sum(axis=1, keepdims=True)
    ones = np.ones_like(half)
    left = np.hstack([y, ones, 0.5 * budget + 1e-5 - half]).astype(np.float32)
    right = np.hstack([y, -half, ones]).astype(np.float32)
    radius, lead = np.sqrt(budget) + 1e-6, y[cols, 0]
    for start in range(0, len(rows), 256):
        strip = rows[start : start + 256]
        a, b = np.searchsorted(lead, [y[strip[0], 0] - radius, y[strip[-1], 0] + radius])
        if a < b:
            p, q = np.nonzero(left[strip] @ right[cols[a:b]].T >= 0)
            yield strip[p], cols[a:b][q]


def linked_pairs(vectors: DataFrame, cosine: float, blocks: int, tile: int) -> DataFrame:
    """``(node, n, a, b)`` from the join of the distinct vectors ``(node, w, v)``: rows that link to ``node`` (``n``, each counted
    ``w`` times), and edges ``a``-``b`` of a spanning forest of the links that one task has seen."""
    size = len(vectors.first()["v"])
    axes, variance = rotation(vectors, size)
    dealt = _blocks(variance, blocks)
    limit = 2 - 2 * cosine
    shares = np.array([variance[d].sum() + 1e-12 for d in dealt])
    budgets = limit * shares / shares.sum() + SLACK

    cuts = _cuts(variance, dealt, budgets)
    places = ["block", *(f"c{i}" for i in range(MOST_CUTS))]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each vector in its cell, as wide as the block's radius along every cut, and as a guest in the next ones above.

        Bit ``i`` of ``up`` tells that the vector was moved up along cut ``i``.  Two vectors in equal or neighbouring cells meet in one cell in
        which neither is moved along a cut where the other one is."""
        for batch in batches:
            y = _rotated(batch["v"], axes)
            for k, cut in enumerate(cuts):
                cell = np.floor(y[:, cut] / np.sqrt(budgets[k])).astype(np.int64)
                for up in range(1 << len(cut)):
                    at = {f"c{i}": cell[:, i] + (up >> i & 1) if i < len(cut) else 0 for i in range(MOST_CUTS)}
                    yield batch.assign(block=k, up=up, **at)[[*places, "up", "node", "w", "v"]]

    def compare(group: pd.DataFrame) -> pd.DataFrame | None:
        if len(group) < 2:
            return None
        k, one, two = int(group["block"].iloc[0]), int(group["_a"].iloc[0]), int(group["_b"].iloc[0])
        y = _rotated(group["v"], axes)
        order = np.argsort(y[:, dealt[k][0]], kind="stable")
        group, y = group.iloc[order], y[order]
        up, side = group["up"].to_numpy(), group["_t"].to_numpy()
        node, w = group["node"].to_numpy(), group["w"].to_numpy()
        given = np.stack(group["v"].to_numpy()).astype(np.float64)
        given /= np.abs(given).max(axis=1, keepdims=True)
        norm = np.sqrt((given * given).sum(axis=1))
        label, found = np.arange(len(group)), np.zeros(len(group), np.int64)
        moves = range(1 << len(cuts[k]))
        for s, t in ((s, t) for s in moves for t in moves if not s & t and (one != two or s <= t)):
            rows, cols = np.flatnonzero((up == s) & (side == one)), np.flatnonzero((up == t) & (side == two))
            for p, q in _close(y[:, dealt[k]], rows, cols, budgets[k]):
                if one == two and s == t:
                    p, q = p[p < q], q[p < q]
                for i in range(0, len(p), 65536):
                    a, b = p[i : i + 65536], q[i : i + 65536]
                    apart = y[a] - y[b]
                    apart *= apart
                    fine = apart[:, dealt[k]].sum(axis=1) <= budgets[k]
                    for j in range(k):  # a pair counts in the first block that finds it
                        fine &= apart[:, dealt[j]].sum(axis=1) > budgets[j]
                    a, b = a[fine], b[fine]
                    exact = (given[a] * given[b]).sum(axis=1) / (norm[a] * norm[b]) >= cosine
                    a, b = a[exact], b[exact]
                    found += np.bincount(a, w[b], len(group)).astype(np.int64) + np.bincount(b, w[a], len(group)).astype(np.int64)
                    if (label[a] != label[b]).any():
                        label = forest(len(label), label[a], label[b])[label]
        linked = np.flatnonzero(found)
        return pd.DataFrame({"node": node[linked], "n": found[linked], "a": node[linked], "b": node[label[linked]]})

    kind = vectors.schema["v"].dataType.simpleString()
    spread = stored(map_pandas(vectors, place, f"block int, c0 long, c1 long, c2 long, up int, node long, w long, v {kind}"), "cells")
    tiled = with_tile_pairs(spread, places, "node", tile)
    return by_group(tiled, [*places, "_a", "_b"], compare, "node long, n long, a long, b long")


def near_vectors(frame: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, blocks: int = 4, tile: int = 32_768) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row of ``frame``.

    A task holds two tiles of ``tile`` vectors at most; the more a tile holds, the fewer times a vector of a hot cell is sent.

    Two rows link if the cosine of their vectors, in double precision, is ``cosine`` at least.  Null and zero vectors and
    such with null or non-finite components link with nothing.  Vectors of different length never link.  Equal vectors
    are joined as one with a weight.  Rows that repeat an id are rows of their own; a row without an id takes the component of
    what it links to, else null, and is not kept.  An empty table gives an empty table; other columns are not read."""
    kind = frame.schema[vector_col].dataType.simpleString()
    every = frame.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    usable = F.coalesce(finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # equal vectors by value: adding zero turns -0.0 into 0.0
    text = F.array_join(F.transform("v", lambda x: (x + F.lit(0).cast(kind[6:-1])).cast("string")), ",")
    keyed = every.withColumn("key", F.when(usable, F.sha2(text, 256)))
    single = stored(
        keyed.filter("key is not null").groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("w"), F.first("v").alias("v"))
        .withColumn("node", F.xxhash64("key")),
        "distinct-vectors",
    )
    found = single.select("node", F.lit(0).cast("long").alias("n"), F.col("node").alias("a"), F.col("node").alias("b")).limit(0)
    for (size,) in single.select(F.size("v")).distinct().collect():
        part = linked_pairs(single.filter(F.size("v") == size).select("node", "w", "v"), cosine, blocks, tile)
        found = found.unionByName(stored(part, "vector-links"))
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    ends = components(found.select("a", "b")).withColumnRenamed("node", "member")
    named = single.select("key", "node", "least", "w").join(counts, "node", "left").join(ends, F.col("node") == F.col("member"), "left")
    best = named.filter("component is not null").groupBy("component").agg(F.min("least").alias("best"))
    classes = named.join(best, "component", "left").select(
        "key", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), F.coalesce("best", "least").alias("component_id")
    )
    linked = keyed.filter("key is not null").select("id", "key").join(classes, "key").select("id", "n_links", "component_id")
    rest = keyed.filter("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(rest).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
