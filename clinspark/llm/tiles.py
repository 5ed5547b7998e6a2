"""Groups of bounded size: hot groups become pairs of tiles, and each pair is a group of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.store import stored
from clinspark.llm.workers import map_pandas


def with_tile_pairs(frame: DataFrame, keys: list[str], spread: str, tile: int) -> DataFrame:
    """Adds ``_a``, ``_b`` and ``_t``: a group of ``keys`` with more than ``tile`` rows is dealt by the hash of
    ``spread`` to tiles of about that size, and each of its rows is repeated for every pair of tiles that its
    own tile ``_t`` belongs to.  Two rows of one group meet in exactly one pair ``(_a, _b)`` if their tiles
    differ, and in ``(_t, _t)`` if not; no task ever holds more than two tiles."""
    hot = (
        frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > tile)
        .select(*keys, F.ceil(F.col("_n") / tile).cast("int").alias("_tiles"))
    )
    hot = stored(hot, "hot-groups")
    if hot.isEmpty():
        return frame.withColumns({"_a": F.lit(0), "_b": F.lit(0), "_t": F.lit(0)})
    dealt = frame.join(hot, keys, "left").withColumn(
        "_t", F.when(F.col("_tiles").isNull(), 0).otherwise(F.expr(f"cast(pmod(xxhash64({spread}, 'tile'), _tiles) as int)"))
    )
    others = F.sequence(F.lit(0), F.coalesce(F.col("_tiles"), F.lit(1)) - 1)
    return (
        dealt.withColumn("_o", F.explode(others))
        .withColumns({"_a": F.least("_t", "_o"), "_b": F.greatest("_t", "_o")})
        .drop("_tiles", "_o")
    )


def by_group(frame: DataFrame, keys: list[str], work: Callable[[pd.DataFrame], pd.DataFrame | None], schema: str) -> DataFrame:
    """``work`` on the rows of each group, one group after the other within a partition.  Like a grouped map,
    but without its cost for each of very many small groups."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        for batch in batches:
            if not len(batch):
                continue
            change = np.zeros(len(batch), bool)
            for k in keys:
                column = batch[k].to_numpy()
                change[1:] |= column[1:] != column[:-1]
            if kept:
                last = kept[-1].iloc[-1]
                change[0] = any(last[k] != batch[k].iloc[0] for k in keys)
            starts = np.flatnonzero(change)
            if not len(starts):
                kept.append(batch)
                continue
            out = []
            head = pd.concat([*kept, batch.iloc[: starts[0]]]) if kept else batch.iloc[: starts[0]]
            bounds = [*starts, len(batch)]
            for group in [head, *(batch.iloc[a:b] for a, b in zip(bounds[:-2], bounds[1:-1], strict=True))]:
                if len(group) and (made := work(group)) is not None and len(made):
                    out.append(made)
            kept = [batch.iloc[starts[-1] :]]
            if out:
                yield pd.concat(out, ignore_index=True)
        if kept and (made := work(pd.concat(kept))) is not None and len(made):
            yield made

    return map_pandas(frame.repartition(*keys).sortWithinPartitions(*keys), run, schema)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node of its component under the given links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new
