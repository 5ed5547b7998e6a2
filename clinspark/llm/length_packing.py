"""Length buckets with the least padding, and batches of a fixed token budget inside each bucket."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinspark.llm.ranks import running
from clinspark.llm.store import stored


def best_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """The upper bounds of at most ``buckets`` length ranges that minimise the padding of a histogram.

    ``lengths`` ascends; a sequence is padded to the bound of its range, and the last bound is the largest length.
    Dynamic programming: ``cost[j]`` is the least padding of the first ``j`` lengths with the ranges used so far."""
    m = len(lengths)
    if not m:
        return []
    rows = np.concatenate(([0], np.cumsum(counts, dtype=np.float64)))
    tokens = np.concatenate(([0], np.cumsum(counts * lengths.astype(np.float64))))
    cost, froms = np.full(m + 1, np.inf), []
    cost[0] = 0.0
    for _ in range(min(buckets, m)):
        new, at = cost.copy(), np.full(m + 1, -1)
        for j in range(1, m + 1):
            # lengths i..j-1 form one range that ends at lengths[j-1]
            total = cost[:j] + lengths[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            i = int(np.argmin(total))
            if total[i] < new[j]:
                new[j], at[j] = total[i], i
        froms.append(at)
        cost = new
    bounds, j = [], m
    for at in reversed(froms):
        if j and at[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(at[j])
    return bounds[::-1]


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 8, max_tokens: int = 2048, token_budget: int = 65_536) -> DataFrame:
    """``(doc_id, piece, n_tokens, bucket_tokens, batch, slot)``: one row for each sequence.

    A text has one token for every word ``[^\\x20\\x09-\\x0D]+`` and one for its end; null and empty texts have the end alone.
    Texts longer than ``max_tokens`` are cut into pieces of that length, so no token is lost and the histogram, the only thing
    that reaches the driver, has at most ``max_tokens`` rows.  Batches of a bucket hold ``token_budget // bucket_tokens`` rows
    (one at least) in ascending order of id and piece; only the last may be shorter.  ``batch`` counts within its bucket.
    Rows with equal ids stay apart in either order; rows without id come first.  Other columns are not read."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)) + 1
    sized = docs.select(F.col(id_col).alias("doc_id"), words.alias("_n"))
    pieces = stored(
        sized.select("doc_id", "_n", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 1) / max_tokens).cast("int"))).alias("piece"))
        .select("doc_id", "piece", F.least(F.lit(max_tokens), F.col("_n") - F.col("piece") * max_tokens).cast("int").alias("n_tokens")),
        "pieces",
    )
    histogram = sorted((r["n_tokens"], r["count"]) for r in pieces.groupBy("n_tokens").count().collect())
    bounds = best_bounds(np.array([r[0] for r in histogram]), np.array([r[1] for r in histogram]), buckets)
    bucket = F.element_at(F.filter(F.array(*map(F.lit, bounds)), lambda b: b >= F.col("n_tokens")), 1) if bounds else F.lit(0)
    placed = pieces.withColumn("bucket_tokens", bucket)
    order = [F.col("doc_id").asc_nulls_first(), F.col("piece").asc(), F.col("n_tokens").asc()]
    ranked = running(placed, ["bucket_tokens"], order, {"_rank": ("sum", F.lit(1))}, "sequence-places")
    rows = F.greatest(F.lit(1), F.floor(F.lit(token_budget) / F.col("bucket_tokens")))
    return ranked.select(
        "doc_id", "piece", "n_tokens", "bucket_tokens",
        F.floor(F.col("_rank") / rows).alias("batch"), F.pmod("_rank", rows).alias("slot"),
    )
