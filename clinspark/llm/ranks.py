"""Running positions over a whole table in id order, without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clinspark.llm.store import stored

_EMPTY = {"sum": 0, "bit_xor": 0}


def before(frame: DataFrame, key: str, order_id: str, ties: list[str], value: Column, name: str, span: int = 4096) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows of the same ``key`` that come earlier by ``order_id`` (nulls first) and
    ``ties``.

    Rows are cut into chunks of ``span`` consecutive ids.  Chunk sums are added up in two levels, so that the widest
    window holds one row for every ``span`` * ``span`` ids; a window over rows holds one chunk."""
    chunk = F.floor(F.col(order_id) / span)
    cut = frame.withColumns({"_value": value.cast("long"), "_chunk": chunk, "_block": F.floor(chunk / span)})
    fine = cut.groupBy(key, "_block", "_chunk").agg(F.sum("_value").alias("_sum"))
    coarse = fine.groupBy(key, "_block").agg(F.sum("_sum").alias("_sum"))
    ahead = lambda w: F.coalesce(F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = coarse.select(key, "_block", ahead(Window.partitionBy(key).orderBy(F.col("_block").asc_nulls_first())).alias("_b"))
    chunks = fine.select(key, "_block", "_chunk", ahead(Window.partitionBy(key, "_block").orderBy(F.col("_chunk").asc_nulls_first())).alias("_c"))
    left, right = chunks.alias("l"), blocks.alias("r")
    offsets = left.join(
        right, (F.col(f"l.{key}") == F.col(f"r.{key}")) & F.col("l._block").eqNullSafe(F.col("r._block"))
    ).select(F.col(f"l.{key}").alias("_key"), F.col("l._chunk").alias("_at"), (F.col("_b") + F.col("_c")).alias("_offset"))
    inner = Window.partitionBy(key, "_chunk").orderBy(F.col(order_id).asc_nulls_first(), *ties)
    local = cut.withColumn("_local", F.coalesce(F.sum("_value").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return (
        local.join(offsets, (F.col(key) == F.col("_key")) & F.col("_chunk").eqNullSafe(F.col("_at")))
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop("_value", "_chunk", "_block", "_local", "_key", "_at", "_offset")
    )


def running(frame: DataFrame, keys: list[str], order: list[Column], values: dict[str, tuple[str, Column]], name: str) -> DataFrame:
    """``frame`` with a column for each of ``values``, ``{column: (aggregate, value)}``: the ``sum`` or ``bit_xor`` of a long value over
    the rows of the same ``keys`` (null is a key of its own) that come earlier by ``order``; equal rows follow each other in any order.

    Rows are dealt to partitions by ranges of keys and order, so that a key with very many rows, whatever their order values
    look like, is cut into pieces of the size of a partition.  The pieces are summed up one by one, and what a key has in earlier
    partitions is added: fewer rows than there are partitions, as only a partition's first key began before it.  ``name`` is that of the stored table."""
    own = {f"_v_{c}": v.cast("long") for c, (_, v) in values.items()}
    at = [F.col(k).asc_nulls_first() for k in keys]
    numbered = frame.withColumns(own | {"_row": F.monotonically_increasing_id()})
    dealt = stored(numbered.repartitionByRange(*at, *order, F.col("_row").asc()).withColumn("_part", F.spark_partition_id()), name)
    agg = lambda how, value: getattr(F, how)(value)
    ahead = lambda how, value, w: F.coalesce(agg(how, value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(_EMPTY[how]))
    parts = dealt.groupBy(*keys, "_part").agg(*(agg(how, f"_v_{c}").alias(f"_p_{c}") for c, (how, _) in values.items()))
    by_key = Window.partitionBy(*keys).orderBy("_part")
    carried = (
        parts.select(*keys, "_part", F.lag("_part").over(by_key).alias("_before"), *(ahead(how, f"_p_{c}", by_key).alias(f"_c_{c}") for c, (how, _) in values.items()))
        .filter("_before is not null").select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_part").alias("_at"), *(f"_c_{c}" for c in values))
    )
    same = F.col("_part") == F.col("_at")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_part").orderBy(*order, "_row")
    local = dealt.withColumns({c: ahead(how, f"_v_{c}", inside) for c, (how, _) in values.items()})
    plus = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}
    whole = {c: plus[how](F.col(c), F.coalesce(F.col(f"_c_{c}"), F.lit(0))) for c, (how, _) in values.items()}
    return local.join(F.broadcast(carried), same, "left").withColumns(whole).select(*frame.columns, *values)
