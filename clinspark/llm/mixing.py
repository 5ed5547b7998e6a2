"""Sources mixed to target weights: fixed-length blocks of words, drawn by index.

DataFrame functions only.  Every source is one long sequence of words cut into blocks of equal length.  The mix has as many slots
as the targets ask for; slots fall to output shards by a pseudorandom permutation of all slots, which makes the source counts of a shard a
multinomial draw, given that all shards together take exactly what the targets say.  The slots of a source are numbered through the
shards, and each number leads to a block through a pseudorandom permutation of the source's blocks, one for each time the source is gone
through.  Permutations are computed index by index, so nothing is sorted at random and every run gives the same mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.ranks import running
from clinspark.llm.skew import join_unique
from clinspark.llm.store import stored

WORD = "[^\\x20\\x09-\\x0D]+"
#: Words of a block, slots of a shard, share of all words that the mix takes, and how often a source is gone through at most.
BLOCK = 256
SHARD_SLOTS = 64
SHARE = 1.5
MOST = 2
#: Weights of the sources in order, repeating.
WEIGHTS = (3, 1, 2)
#: Rounds of a permutation, and a prime for its arithmetic.
ROUNDS = 24
PRIME = 2_147_483_647
#: Slots that one row is expanded to, slots of a task, and tasks at most.
PIECE = 16_384
TASK_SLOTS = 1 << 20
MOST_TASKS = 100_000
#: Tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def _round(seed: Column, r: int | Column) -> tuple[Column, Column]:
    """Two numbers below ``PRIME`` that belong to a seed and a round."""
    first = (seed * 7919 + r * 104_729 + 12_345) % PRIME
    return first, ((first * first + first) % PRIME * 48_271 + r) % PRIME


def round_numbers(n: Column, seed: Column) -> Column:
    """The numbers of all rounds of one permutation of ``0 .. n - 1``: an array of ``(c, k)``."""

    def numbers(r: Column) -> Column:
        first, c = _round(seed, r.cast("long"))
        return F.struct(c.alias("c"), F.pmod(c * PRIME + first, n).alias("k"))

    return F.transform(F.sequence(F.lit(1), F.lit(ROUNDS)), numbers)


def permuted(x: Column, n: Column, rounds: Column) -> Column:
    """The place of ``x`` in a pseudorandom permutation of ``0 .. n - 1``.

    ``rounds`` holds what :func:`round_numbers` gives for ``n`` and a seed; there is one permutation for each seed.  Rounds of
    swap-or-not: each pairs every number with another, by a reflection at a place of its own, and a bit that belongs to
    the pair tells whether the two change places; so every round is a permutation for any ``n``.  ``n`` up to 10 ** 14, seeds up to 10 ** 14."""

    def step(at: Column, now: Column) -> Column:
        other = F.pmod(now["k"] - at, n)
        pair = (F.greatest(at, other) * 48_271 + now["c"]) % PRIME
        bit = F.shiftright((pair * pair % PRIME * 69_621 + now["c"]) % PRIME, 16).bitwiseAND(F.lit(1))
        return F.when(bit == 1, other).otherwise(at)

    return F.aggregate(rounds, x.cast("long"), step)


def targets(sources: DataFrame, share: float = SHARE, most: int = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``sources`` (``source``, ``source_size``) with ``rank`` in ascending order of source, null last, and ``target``.

    A target is the source's weight times one level for all, but ``most`` times its size at most; with that level the targets add up
    to ``share`` of all sizes (which must not be above ``most``).  This is what resharing the excess by weight ends with."""
    ranked = running(sources, [], [F.col("source").asc_nulls_last()], {"rank": ("sum", F.lit(1))}, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumns({"weight": weight.cast("long"), "most": F.lit(most) * F.col("source_size")})
    # with the sources in the order in which they reach their bound, the level is the largest that its own source can still take
    full = F.col("most") / F.col("weight")
    filled = running(ranked.withColumn("full", full), [], [F.col("full").asc(), F.col("rank").asc()], {"taken": ("sum", F.col("most")), "gone": ("sum", F.col("weight"))}, "levels")
    total = filled.agg((F.sum("source_size") * F.lit(share)).alias("words"), F.sum("weight").alias("weights"))
    level = (F.lit(total.select("words").scalar()) - F.col("taken")) / (total.select("weights").scalar() - F.col("gone"))
    levels = stored(filled.withColumn("level", level), "filled")
    last = levels.filter("level <= full").agg(F.max("level").alias("level"))
    target = F.least(F.col("most").cast("double"), F.coalesce(last.scalar(), F.lit(0.0)) * F.col("weight"))
    return levels.select("source", "source_size", "rank", target.alias("target"))


def _with(large: DataFrame, sources: DataFrame, on: list[str]) -> DataFrame:
    return large.join(F.broadcast(sources), on) if sources.count() <= BROADCAST_ROWS else join_unique(large, sources, on)


def slots(plan: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(shard, rank, ordinal, block, words)``: the slots of the mix.

    ``plan`` holds ``rank``, ``source_size`` and ``target``.  A source is gone through whole as often as its target allows; of
    the next time only the first blocks are drawn, and the last of them gives just the words that the target still lacks (``words``).  The
    last block of a source, which may be short, comes last each time."""
    asked = F.floor(F.col("target") + 0.5).cast("long")
    wanted = plan.filter("source_size > 0").select("rank", "source_size", asked.alias("asked"), F.ceil(F.col("source_size") / block).cast("long").alias("blocks"))
    wanted = wanted.withColumns({"whole": F.expr("asked div source_size"), "rest": F.col("asked") % F.col("source_size")})
    wanted = wanted.withColumn("slots", F.col("whole") * F.col("blocks") + F.ceil(F.col("rest") / block))
    wanted = stored(running(wanted, [], [F.col("rank").asc()], {"ahead": ("sum", F.col("slots"))}, "source-slots"), "source-slots")
    total = wanted.agg(F.sum("slots").alias("n")).first()["n"] or 0
    cut = wanted.filter("slots > 0").select("rank", "ahead", "slots", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1, F.lit(PIECE).cast("long"))).alias("at"))
    # a few bytes become many slots, so the number of tasks is that of the slots and not left to the size of the rows
    pieces = total // PIECE + 1
    tasks = max(-(-total // TASK_SLOTS), min(pieces, int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    each = cut.repartition(min(tasks, MOST_TASKS), "rank", "at").select("rank", "ahead", F.explode(F.sequence("at", F.least(F.col("at") + PIECE, F.col("slots")) - 1)).alias("i"))
    # one row of numbers for all slots, as literals
    order = plan.sparkSession.range(1).select(round_numbers(F.lit(max(total, 1)).cast("long"), F.lit(0).cast("long")).alias("r")).first()["r"]
    order = F.array(*[F.struct(F.lit(x["c"]).cast("long").alias("c"), F.lit(x["k"]).cast("long").alias("k")) for x in order])
    place = permuted(F.col("ahead") + F.col("i"), F.lit(max(total, 1)).cast("long"), order)
    drawn = each.groupBy("rank", F.floor(place / shard_slots).cast("long").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    numbered = running(drawn, ["rank"], [F.col("shard").asc()], {"before": ("sum", F.col("n"))}, "draws")
    # a shard draws from a source no more slots than it has
    one = numbered.select("rank", "shard", F.explode(F.sequence("before", F.col("before") + F.col("n") - 1)).alias("ordinal"))
    even = F.col("blocks") - F.when(F.col("source_size") % block > 0, 1).otherwise(0)
    times = F.sequence(F.lit(1).cast("long"), F.lit(MOST + 1).cast("long"))
    orders = wanted.withColumn("even", F.greatest(even, F.lit(1)).cast("long")).withColumn("short", even < F.col("blocks"))
    orders = orders.withColumn("orders", F.transform(times, lambda t: round_numbers(F.col("even"), F.col("rank") * (MOST + 1) + t)))
    placed = _with(one, stored(orders.drop("ahead", "slots", "asked"), "block-orders"), ["rank"])
    placed = placed.withColumns({"time": F.expr("ordinal div blocks"), "index": F.col("ordinal") % F.col("blocks")})
    last = F.col("short") & (F.col("index") == F.col("blocks") - 1)
    found = F.when(last, F.col("index")).otherwise(permuted(F.col("index"), F.col("even"), F.col("orders")[F.col("time").cast("int")]))
    left = F.when(F.col("time") < F.col("whole"), block).otherwise(F.least(F.lit(block), F.col("rest") - F.col("index") * block))
    return placed.select("shard", "rank", "ordinal", found.alias("block"), left.cast("long").alias("words"))


def placed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: float = SHARE, most: int = MOST) -> DataFrame:
    """``(doc_id, size, rank, start, source_size, target)``, stored: each document's words and the place of the first in its source.

    A null text has no words.  The documents of a source follow each other by id, null first, then by size and content; documents without a source are a
    source of their own."""
    words = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    sized = stored(docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), words.alias("size"), F.xxhash64(text).alias("content")), "sizes")
    # null sources are told apart from empty ones by a second column, as keys of a join
    keys = {"_source": F.coalesce("source", F.lit("")), "_none": F.col("source").isNull()}
    plan = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, most), "targets")
    order = [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("content").asc()]
    found = running(_with(sized.withColumns(keys), plan.withColumns(keys).drop("source"), ["_source", "_none"]), ["rank"], order, {"start": ("sum", F.col("size"))}, "document-places")
    return stored(found.select("doc_id", "size", "rank", "start", "source_size", "target"), "placed-documents")


def mixed(placed: DataFrame, block: int = BLOCK, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(shard, rank, ordinal, doc_id, start, first_word, n_words)``: the mix, one row for each part of a document in a slot.

    ``placed`` comes from ``placed_documents``.  A slot's words are those of its rows in ascending order of ``start``; ``first_word`` counts the
    words of the document before them.  Slots and document parts meet by source and block, of which none has more than ``block`` parts."""
    plan = stored(placed.groupBy("rank").agg(F.min("source_size").alias("source_size"), F.min("target").alias("target")), "plan")
    chosen = slots(plan, block, shard_slots)
    ends = F.expr(f"(start + size - 1) div {block}")
    parts = placed.filter("size > 0").select("doc_id", "size", "rank", "start", F.explode(F.sequence(F.expr(f"start div {block}"), ends)).alias("block"))
    begin, end = F.greatest(F.col("start"), F.col("block") * block), F.least(F.col("start") + F.col("size"), F.col("block") * block + F.col("words"))
    return (
        parts.join(chosen, ["rank", "block"]).withColumns({"_b": begin, "_e": end}).filter("_e > _b")
        .select("shard", "rank", "ordinal", "doc_id", "start", (F.col("_b") - F.col("start")).alias("first_word"), (F.col("_e") - F.col("_b")).alias("n_words"))
    )


def taken(placed: DataFrame, mix: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row for each document: the words that ``mix`` takes of it, repeats counted."""
    words = mix.groupBy("rank", "start").agg(F.sum("n_words").alias("taken")).withColumn("full", F.lit(True))
    return placed.withColumn("full", F.col("size") > 0).join(words, ["rank", "start", "full"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
    )


def _sql_permuted(x: str, n: str, seed: str) -> str:
    """``permuted`` as DuckDB text."""
    first = f"(({seed}) * 7919 + r * 104729 + 12345) % {PRIME}"
    number = f"((({first}) * ({first}) + ({first})) % {PRIME} * 48271 + r) % {PRIME}"
    other = f"(((({number}) * {PRIME} + ({first})) % ({n})) - x + ({n})) % ({n})"
    pair = f"(greatest(x, {other}) * 48271 + ({number})) % {PRIME}"
    bit = f"((({pair}) * ({pair}) % {PRIME} * 69621 + ({number})) % {PRIME}) // 65536 % 2"
    return f"list_reduce(list_concat([({x})::BIGINT], range(1, {ROUNDS + 1})), lambda x, r: CASE WHEN {bit} = 1 THEN {other} ELSE x END)"


ORACLE = f"""
WITH doc AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM doc GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][rank % 3 + 1]::BIGINT AS weight, 2 * source_size AS most FROM src),
filled AS (SELECT *, most::DOUBLE / weight AS full_at, sum(source_size) OVER () * 1.5::DOUBLE AS words, sum(weight) OVER () AS weights,
                  coalesce(sum(most) OVER w, 0) AS used, coalesce(sum(weight) OVER w, 0) AS gone
           FROM weighed WINDOW w AS (ORDER BY most::DOUBLE / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
levels AS (SELECT *, (words - used::DOUBLE) / (weights - gone)::DOUBLE AS level FROM filled),
plan AS (SELECT source, source_size, rank, least(most::DOUBLE, (SELECT max(level) FROM levels WHERE level <= full_at) * weight) AS target FROM levels),
asked AS (SELECT *, floor(target + 0.5)::BIGINT AS asked, (source_size + {BLOCK - 1}) // {BLOCK} AS blocks FROM plan WHERE source_size > 0),
wanted AS (SELECT *, asked // source_size AS whole, asked % source_size AS rest, asked // source_size * blocks + (asked % source_size + {BLOCK - 1}) // {BLOCK} AS slots FROM asked),
numbered AS (SELECT *, (sum(slots) OVER ())::BIGINT AS n, (sum(slots) OVER (ORDER BY rank) - slots)::BIGINT AS ahead FROM wanted),
each AS (SELECT rank, n, ahead + unnest(range(slots)) AS i FROM numbered),
shards AS (SELECT rank, {_sql_permuted('i', 'n', '0')} // {SHARD_SLOTS} AS shard FROM each),
ordinals AS (SELECT rank, row_number() OVER (PARTITION BY rank ORDER BY shard) - 1 AS ordinal FROM shards),
at_index AS (SELECT rank, ordinal // blocks AS time, ordinal % blocks AS index, whole, rest, blocks - CASE WHEN source_size % {BLOCK} > 0 THEN 1 ELSE 0 END AS even
             FROM ordinals JOIN wanted USING (rank)),
chosen AS (SELECT rank, CASE WHEN index < even THEN {_sql_permuted('index', 'greatest(even, 1)', f'rank * {MOST + 1} + time + 1')} ELSE index END AS block,
                  CASE WHEN time < whole THEN {BLOCK} ELSE least({BLOCK}, rest - index * {BLOCK}) END AS words FROM at_index),
placed AS (SELECT doc_id, size, rank, source_size, target, (sum(size) OVER (PARTITION BY rank ORDER BY doc_id) - size)::BIGINT AS start
           FROM doc JOIN plan ON doc.source IS NOT DISTINCT FROM plan.source),
parts AS (SELECT doc_id, size, rank, start, unnest(range(start // {BLOCK}, (start + size - 1) // {BLOCK} + 1)) AS block FROM placed WHERE size > 0),
mix AS (SELECT doc_id, greatest(least(start + size, block * {BLOCK} + words) - greatest(start, block * {BLOCK}), 0) AS n_words FROM parts JOIN chosen USING (rank, block))
SELECT doc_id, size, source_size, target, coalesce(n, 0)::BIGINT AS taken FROM placed LEFT JOIN (SELECT doc_id, sum(n_words) AS n FROM mix GROUP BY doc_id) USING (doc_id)
"""
