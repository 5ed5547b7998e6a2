"""The trie of conversation prefixes, with totals over every subtree by parallel tree contraction.

A node stands for a sequence of turns that some conversation begins with.  Sequences are told apart by 128 bits of hash, summed
up turn by turn by exclusive-or, so that a conversation may be cut anywhere.  Contraction then alternates two steps until only the root
is left: *rake* adds all leaves to their parents, *compress* takes nodes with a single child out of their chain, never two neighbours
at once.  Both halve what they work on, so a chain of any length takes a logarithm of rounds.  In the way back each node that
compress took out gets its total from the node below it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.ranks import running
from clinspark.llm.skew import join_unique
from clinspark.llm.store import stored
from clinspark.llm.workers import map_pandas

#: Tables up to this many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 200_000
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


# ---------------------------------------------------------------- turns


def numbered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, pos, digest, n_bytes)``: the turns of each conversation counted from 1 in ascending order of ``turn``, null first; equal
    ones follow each other by role and then by their digest.  Null roles and texts are empty; rows without a conversation are left out.

    ``digest`` is the SHA-256 of role and text, ``n_bytes`` the length of the text in UTF-8."""
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), who.alias("role"),
        F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)).alias("digest"),
        F.octet_length(said).cast("long").alias("n_bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    placed = running(rows, ["conv_id"], order, {"pos": ("sum", F.lit(1))}, "turns")
    return placed.select("conv_id", (F.col("pos") + 1).alias("pos"), "digest", "n_bytes")


def rebuilt(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Numbered turns of the conversations ``ids``, each begun by the turns of another: conversation ``c`` takes the first ``h`` turns of
    ``c - c % 5`` and its own after the first ``h``, with ``h = crc32(c) % 9``."""
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).alias("h")
    base = F.col("conv_id") - F.col("conv_id") % 5
    own = turns.withColumns({"h": head, "base": base})
    lent = ids.select("conv_id", head, base.alias("base")).filter("base <> conv_id and h > 0")
    first = turns.filter("pos <= 8").select(F.col("conv_id").alias("base"), "pos", "digest", "n_bytes")
    heads = lent.join(first, "base").filter("pos <= h").select("conv_id", "pos", "digest", "n_bytes")
    # only where the other conversation is too short do own turns move up
    held = first.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    short = stored(
        lent.join(held, "base", "left").select("conv_id", (F.col("h") - F.coalesce("held", F.lit(0))).alias("missing")).filter("missing > 0"), "short-heads"
    )
    if short.count() <= BROADCAST_ROWS:
        short = F.broadcast(short)
    tails = (
        own.filter("base = conv_id or pos > h").join(short, "conv_id", "left")
        .select("conv_id", (F.col("pos") - F.coalesce("missing", F.lit(0))).alias("pos"), "digest", "n_bytes")
    )
    return heads.unionByName(tails)


# ---------------------------------------------------------------- nodes


def _nodes(turns: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)``: all nodes with the hash of their parent, and for each conversation the node at which it ends."""
    keyed = turns.withColumns({"h1": F.xxhash64("pos", "digest"), "h2": F.xxhash64("digest", "pos", F.lit(1))})
    keyed = running(keyed, ["conv_id"], [F.col("pos").asc()], {"p1": ("bit_xor", F.col("h1")), "p2": ("bit_xor", F.col("h2"))}, "prefixes")
    keyed = stored(
        keyed.select("conv_id", F.col("pos").alias("depth"), F.col("p1").bitwiseXOR(F.col("h1")).alias("k1"), F.col("p2").bitwiseXOR(F.col("h2")).alias("k2"), "p1", "p2", "n_bytes"),
        "keyed-turns",
    )
    nodes = keyed.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("n_bytes").alias("n_bytes")
    )
    zero = F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = root.select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("p1"), zero.alias("p2"), zero.alias("n_bytes"))
    last = keyed.groupBy("conv_id").agg(F.max(F.struct("depth", "k1", "k2")).alias("e")).select("conv_id", "e.*")
    ends = ids.join(last, "conv_id", "left").select("conv_id", *(F.coalesce(c, zero).alias(c) for c in ("depth", "k1", "k2")))
    return stored(nodes.unionByName(root), "nodes"), ends


def _ends_digests(ends: DataFrame) -> DataFrame:
    """``(depth, k1, k2, ends_sha256)``: of every node at which conversations end, the digest of their ids.

    A digest of very many ids can only be taken one after the other, but their texts are joined before in pieces, one for a node and a range
    of ids, so that one task never reads the ids of a hot node row by row, nor holds more than a piece."""
    node = ["depth", "k1", "k2"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, texts = batch[node].to_numpy(), batch["conv_id"].astype(str).tolist()
            begins = np.flatnonzero(np.concatenate(([len(keys) > 0], (keys[1:] != keys[:-1]).any(axis=1))))
            made = batch.iloc[begins].rename(columns={"conv_id": "first"})
            yield made.assign(piece=[",".join(texts[a:b]) for a, b in zip(begins, [*begins[1:], len(texts)], strict=True)])

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for batch in batches:
            out = []
            for *key, piece in zip(*(batch[c] for c in node), batch["piece"], strict=True):
                if key != now:
                    if state:
                        out.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(piece.encode())
                else:
                    state.update(b"," + piece.encode())
            if out:
                yield pd.DataFrame(out, columns=[*node, "ends_sha256"])
        if state:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*node, "ends_sha256"])

    schema = "depth long, k1 long, k2 long, "
    ranged = ends.repartitionByRange(*node, "conv_id").sortWithinPartitions(*node, "conv_id")
    cut = map_pandas(ranged.select(*node, "conv_id"), pieces, schema + "first long, piece string")
    return map_pandas(cut.repartition(*node).sortWithinPartitions(*node, "first").drop("first"), digests, schema + "ends_sha256 string")


# ---------------------------------------------------------------- contraction


def _rank(c: Column, d: Column, turn: int) -> Column:
    """Of neighbours in a chain the one of lesser rank is taken out first.  The lowest bits of the depth come first, so that of a whole chain every second
    node goes in each round; what is level by them is decided by a hash that changes with the round."""
    zeros = F.when(d == 0, 99).otherwise(F.bit_count(d.bitwiseAND(-d) - 1))
    return F.struct(zeros, F.xxhash64(c, d, F.lit(turn)), c, d)


def subtree_sums(tree: DataFrame, values: list[str], name: str = "tree") -> DataFrame:
    """``(c, d, *values)``: for every node of a forest the sum of each value over the node and all below it.

    ``tree`` has ``c`` and ``d``, two longs that name a node, ``pc`` and ``pd``, those of its parent (null: a root), and the long columns ``values``.
    A node's ``d`` is one more than its parent's.  Every round writes what is left of the tree; a node may have any number of children, as sums over
    them are combined before the shuffle, and a chain may have any length."""
    zero = F.lit(0).cast("long")
    kids = tree.filter("pc is not null").groupBy("pc", "pd").agg(F.count(F.lit(1)).alias("kids")).select(F.col("pc").alias("c"), F.col("pd").alias("d"), "kids")
    state = stored(
        tree.join(kids, ["c", "d"], "left").select(
            "c", "d", "pc", "pd", F.coalesce("kids", zero).alias("kids"),
            *(F.col(v).alias(f"a_{v}") for v in values), *(zero.alias(f"e_{v}") for v in values),
        ),
        name,
    )
    ready: list[DataFrame] = []  # totals known in each round
    taken: list[DataFrame] = []  # nodes taken out, with the node below them and what they add to its total
    while True:
        turn = len(taken)
        # rake: leaves are done, their totals go to their parents
        leaves = state.filter("kids = 0")
        ready.append(leaves.select("c", "d", *(F.col(f"a_{v}").alias(v) for v in values)))
        raked = leaves.filter("pc is not null").select(F.col("pc").alias("c"), F.col("pd").alias("d"), *((F.col(f"a_{v}") + F.col(f"e_{v}")).alias(f"r_{v}") for v in values))
        raked = raked.groupBy("c", "d").agg(F.count(F.lit(1)).alias("gone"), *(F.sum(f"r_{v}").alias(f"r_{v}") for v in values))
        inner = state.filter("kids > 0")
        if inner.isEmpty():
            break
        inner = stored(
            inner.join(raked, ["c", "d"], "left").select(
                "c", "d", "pc", "pd", (F.col("kids") - F.coalesce("gone", zero)).alias("kids"),
                *((F.col(f"a_{v}") + F.coalesce(f"r_{v}", zero)).alias(f"a_{v}") for v in values), *(f"e_{v}" for v in values),
            ),
            name,
        )
        # compress: of the nodes with one child left, those of lesser rank than both neighbours
        only = (
            inner.filter("pc is not null").groupBy("pc", "pd")
            .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("c", "d", *(f"e_{v}" for v in values))).alias("x")).filter("n = 1")
            .select(F.col("pc").alias("c"), F.col("pd").alias("d"), "x")
        )
        rank = _rank(F.col("c"), F.col("d"), turn)
        out = stored(
            inner.filter("kids = 1 and pc is not null").join(only, ["c", "d"])
            .filter((rank < _rank(F.col("pc"), F.col("pd"), turn)) & (rank < _rank(F.col("x.c"), F.col("x.d"), turn)))
            .select(
                "c", "d", F.col("pc").alias("up_c"), F.col("pd").alias("up_d"), F.col("x.c").alias("x_c"), F.col("x.d").alias("x_d"),
                *((F.col(f"a_{v}") + F.col(f"x.e_{v}")).alias(f"t_{v}") for v in values),
                *((F.col(f"e_{v}") + F.col(f"a_{v}") + F.col(f"x.e_{v}")).alias(f"n_{v}") for v in values),
            ),
            f"{name}-taken",
        )
        taken.append(out)
        moved = out.select(F.col("x_c").alias("c"), F.col("x_d").alias("d"), "up_c", "up_d", *(f"n_{v}" for v in values))
        state = stored(
            inner.join(out.select("c", "d"), ["c", "d"], "left_anti").join(moved, ["c", "d"], "left").select(
                "c", "d", F.coalesce("up_c", "pc").alias("pc"), F.coalesce("up_d", "pd").alias("pd"), "kids",
                *(f"a_{v}" for v in values), *(F.coalesce(f"n_{v}", f"e_{v}").alias(f"e_{v}") for v in values),
            ),
            name,
        )
    # the way back: what a round took out hangs on nodes that were done in later rounds
    known = ready.pop()
    for out, done in zip(reversed(taken), reversed(ready), strict=True):
        below = known.select(F.col("c").alias("x_c"), F.col("d").alias("x_d"), *values)
        back = stored(out.join(below, ["x_c", "x_d"]).select("c", "d", *((F.col(f"t_{v}") + F.col(v)).alias(v) for v in values)), f"{name}-back")
        known = reduce(DataFrame.unionByName, [known, back, done])
    return known


# ---------------------------------------------------------------- trie


def prefix_trie(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """One row for each node: ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id`` (that of the parent, null at the root), ``n_convs``
    (members), ``n_children``, ``n_leaves`` (childless nodes of the subtree, the top included), ``saved_tokens`` (bytes of the last text
    for each member but one, over the subtree) and ``ends_sha256`` (of the ids of members that end here).

    ``turns`` are numbered turns, ``ids`` the conversations (``conv_id``, each once, none null), of which some may have no turn.
    The root has no turn and holds all conversations; without any conversation there is no row."""
    node = ["depth", "k1", "k2"]
    nodes, ends = _nodes(turns, ids)
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    top = nodes.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    placed = stored(join_unique(nodes.filter("depth > 0"), above, ["depth", "p1", "p2"]).unionByName(top), "placed-nodes")
    parents = placed.filter("depth > 0").groupBy("parent_conv_id", "depth").agg(F.count(F.lit(1)).alias("n_children"))
    parents = parents.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children")
    counted = stored(
        placed.join(parents, ["conv_id", "depth"], "left").join(_ends_digests(ends), node, "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "n_bytes",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
        ),
        "counted-nodes",
    )
    tree = counted.select(
        F.col("conv_id").alias("c"), F.col("depth").alias("d"), F.col("parent_conv_id").alias("pc"), F.when(F.col("depth") > 0, F.col("depth") - 1).alias("pd"),
        (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"]).withColumnsRenamed({"c": "conv_id", "d": "depth"})
    return counted.join(sums, ["conv_id", "depth"]).select(*(c.split()[0] for c in NODES.split(", ")))


def conversation_ids(turns: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    return stored(turns.filter(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id")).distinct(), "conversations")


_CRC32 = """xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""

ORACLE = f"""
WITH turn AS (
  SELECT conv_id, role, text, item, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, item) AS pos FROM (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
           sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS item FROM conversations WHERE conv_id IS NOT NULL)),
held AS (SELECT conv_id, count(*) AS n FROM turn GROUP BY conv_id),
conv AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {_CRC32} % 9 AS h FROM held),
plan AS (SELECT conv.*, least(h, coalesce(n, 0)) AS lent FROM conv LEFT JOIN held ON held.conv_id = conv.base),
rebuilt AS (
  SELECT plan.conv_id, pos, item, text FROM plan JOIN turn ON turn.conv_id = base AND pos <= h WHERE base <> plan.conv_id
  UNION ALL SELECT plan.conv_id, lent + pos - h, item, text FROM plan JOIN turn ON turn.conv_id = plan.conv_id AND pos > h WHERE base <> plan.conv_id
  UNION ALL SELECT plan.conv_id, pos, item, text FROM plan JOIN turn ON turn.conv_id = plan.conv_id WHERE base = plan.conv_id),
path AS (
  SELECT conv_id, pos AS depth, sha256(string_agg(item, '') OVER (PARTITION BY conv_id ORDER BY pos)) AS k, strlen(text) AS n_bytes FROM rebuilt
  UNION ALL SELECT conv_id, 0, '', 0 FROM conv),
linked AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS pk, lead(k) OVER (PARTITION BY conv_id ORDER BY depth) AS nk FROM path),
node AS (SELECT depth, k, any_value(pk) AS pk, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n_bytes) AS n_bytes, count(DISTINCT nk) AS n_children,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE nk IS NULL), '')) AS ends_sha256
         FROM linked GROUP BY depth, k),
total AS (SELECT path.depth, path.k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * node.n_bytes)::BIGINT AS saved_tokens
          FROM node JOIN path ON path.conv_id = node.conv_id AND path.depth <= node.depth GROUP BY path.depth, path.k)
SELECT node.conv_id, node.depth::BIGINT AS depth, parent.conv_id AS parent_conv_id, node.n_convs, node.n_children, n_leaves, saved_tokens, node.ends_sha256
FROM node JOIN total ON node.depth = total.depth AND node.k = total.k LEFT JOIN node parent ON parent.depth = node.depth - 1 AND parent.k = node.pk
"""
