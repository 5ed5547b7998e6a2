import hashlib
import random
import zlib

import pytest

from clinspark.llm import prefix_trie as pt
from clinspark.llm.queries import QUERIES
from clinspark.llm.ranks import running
from clinspark.llm.skew import join_unique


def rebuilt(rows):
    """Turns of each conversation by the contract; ``rows`` are (conv_id, turn, role, text)."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            convs.setdefault(c, []).append(((turn is not None, turn or 0), role, digest, text))
    convs = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in convs.items()}
    out = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(c - int(c / 5) * 5)
        out[c] = convs.get(base, [])[:h] + convs[c][h:]
    return out


def trie(convs):
    """The nodes by plain recursion over all prefixes."""
    nodes = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        kids = [k for k in below if len(k) == len(key) + 1]
        leaves = sum(not any(len(o) == len(k) + 1 and o[: len(k)] == k for o in below) for k in below)
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in members if len(convs[c]) == len(key))))
        rows.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), len(kids), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


ODD = [
    (0, 0, "user", "a"), (0, None, None, None), (0, 1, "user", "b"), (0, 1, "user", "b"), (0, 1, "assistant", "b"),
    (1, 3, "user", "x"), (2, 0, "user", "a"), (5, 0, "user", ""), (6, 0, "", ""), (7, 0, None, None), (9, 2, "user", "é" * 5000),
    (None, 0, "user", "lost"), (23, 0, "user", "a"), (24, 0, "user", "a"), (-3, 0, "user", "a"), (-3, 1, "user", "b"), (10**15 + 1, 0, "user", "a"),
]


def run(spark, rows, extra=False):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    ids = pt.conversation_ids(frame)
    return found(pt.prefix_trie(pt.rebuilt(pt.numbered_turns(frame), ids), ids))


def test_odd_rows(spark):
    assert run(spark, ODD) == trie(rebuilt(ODD))
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []


def test_random_conversations(spark):
    rng = random.Random(4)
    rows = [(c, t, rng.choice("ua"), rng.choice(["x", "y", "zz"])) for c in rng.sample(range(400), 150) for t in range(rng.randint(0, 11))]
    assert run(spark, rows) == trie(rebuilt(rows))


def test_long_chains_and_hot_nodes(spark):
    rows = [(0, t, "u", f"t{t}") for t in range(150)] + [(100, t, "u", f"t{t}") for t in range(90)] + [(100, 90, "u", "other")]
    rows += [(c, 0, "u", "hello") for c in range(500, 900, 5)]
    assert run(spark, rows) == trie(rebuilt(rows))


@pytest.mark.parametrize("shape", ["random", "chain", "star", "comb"])
def test_subtree_sums(spark, shape):
    rng = random.Random(shape)
    n = 200
    up = {"random": lambda i: rng.randrange(i), "chain": lambda i: i - 1, "star": lambda i: 0, "comb": lambda i: max(0, i - 1 - i % 2)}[shape]
    parent = [None] + [up(i) for i in range(1, n)]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    value = [rng.randint(-5, 9) for _ in range(n)]
    want = list(value)
    for i in range(n - 1, 0, -1):
        want[parent[i]] += want[i]
    data = [(i, depth[i], parent[i], depth[parent[i]] if i else None, value[i]) for i in range(n)]
    tree = spark.createDataFrame(data, "c long, d long, pc long, pd long, v long")
    got = {r["c"]: r["v"] for r in pt.subtree_sums(tree, ["v"]).collect()}
    assert got == dict(enumerate(want))


def test_running_and_hot_joins(spark, monkeypatch):
    rng = random.Random(9)
    data = [(rng.choice(["hot", "hot", "cold", None]), rng.randint(0, 5), rng.randint(0, 99)) for _ in range(900)]
    frame = spark.createDataFrame(data, "k string, o int, v long").repartition(5)
    from pyspark.sql import functions as F

    got = running(frame, ["k"], [F.col("o").desc()], {"n": ("sum", F.lit(1)), "x": ("bit_xor", F.col("v"))}, "t").collect()
    for k in {d[0] for d in data}:
        mine = sorted((r for r in got if r["k"] == k), key=lambda r: r["n"])
        assert [r["n"] for r in mine] == list(range(len(mine))) and [r["o"] for r in mine] == sorted((r["o"] for r in mine), reverse=True)
        seen = 0
        for r in mine:
            assert r["x"] == seen
            seen ^= r["v"]
    monkeypatch.setattr("clinspark.llm.skew.HOT_ROWS", 100)
    one = spark.createDataFrame([("hot", 1), ("cold", 2), ("none", 3)], "k string, w int")
    joined = join_unique(frame.filter("k is not null"), one, ["k"])
    assert joined.count() == sum(d[0] is not None for d in data) and joined.filter("(k = 'hot') <> (w = 1)").isEmpty()


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op11_prefix_trie"](spark, folder)) == trie(rebuilt(rows))
