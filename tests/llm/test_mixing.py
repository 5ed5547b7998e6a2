import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clinspark.llm import mixing as mx
from clinspark.llm.queries import ORACLES, QUERIES


def reshared(sizes, share=1.5, most=2.0):
    """Targets by resharing what is above the bound, source after source; ``sizes`` in the order of the sources."""
    weight = [(3, 1, 2)[i % 3] for i in range(len(sizes))]
    open_, left, out = set(range(len(sizes))), share * sum(sizes), [0.0] * len(sizes)
    while open_:
        level = left / sum(weight[i] for i in open_)
        over = {i for i in open_ if level * weight[i] > most * sizes[i]}
        for i in over or open_:
            out[i] = most * sizes[i] if over else level * weight[i]
        if not over:
            break
        left -= sum(most * sizes[i] for i in over)
        open_ -= over
    return out


def words(text):
    import re

    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def check(rows, got, slack=1):
    """``got`` has one row for each of ``rows`` (doc_id, text, source), with the right sizes and targets."""
    size, named = defaultdict(int), defaultdict(list)
    for i, t, s in rows:
        size[s] += words(t)
        named[s].append((i, words(t)))
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [s for s in size if s is None]
    target = dict(zip(order, reshared([size[s] for s in order])))
    want = Counter((i, n, size[s]) for s in named for i, n in named[s])
    assert Counter((r["doc_id"], r["size"], r["source_size"]) for r in got) == want
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    by_target = {}
    for s in order:
        assert any(r["target"] == pytest.approx(target[s]) and r["source_size"] == size[s] for r in got)
        by_target.setdefault((size[s], round(target[s], 6)), 0)
        by_target[size[s], round(target[s], 6)] += target[s]
    for (whole, wanted), all_of in by_target.items():
        total = sum(r["taken"] for r in got if r["source_size"] == whole and r["target"] == pytest.approx(wanted))
        assert abs(total - all_of) <= slack * max(1, round(all_of / max(wanted, 1e-9)))


def some(seed, n=300):
    rng = random.Random(seed)
    names = ["b", "a", "é", "Z", "", None, "hot"]
    return [(i, " ".join("w" * rng.randint(0, 1 if rng.random() < 0.1 else 120)).strip() or None, "hot" if rng.random() < 0.4 else rng.choice(names)) for i in range(n)]


def run(spark, rows, **how):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, size int, rank string").repartition(4)
    placed = mx.placed_documents(frame)
    mix = mx.mixed(placed, **how)
    return mx.taken(placed, mix).collect(), mix


@pytest.mark.parametrize("block", [1, 7, 64])
def test_targets_and_words(spark, block):
    rows = some(block) + [(None, "no id " * 9, "a"), (None, "no id " * 9, "a"), (3, "again " * 5, "b"), (3, "again " * 5, "b"), (900, "long " * 5000, None)]
    got, mix = run(spark, rows, block=block, shard_slots=16)
    check(rows, got)
    slot = mix.groupBy("rank", "ordinal").agg(F.sum("n_words").alias("n"), F.count_distinct("shard").alias("s")).collect()
    assert all(r["n"] <= block and r["s"] == 1 for r in slot)
    shards = mix.groupBy("shard").agg(F.count_distinct(F.struct("rank", "ordinal")).alias("n")).collect()
    assert sorted(r["n"] for r in shards)[1:] == [16] * (len(shards) - 1)


def test_odd_tables(spark):
    assert run(spark, [])[0] == []
    check([(1, None, None), (2, "", "a")], run(spark, [(1, None, None), (2, "", "a")])[0])
    one = [(1, "only one source here", "a")]
    check(one, run(spark, one)[0])
    small = [(i, "w " * n, s) for i, (n, s) in enumerate([(1, "a"), (1, "b"), (1, "c"), (100_000, "d"), (3, "e")])]
    check(small, run(spark, small)[0])


def order(spark, n, seed):
    rounds = mx.round_numbers(F.lit(n).cast("long"), F.lit(seed).cast("long"))
    return [r["p"] for r in spark.range(n).select("id", mx.permuted(F.col("id"), F.lit(n), rounds).alias("p")).orderBy("id").collect()]


def test_permutations(spark):
    for n in (1, 2, 3, 10, 257, 1000):
        for seed in (0, 1, 12345):
            assert sorted(order(spark, n, seed)) == list(range(n))
    n = 4000
    got = order(spark, n, 5)
    half = sum(p < n / 2 for p in got[: n // 2])
    assert abs(half - n / 4) < 5 * (n / 16) ** 0.5
    assert abs(sum(a < b for a, b in zip(got, got[1:])) - n / 2) < 5 * (n / 4) ** 0.5


def test_shards_are_drawn_by_weight(spark):
    rows = [(i, "w " * 100, s) for i, s in enumerate(["a"] * 300 + ["b"] * 300 + ["c"] * 300)]
    got, mix = run(spark, rows, block=10, shard_slots=100)
    check(rows, got)
    counts = mix.groupBy("shard", "rank").agg(F.count_distinct("ordinal").alias("n")).collect()
    # the first source is at its bound, the others share the rest one to two
    for rank, share in ((0, 4 / 9), (1, 5 / 27), (2, 10 / 27)):
        per = [r["n"] for r in counts if r["rank"] == rank]
        mean, spread = sum(per) / len(per), 100 * share * (1 - share)
        variance = sum((x - mean) ** 2 for x in per) / len(per)
        assert abs(mean - 100 * share) < 2 and spread / 2 < variance < spread * 2


def test_reruns_and_partitions(spark):
    rows = some(8)
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    results = []
    for n in (1, 7):
        placed = mx.placed_documents(frame.repartition(n))
        results.append(sorted(map(tuple, mx.mixed(placed, 16).collect())))
    assert results[0] == results[1]


def test_many_sources_by_shuffle(spark, monkeypatch):
    rows = some(11)
    wanted = sorted(map(tuple, run(spark, rows)[0]), key=str)
    monkeypatch.setattr(mx, "BROADCAST_ROWS", 0)
    monkeypatch.setattr("clinspark.llm.skew.HOT_ROWS", 50)
    assert sorted(map(tuple, run(spark, rows)[0]), key=str) == wanted


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_mixing"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    check(rows, QUERIES["op13_mixing"](spark, folder).collect())
    assert "op13_mixing" in ORACLES
