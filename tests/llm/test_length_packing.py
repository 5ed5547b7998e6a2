import itertools
import random

import numpy as np
import pytest
from llm_brute import byte_words, padding

from clinspark.llm import length_packing as lp
from clinspark.llm.queries import QUERIES


@pytest.mark.parametrize("seed", range(25))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 8)))
    counts = [rng.randint(1, 9) for _ in lengths]
    every = [n for n, c in zip(lengths, counts) for _ in range(c)]
    buckets = rng.randint(1, 4)
    found = lp.best_bounds(np.array(lengths), np.array(counts), buckets)
    best = min(padding(every, [*c, lengths[-1]]) for k in range(min(buckets, len(lengths))) for c in itertools.combinations(lengths[:-1], k))
    assert len(found) <= buckets and found == sorted(found) and padding(every, found) == best


def check(rows, got, buckets, max_tokens, budget):
    pieces = []
    for i, t in rows:
        n, k = len(byte_words(t)) + 1, 0
        while n > 0:
            pieces.append((i, k, min(n, max_tokens)))
            n, k = n - max_tokens, k + 1
    ids = [None if i != i else int(i) for i in got["doc_id"]]
    found = sorted(zip(ids, got["piece"], got["n_tokens"]), key=str)
    assert found == sorted(pieces, key=str)
    lengths = sorted({p[2] for p in pieces})
    bounds = lp.best_bounds(np.array(lengths), np.array([sum(p[2] == n for p in pieces) for n in lengths]), buckets)
    for bound in bounds:
        inside = got[got["bucket_tokens"] == bound].sort_values(["batch", "slot"])
        assert (inside["n_tokens"] <= bound).all()
        rows_each = max(1, budget // bound)
        assert list(zip(inside["batch"], inside["slot"])) == [(k // rows_each, k % rows_each) for k in range(len(inside))]
        order = list(zip(inside["doc_id"].fillna(-1), inside["piece"]))
        assert order == sorted(order)
    assert set(got["bucket_tokens"]) <= set(bounds)


def test_rows(spark):
    rng = random.Random(3)
    rows = [(i * 997, " ".join("w" for _ in range(rng.randint(0, 30)))) for i in range(200)]
    rows += [(5, None), (6, ""), (6, ""), (7, "x " * 1000), (None, "a b"), (10**12, "a")]
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, piece int, batch string")
    got = lp.packed(frame, buckets=4, max_tokens=16, token_budget=64).toPandas()
    check(rows, got, 4, 16, 64)
    assert lp.packed(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    check(list(zip(docs["doc_id"], docs["text"])), QUERIES["op6_length_packing"](spark, folder).toPandas(), 8, 2048, 65_536)
