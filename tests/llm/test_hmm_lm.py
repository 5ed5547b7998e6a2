import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_brute import byte_words
from pyspark.sql import functions as F

from clinspark.llm import hmm_lm as lm
from clinspark.llm.queries import QUERIES


def model(states=3, size=5, seed=0):
    rng = np.random.default_rng(seed)
    some = lambda *shape: (x := rng.random(shape) + 0.05) / x.sum(axis=-1, keepdims=True)
    return lm.Hmm(some(states), some(states), some(states, states), some(states, size))


def test_forward_and_expected_counts_equal_enumeration():
    hmm = model()
    sequence = np.array([0, 3, 1, 4])
    paths = np.array(np.meshgrid(*[range(3)] * 4)).reshape(4, -1).T
    weight = [hmm.start[p[0]] * hmm.emits[p[0], sequence[0]] * math.prod(hmm.moves[p[t - 1], p[t]] * hmm.emits[p[t], sequence[t]] for t in range(1, 4)) for p in paths]
    alive, begins = np.ones(4, int), np.array([True])
    assert math.isclose(np.prod([scale[0] for _, _, _, scale in lm._forward(hmm, alive, sequence, begins)]), sum(weight))
    share = np.array(weight) / sum(weight)
    start, seen, moves, emits = lm._expected(hmm, alive, sequence, begins)
    assert np.allclose(start, [share[paths[:, 0] == k].sum() for k in range(3)]) and math.isclose(seen.sum(), 4)
    assert np.allclose(moves, [[sum(share[(paths[:, t] == i) & (paths[:, t + 1] == j)].sum() for t in range(3)) for j in range(3)] for i in range(3)])
    assert np.allclose(emits[:, 3], [share[paths[:, 1] == k].sum() for k in range(3)])


def test_groups_of_sequences_give_the_same_as_single_ones():
    hmm, rng = model(), np.random.default_rng(1)
    texts = [rng.integers(0, 5, n).tolist() for n in (1, 9, 2, 30, 1, 17)]
    batch = pa.RecordBatch.from_pydict({"symbols": pa.array(texts, pa.list_(pa.int16()))})
    found = np.zeros(len(texts))
    total = [np.zeros(3), np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5))]
    for rows, alive, symbols, first in lm._sequences(batch, None):
        for _, _, _, scale in lm._forward(hmm, alive, symbols, first):
            found[rows[: len(scale)]] += np.log(scale)
        total = [a + b for a, b in zip(total, lm._expected(hmm, alive, symbols, first))]
    single = [np.zeros_like(a) for a in total]
    for i, t in enumerate(texts):
        alone = np.ones(len(t), int), np.array(t), np.array([True])
        assert math.isclose(found[i], sum(np.log(scale[0]) for _, _, _, scale in lm._forward(hmm, *alone)))
        single = [a + b for a, b in zip(single, lm._expected(hmm, *alone))]
    assert all(np.allclose(a, b) for a, b in zip(total, single))
    cut = [(r, f) for rows, _, _, first in lm._sequences(batch, 8) for r, f in zip(rows.tolist(), first.tolist())]
    assert Counter(r for r, _ in cut) == {0: 1, 1: 2, 2: 1, 3: 4, 4: 1, 5: 3} and sum(f for _, f in cut) == 6


@pytest.mark.parametrize("head", [lm.HEAD, 6])
def test_scores(spark, head):
    """With the small head most words come by the join."""
    texts = ["the cat sat", "The dog sat on the mat", None, "", "cat cat\tcat dog unseen words", "zzz zzz", "Ä ä\x0bb", "the cat sat"]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(None, "the", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    train = F.col("doc_id").isin(0, 1, 2, 6)
    got = lm.scored(frame, train, states=2, rounds=3, symbols=4, head=head).toPandas()
    counts = Counter(w for i in (0, 1, 2, 6) for w in [*byte_words(texts[i]), b" "])
    n, v = sum(counts.values()), len(counts)
    for i, text in [*enumerate(texts), (None, "the")]:
        row = got[got["id"].isna()].iloc[0] if i is None else got[got["id"] == i].iloc[0]
        tokens = [*byte_words(text), b" "]
        assert row["n_tokens"] == len(tokens) and row["n_known"] == sum(t in counts for t in tokens) and row["train_tokens"] == n
        assert math.isclose(row["base_score"], sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), rel_tol=1e-9)
        assert row["score"] < 0


def test_probabilities_of_one_token_add_up(spark):
    """Over all known words, the unseen word of each class and the end, the model's probabilities of a first token are at most one."""
    train = spark.createDataFrame([(1, "a b c d e f g a b a", True), (2, "aa bb cc a a", True)], "id long, text string, train boolean")
    vocab = lm.vocabulary(train, "text", 4, 6)
    share = np.concatenate([vocab.head_counts[: vocab.symbols] + 1, vocab.class_tokens + 1])
    hmm = lm.baum_welch(lm.encoded(train, vocab), vocab.size, share / share.sum(), 2, 2)
    first = hmm.start @ hmm.emits
    words = [bytes(r["w"]) for r in vocab.counts.collect()]
    seen = Counter(dict((bytes(r["w"]), r["n"]) for r in vocab.counts.collect()))
    total = first[: vocab.symbols].sum()
    for c in range(lm.CLASSES):
        inside = [w for w in words if w not in vocab.head[: vocab.symbols] and lm.class_of(w) == c]
        total += first[vocab.symbols + c] * sum(seen[w] + 1 for w in [*inside, b"never"]) / 10 ** vocab.class_logs[c]
    assert math.isclose(total, 1.0)


def scores(frame, **how):
    return {r["id"]: r["score"] for r in lm.scored(frame, F.col("doc_id") % 5 != 0, **how).collect()}


def test_scores_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(docs.filter("doc_id < 40").withColumn("doc_id", F.col("doc_id") + 10**6))
    found = [scores(docs.repartition(n), symbols=500, rounds=3) for n in (1, 7, 61)]
    for other in found[1:]:
        assert other.keys() == found[0].keys() and all(math.isclose(other[k], v, rel_tol=1e-9) for k, v in found[0].items())


def test_short_texts_are_learned_too(spark):
    rng = np.random.default_rng(3)
    topics = [[f"{t}word{i}" for i in range(6)] for t in "abcdefgh"]
    rows = [(i, " ".join(rng.choice(topics[rng.integers(8)], 4))) for i in range(600)]
    got = lm.scored(spark.createDataFrame(rows, "doc_id long, text string"), F.col("doc_id") % 5 != 0).toPandas()
    held = got[got["id"] % 5 == 0]
    assert held["score"].sum() > held["base_score"].sum() + 0.1 * held["n_tokens"].sum()


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lm.scored(empty, F.lit(True)).count() == 0
    nothing = lm.scored(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), F.lit(False)).first()
    assert nothing["n_known"] == 0 and nothing["train_tokens"] == 0 and nothing["base_score"] == 0.0 and nothing["score"] < 0


def test_query_beats_the_base_on_held_out_texts(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op7_hmm_lm"](spark, folder).toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 7 == 2 for i in got["doc_id"]]).all()
    held = got[got["held_out"]]
    assert held["score"].sum() > held["base_score"].sum() + 0.2 * held["n_tokens"].sum()
