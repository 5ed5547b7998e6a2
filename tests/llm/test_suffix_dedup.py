import random

import numpy as np
import pytest
from llm_brute import repeats

from clinspark.llm import suffix_dedup as sd


def texts_of(rng, n, alphabet="ab "):
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    made += [made[0] + "X" + made[1], made[2], made[2] + "é" + made[3], "a" * 60, "ab" * 30, "", None]
    return made


@pytest.mark.parametrize("seed", range(40))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    pieces = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 50))).encode() for _ in range(rng.randint(1, 7))]
    pieces += [pieces[0], b"a" * 30]
    codes = np.frombuffer(b"\xff".join(pieces) + b"\xff", np.uint8) + np.uint8(1)
    depth, data = rng.choice([3, 8, 13, 60]), codes.tobytes()
    order = sd.suffix_array(codes, depth)
    assert sorted(order.tolist()) == list(range(len(codes)))
    cut = [data[i : i + depth] for i in order]
    assert cut == sorted(cut)
    for k, found in enumerate(sd.common_prefixes(codes, order, depth)[1:], 1):
        a, b, n = order[k - 1], order[k], 0
        while n < depth and data[a + n] == data[b + n] != 0:
            n += 1
        assert n == found


@pytest.mark.parametrize("gram", [3, 7, 12])
def test_runs_hold_every_window_once_and_equal_windows_share_a_key(gram):
    rng = random.Random(gram)
    data = [t.encode() for t in texts_of(rng, 6) if t]
    keys = {}
    for d in data:
        starts = []
        for p, m, key, several in sd.runs(d, 12, gram):
            starts += range(p, p + m)
            windows = [d[i : i + 12] for i in range(p, p + m)]
            assert several or len(set(windows)) == m
            for w in windows:
                assert keys.setdefault(w, key) == key
        assert starts == list(range(max(0, len(d) - 11)))


def test_long_runs_are_cut():
    found = list(sd.runs(b"a" * 20_000, 400, 100))
    assert max(m for _, m, _, _ in found) == sd.RUN_LIMIT and sum(m for _, m, _, _ in found) == 20_000 - 399
    assert all(s for _, m, _, s in found if m > 1)


@pytest.mark.parametrize("key_limit", [sd.KEY_LIMIT, 1])
def test_removal_equals_brute_force(spark, key_limit):
    """With the small limit every mixed key counts as hot and is cut again, down to whole windows."""
    texts = texts_of(random.Random(7), 25)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, key string, n_bytes int")
    got = sd.without_repeats(frame, window=12, grams=(4, 9, 12), key_limit=key_limit).toPandas().set_index("id")
    for i, expected in enumerate(repeats(texts, 12)):
        assert tuple(got.loc[i, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]]) == expected, texts[i]


def test_nothing_is_lost_at_the_last_level(spark):
    """Periodic texts share a key down to whole windows, whatever the limit of the levels before."""
    texts = ["a" * 500, "a" * 600, "ab" * 300, "ab" * 301, "b" + "ab" * 250, "unlike " * 3]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sd.without_repeats(frame, key_limit=1).toPandas().set_index("id")
    for i, expected in enumerate(repeats(texts, 400)):
        assert tuple(got.loc[i, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]]) == expected
    assert got["n_removed"].tolist()[:2] == [500, 600]


def test_ids_may_repeat_or_be_null_and_tables_empty(spark):
    schema = "doc_id long, text string"
    frame = spark.createDataFrame([(1, "abcdefghijklmnop"), (1, "abcdefghijklmnop"), (None, "q" * 5), (None, None)], schema)
    got = sd.without_repeats(frame, window=12, grams=(4, 12)).toPandas()
    assert sorted(got["n_removed"]) == [0, 0, 16, 16] and got["id"].isna().sum() == 2
    assert sd.without_repeats(spark.createDataFrame([], schema)).count() == 0


def test_query_equals_brute_force(spark):
    from clinspark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = QUERIES["op1_suffix_dedup"](spark, folder).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    for i, expected in zip(docs["doc_id"], repeats(docs["text"], 400)):
        assert tuple(got.loc[i, ["n_bytes", "n_removed", "n_spans", "kept_sha256"]]) == expected
