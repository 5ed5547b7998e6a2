import random

import numpy as np
import pytest
from llm_brute import classes, near_copies, simhash

from clinspark.llm import simhash_tiles as st
from clinspark.llm.components import components


def test_fingerprint():
    for text in [None, "", " \n", "One", "one two  three", "a b c d", "The the THE the the ÉÉ é\x0bx", "x " * 50]:
        assert st.fingerprint(text, 4) == simhash(text)


def values(seed, n=150):
    """Random words, and others a few bits off."""
    rng = random.Random(seed)
    made = [rng.getrandbits(64) for _ in range(n // 3)]
    while len(made) < n:
        v = rng.choice(made)
        for _ in range(rng.randint(1, 7)):
            v ^= 1 << rng.randrange(64)
        made.append(v)
    return sorted(set(made))


@pytest.mark.parametrize("tile", [2048, 3])
def test_links_give_the_same_components(spark, tile):
    """The small tile splits nearly every group and plans more blocks."""
    found = values(tile)
    signed = np.array(found, np.uint64).view(np.int64).tolist()
    links = st.links(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, tile)
    got = {r["node"]: r["component"] for r in components(links).collect()}
    roots = classes(len(found), lambda i, j: (found[i] ^ found[j]).bit_count() <= 4)
    for i, a in enumerate(signed):
        for j, b in enumerate(signed[:i]):
            assert (got.get(a, a) == got.get(b, b)) == (roots[i] == roots[j])


@pytest.mark.parametrize("values_,blocks", [(10, 5), (10**7, 6), (10**12, 8)])
def test_more_values_need_more_blocks(values_, blocks):
    assert st._plan(values_, 4, 2048) == blocks


def test_components_of_long_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_edges_of_the_domain(spark):
    rows = [(5, None, 1), (6, "", 2), (7, "same words here now ok", 3), (7, "same words here now ok", 4), (None, "same words here now ok", 5), (9, "b" * 100_000, 6)]
    got = st.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert sorted((str(r["id"]), r["component_id"]) for r in got) == [("5", 5), ("6", 5), ("7", 7), ("7", 7), ("9", 9), ("None", 7)]
    assert st.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query_equals_brute_force(spark):
    from clinspark.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    got = QUERIES["op4_simhash_tiles"](spark, folder).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas().sort_values("doc_id")
    for i, (word, component) in zip(docs["doc_id"], near_copies(docs["doc_id"].tolist(), docs["text"].tolist())):
        assert (got.loc[i, "fingerprint"], got.loc[i, "component_id"]) == (f"{word:016x}", component)
