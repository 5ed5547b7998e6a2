import numpy as np
import pytest
from llm_brute import classes

from clinspark.llm import subspace_join as sj
from clinspark.llm.queries import QUERIES


def brute(ids, vectors, cosine):
    usable = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for v in vectors]
    units = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok else None for v, ok in zip(vectors, usable)]
    near = lambda i, j: usable[i] and usable[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= cosine
    roots = classes(len(ids), near)
    return [(sum(near(i, j) for j in range(len(ids)) if j != i), ids[r]) for i, r in enumerate(roots)]


def vectors(seed, n=120, size=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, size)) + 0.7
    made = np.concatenate([base, *(base + rng.normal(size=base.shape) * s for s in (0.05, 0.3, 0.4))])
    return made.astype(np.float32).tolist()


@pytest.mark.parametrize("tile,blocks", [(8192, 4), (5, 4), (8192, 16), (7, 1)])
def test_links_equal_brute_force(spark, tile, blocks):
    """The small tile splits every cell into pairs of tiles."""
    found = vectors(tile + blocks)
    found += [found[0], found[0], [0.0] * 16, None, [], [1.0, None] + [0.0] * 14, [float("nan")] * 16, [float("inf")] + [0.0] * 15, [1.0, 2.0], [1.0, 2.01], [-0.0, 1.0], [0.0, 1.0], [1e-30] * 16, [1e30] * 16]
    frame = spark.createDataFrame([(i, v, "x") for i, v in enumerate(found)], "vec_id long, embedding array<float>, node string")
    got = sj.near_vectors(frame, blocks=blocks, tile=tile).toPandas().sort_values("id")
    assert list(zip(got["n_links"], got["component_id"])) == brute(list(range(len(found))), found, 0.95)
    assert (got["kept"] == (got["id"] == got["component_id"])).all()


@pytest.mark.parametrize("tile", [32_768, 6])
def test_cells_along_several_coordinates(spark, tile):
    """Vectors that spread along few axes are cut along two or three of them; links cross the cells' borders in every direction."""
    rng = np.random.default_rng(tile)
    axes = np.linalg.qr(rng.normal(size=(12, 12)))[0][:, :6]
    base = rng.normal(size=(60, 6)) @ axes.T
    found = np.concatenate([base, *(base + rng.normal(size=base.shape) * s for s in (0.02, 0.1, 0.2))]).tolist()
    vectors = np.array(found) / np.linalg.norm(found, axis=1, keepdims=True)
    variance = np.sort(np.linalg.eigvalsh(np.cov(vectors.T, bias=True)))[::-1]
    dealt = sj._blocks(variance, 2)
    shares = np.array([variance[d].sum() for d in dealt])
    assert {len(c) for c in sj._cuts(variance, dealt, 0.02 * shares / shares.sum())} == {3}
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(found)], "vec_id long, embedding array<double>")
    got = sj.near_vectors(frame, cosine=0.99, blocks=2, tile=tile).toPandas().sort_values("id")
    want = brute(list(range(len(found))), found, 0.99)
    assert sum(n for n, _ in want) > 60
    assert list(zip(got["n_links"], got["component_id"])) == want


def test_repeated_and_missing_ids(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.001]), (None, [0.0, 1.0]), (1, None)]
    got = sj.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert sorted((str(r["id"]), r["n_links"], str(r["component_id"]), r["kept"]) for r in got) == sorted([("3", 2, "3", True), ("3", 2, "3", True), ("None", 2, "3", False), ("None", 0, "None", False), ("1", 0, "1", True)])
    assert sj.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op9_subspace_join"](spark, folder).toPandas().sort_values("vec_id")
    assert list(zip(got["n_links"], got["component_id"])) == brute([r["vec_id"] for r in rows], [r["embedding"] for r in rows], 0.95)
