import zlib
from itertools import product

import numpy as np
import pytest

from clinspark.llm import language_spans as ls
from clinspark.llm.queries import QUERIES


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(0)
    scores = [rng.normal(size=(n, 3)).astype(np.float32) * 3 for n in (1, 6, 2, 5, 1, 4)]
    prior, lengths = np.log([0.5, 0.3, 0.2]), np.array([len(s) for s in scores])
    paths = np.split(ls.best_paths(np.concatenate(scores), lengths, prior, 2.0), np.cumsum(lengths)[:-1])
    for s, path in zip(scores, paths):
        value = lambda p, s=s: prior[p[0]] + sum(s[t, p[t]] for t in range(len(p))) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
        assert value(path.tolist()) == pytest.approx(max(value(p) for p in product(range(3), repeat=len(s))))


def test_words_are_scored_alike_alone_and_together(spark):
    model = ls.learn(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    words = ["the", "The,", "12", "katze", "σπίτι", "x" * 500, "²", "é", "и", "a1b2"]
    together, letters = model.word_scores(words)
    assert letters.tolist() == [3, 3, 0, 5, 5, 500, 0, 1, 1, 2] and not together[[2, 6]].any()
    for word, scores in zip(words, together):
        assert np.allclose(model.word_scores([word])[0][0], scores, atol=1e-3)
    assert np.allclose(together[0], together[1]) and together[4].argmax() == model.langs.index("el")


def corpus():
    english, german, greek = "the cat and the dog with that thing", "der hund und die katze mit ich schon", "και το σπίτι με την γάτα"
    return [(i, " ".join([t] * 4), k) for i, (t, k) in enumerate([(english, "en"), (german, "de"), (greek, "el")] * 30)]


def test_spans_scripts_and_edges(spark):
    model = ls.learn(spark.createDataFrame(corpus(), "doc_id long, text string, lang string"), "doc_id", "text", "lang")
    assert model.langs == ["de", "el", "en"]
    mixed = "the cat and the dog with that thing der hund und die katze mit ich schon"
    rows = [(1, mixed, "z"), (2, None, "z"), (3, "", "z"), (4, "12 !! ...", "z"), (5, "σπίτι", "z"), (None, "the " * 50_000, "z"), (6, "привет мир", "z"), (6, "x" * 100_000, "z")]
    got = ls.language_spans(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert [(s["lang"], s["first"], s["last"]) for s in by[1]["spans"]] == [("en", 0, 7), ("de", 8, 15)]
    assert all((by[i]["lang_pred"], by[i]["score"], by[i]["spans"]) == ("und", 0.0, []) for i in (2, 3, 4))
    assert by[5]["lang_pred"] == "el" and by[None]["lang_pred"] == "en" and by[6]["lang_pred"] in model.langs and len(got) == len(rows)


def test_scripts():
    names = [*ls.SCRIPT_RANGES, "other"]
    assert [names[i] for i in ls.scripts_of(np.array([*map(ord, "aéЖσ漢ᚠ!")]))] == ["latin", "latin", "cyrillic", "greek", "han", "other", "other"]


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "a b", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = ls.learn(docs, "doc_id", "text", "lang")
    assert model.langs == [] and {r["lang_pred"] for r in ls.language_spans(docs, model).collect()} == {"und"}
    assert ls.language_spans(docs.limit(0), model).count() == 0


def test_query_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    got = QUERIES["op10_language_spans"](spark, folder).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas().set_index("doc_id")
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.index]).all() and got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == docs.loc[held.index, "lang"]).mean() > 0.97
