import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clinspark.llm import token_files as tf
from clinspark.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 300_000])
@pytest.mark.parametrize("kind", ["equal", "small", "wide", "outliers"])
def test_file_round_trip(n, kind):
    rng = np.random.default_rng(n)
    ids = {"equal": np.full(n, 7), "small": rng.integers(5, 9, n), "wide": rng.integers(0, 2**32, n, dtype=np.uint64), "outliers": np.where(rng.random(n) < 0.05, 2**31, rng.integers(0, 30, n))}[kind].astype(np.uint32)
    counts = np.array([n // 3, 0, n - n // 3])
    data = tf.encode_file([3, None, -5], counts, ids)
    numbers, got_counts, got = tf.decode_file(data)
    assert numbers == [3, None, -5] and (got_counts == counts).all() and (got == ids).all()
    if n == 300_000 and kind != "wide":
        assert len(data) < (1.2 if kind != "outliers" else 2.2) * n


def test_not_a_token_file():
    with pytest.raises(ValueError):
        tf.decode_file(b"PK..........................")


def expected(rows):
    tokenizer, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    return out


ODD = ["It's a test, isn't it?", "á á, İ, İx. क़, x", "<|endoftext|>, a<|startoftext|>b", "tab\tnew\r\nline\x0bvt\x0cff\x85nel em nbsp", "ÜBER, straße. ΣΑΣ, 12,345.67 ...", "don't, 's 're, x.y. 　漢字, é.", "😀, é.é.", ",", "a\x1cb, c\x1f d", "nbsp\xa0x, \u2003y.\u3000z"]


def test_word_encoder_equals_the_tokenizer(monkeypatch):
    tokenizer = Tokenizer.from_file(PATH)
    rng = random.Random(0)
    pool = "abéßüİı',.'s 12́̀\t\n漢ñ-<|>\x1d\xa0"
    texts = ODD + ["".join(rng.choice(pool) for _ in range(60)) for _ in range(300)]
    monkeypatch.setattr(tf, "CACHE", 50)  # forgets again and again
    encoder = tf.WordEncoder(PATH)
    for at in range(0, len(texts), 7):
        for text, data in zip(texts[at : at + 7], encoder.encode(texts[at : at + 7])):
            assert np.frombuffer(data, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_documents_round_trip(spark):
    rows = [(i * 7919 % 1000, t) for i, t in enumerate(ODD)] + [(5, None), (6, ""), (6, "twice"), (6, "again"), (None, "no id"), (2**60 + 1, "x " * 50_000), (-3, "minus")]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, start int")
    got = tf.round_trip(frame, PATH, file_ids=20).orderBy("start").collect()
    assert [(r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"], list(r["ids"])) for r in got] == expected(rows)
    assert tf.round_trip(frame.limit(0), PATH).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").toPandas()
    got = QUERIES["op8_token_files"](spark, folder).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [e[:4] for e in expected(list(zip(docs["doc_id"], docs["text"])))]
