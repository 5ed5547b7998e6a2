import hashlib
import random
import re

import numpy as np
import pytest

from clinspark.llm import fill_middle as fm
from clinspark.llm.queries import QUERIES


def example(number, text, unit="code_point"):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if number is None else number}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    begins = [*(range(len(text)) if unit == "code_point" else (m.start() for m in re.finditer("[^\x20\x09-\x0d]+", text)))]
    n = len(begins)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return number, n, "plain", None, None, text
    x, y = (0 if k == 0 else len(text) if k == n else begins[k] for k in (a, b))
    p, m, s = text[:x], text[x:y], text[y:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    return number, n, form, a, b - a, f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def rows():
    rng = random.Random(2)
    signs = "abc é漢🙂́\n\t <P"
    out = [(i, "".join(rng.choices(signs, k=rng.randint(0, 3000)))) for i in range(150)]
    shared = "".join(rng.choices("die der das und nicht ü ", k=9000))
    out += [(1000 + i, "x" * i + shared + "y" * i) for i in range(40)]
    out += [(2000 + i, t) for i, t in enumerate([None, "", " ", "<P>", "a<S>b", "<M", "P>", "<P", "a", "\x00", "\x1c\x1d", "é" * 70_000, "a" * 300_000, "🙂 " * 40_000, "́" * 9])]
    out += [(None, "no id at all"), (None, None), (7, "again"), (7, "again"), (-5, "minus"), (2**62, "wide")]
    return out


@pytest.mark.parametrize("unit", ["code_point", "word"])
def test_examples(spark, unit, monkeypatch):
    data = rows()
    frame = spark.createDataFrame([(*r, "z", 1) for r in data], "doc_id long, text string, form string, n int").repartition(3)
    got = fm.fill_in_middle(frame, unit=unit)
    text = fm.restored(got["output"], got["form"]).alias("back")
    found = got.select("*", text).collect()
    key = lambda r: str(r)
    assert sorted((tuple(r)[:6] for r in found), key=key) == sorted((example(*r, unit) for r in data), key=key)
    assert sorted(r["back"] for r in found) == sorted(t or "" for _, t in data)


def test_empty(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        fm.fill_in_middle(spark.createDataFrame([], "doc_id long, text string"), unit="line")


def test_cuts_depend_on_content_alone(monkeypatch):
    rng = random.Random(5)
    passage = bytes(rng.choices(range(97, 123), k=20_000))
    places = [set(fm.cut_places(np.frombuffer(b"q" * pad + passage, np.uint8)) - pad) for pad in (0, 1, 777, 5000)]
    inner = [{p for p in found if p >= fm.WINDOW} for found in places]
    assert 20 < len(inner[0]) < 70 and all(found == inner[0] for found in inner)
    whole = np.frombuffer(passage * 3, np.uint8)
    at_once = fm.cut_places(whole)
    monkeypatch.setattr(fm, "SEGMENT", 1000)
    assert (fm.cut_places(whole) == at_once).all()


def test_chunks_are_remembered_by_content(monkeypatch):
    counter = fm.Counter("word")
    rng = random.Random(6)
    text = " ".join("".join(rng.choices("abcdé", k=rng.randint(1, 9))) for _ in range(5000)).encode()
    size = lambda t: counter.measure(t, fm.cut_places(np.frombuffer(t, np.uint8)))
    first = size(text)
    held = len(counter.known)
    shifted = size(b"zz " + text)
    assert shifted[1][-1] == first[1][-1] + 1 and held > 20 and len(counter.known) < held + 5
    monkeypatch.setattr(fm, "CACHE_BYTES", 1000)
    counter = fm.Counter("word")
    assert size(text) == first and len(counter.known) + len(counter.older) < held


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = [(*e[:5], sha(e[5]), sha(r["text"] or "")) for r in docs for e in [example(*r)]]
    assert sorted(map(tuple, QUERIES["op12_fill_middle"](spark, folder).collect()), key=str) == sorted(want, key=str)
