"""Plain versions of the operators, on lists of rows."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def byte_words(text):
    return WORD.findall((text or "").encode().lower())


def repeats(texts, window):
    """(bytes, removed, spans, rest) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        rest = bytes(x for x, g in zip(d, gone) if not g)
        spans = sum(1 for i in range(len(d)) if gone[i] and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


def classes(n, near):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if near(i, j):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def simhash(text, shingle=4):
    words = byte_words(text)
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_copies(ids, texts, radius=4):
    """(fingerprint, component) of each row; ids are given in ascending order."""
    prints = [simhash(t) for t in texts]
    roots = classes(len(ids), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= radius)
    return [(p, ids[r]) for p, r in zip(prints, roots)]


def without_boilerplate(rows, ratio=0.08, least=5, z=2.5):
    """rows of (host, text): the texts, and the lines dropped."""
    pages, seen = Counter(h for h, _ in rows if h is not None), defaultdict(set)
    texts = Counter(h for h, t in {r for r in rows if r[0] is not None and r[1] is not None})
    for i, (h, t) in enumerate(rows):
        for line in (t or "").split("\n"):
            if h is not None and line.strip(" "):
                seen[h, line.strip(" ")].add(i)

    def over(k, v):
        on, of = len({rows[i][1] for i in v}), texts[k[0]]
        surely = on >= 2 and on > ratio * of and (on - ratio * of) ** 2 > z * z * ratio * (1 - ratio) * of
        return len(v) >= least and len(v) > ratio * pages[k[0]] or surely

    bad = {k for k, v in seen.items() if over(k, v)}
    out = []
    for h, t in rows:
        if t is None:
            out.append((None, 0))
            continue
        lines = t.split("\n")
        kept = [x for x in lines if (h, x.strip(" ")) not in bad]
        out.append(("\n".join(kept), len(lines) - len(kept)))
    return out


def shingles(text, n=5):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    if not words:
        return set()
    return {" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def contained(docs, items, containment=0.8):
    """[(doc, item, item size, shared)]; items with fewer than five words are runs of their own length."""
    by_words, pooled = {}, {}
    for item, text in items:
        words = " ".join(w for w in re.split(r"[\W_]+", (text or "").lower()) if w)
        if words:
            by_words[words] = min((i for i in (item, by_words.get(words)) if i is not None), default=None)
    for doc, text in docs:
        pooled.setdefault(doc, []).append(text)
    found = []
    for doc, texts in pooled.items():
        for words, item in by_words.items():
            n = min(5, words.count(" ") + 1)
            whole = shingles(words)
            held = set().union(*(shingles(t, n) if n < 5 else shingles(t) for t in texts))
            if len(whole & held) >= math.ceil(containment * len(whole) - 1e-9):
                found.append((doc, item, len(whole), len(whole & held)))
    return found


def padding(lengths, bounds):
    return sum(min(b for b in bounds if b >= n) - n for n in lengths)
