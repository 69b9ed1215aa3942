"""Periodic runs against a plain search, on random strings and through the query."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from cohortloom.llm import runs
from cohortloom.llm.plans import QUERIES
from tests.llm import edges


def plain(w, least=6, times=4):
    """Every run, by comparing each word with that q later."""
    out = []
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, times * q):
                if not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def text(rng):
    n, k = rng.randrange(0, 120), rng.choice([1, 2, 3, 8, 50])
    w = [rng.randrange(k) for _ in range(n)]
    if n and rng.random() < 0.7:
        a = rng.randrange(n)
        p = 1 + (n - a) // (2 + rng.randrange(12))
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    if n > 30 and rng.random() < 0.3:
        w[rng.randrange(n)] = 99
    return w


@pytest.mark.parametrize("least, times, tree", [(6, 4, 60_000), (6, 4, 5), (2, 2, 60_000), (10, 3, 200)])
def test_random_texts(monkeypatch, least, times, tree):
    monkeypatch.setattr(runs, "TREE", tree)
    rng = random.Random(least + times + tree)
    for _ in range(400):
        texts = [text(rng) for _ in range(rng.randrange(1, 4))]
        flat = np.array([x for t in texts for x in t], np.int64)
        sizes = np.array([len(t) for t in texts])
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))
        got = [tuple(r) for r in runs.text_runs(flat, left, least, times).tolist()]
        want, at = [], 0
        for t in texts:
            want += [(a + at, n, q) for a, n, q in plain(t, least, times)]
            at += len(t)
        assert got == want


def test_extensions_against_plain_comparison():
    rng = random.Random(4)
    for _ in range(50):
        s = [rng.randrange(3) for _ in range(rng.randrange(2, 60))] + [9]
        lce = runs.Extensions(s)
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        want = [next(k for k in range(len(s)) if s[i + k] != s[j + k]) for i, j in pairs]
        i, j = np.array(pairs).T
        assert lce(i, j).tolist() == want
        assert [int(x) for x in np.argsort(lce.rank)] == sorted(range(len(s)), key=lambda a: s[a:])


def digest(doc_id, body):
    w = (body or "").encode().split()
    n = len(w)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain(w)
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines.encode()), sha(kept))


def rows_of(spark, folder):
    return sorted((tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()), key=str)


def test_query_on_edge_cases(spark, tmp_path):
    rng = random.Random(8)
    rows = edges.documents(longest=400) + [(500 + k, " ".join(f"v{x}" for x in text(rng)), "en", "a") for k in range(150)]
    folder = edges.write(tmp_path, rows=rows)
    assert rows_of(spark, folder) == sorted((digest(r[0], r[1]) for r in rows), key=str)


def test_very_long_text_of_one_word(spark, tmp_path):
    folder = edges.write(tmp_path, rows=[(1, "so " * 300_000, "en", "a"), (2, "a b " * 100_000 + "c", "en", "a")])
    got = rows_of(spark, folder)
    assert [r[1:5] for r in got] == [(1, 0, 300_000, 1), (1, 0, 200_000, 2)]
