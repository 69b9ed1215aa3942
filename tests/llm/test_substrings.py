"""Removal of repeated windows against a plain version, with hashes short enough to collide."""

import random

import numpy as np
import pyarrow as pa
import pytest

from cohortloom.llm import substrings


def plain(rows, size):
    own = {}
    for d, t in rows:
        w = (t or "").split() if d is not None else []
        for i in range(len(w) - size + 1):
            key = tuple(w[i : i + size])
            own[key] = min(own.get(key, d), d)
    out = []
    for d, t in rows:
        w, gone = (t or "").split(), set()
        for i in range(len(w) - size + 1 if d is not None else 0):
            if own[tuple(w[i : i + size])] < d:
                gone |= set(range(i, i + size))
        starts = [i for i in sorted(gone) if i - 1 not in gone]
        spans = [(i, next(k for k in range(i, len(w) + 1) if k not in gone) - i) for i in starts]
        out.append((d, len(w), spans, " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def corpus(size, seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(40)}"
    base = [[word() for _ in range(rng.randrange(size, 4 * size))] for _ in range(6)]
    rows = [(None, None), (3, ""), (4, None), (5, " \n\t"), (6, "a " * size), (7, "a " * (3 * size))]
    for k in range(150):
        w = []
        for _ in range(rng.randrange(1, 5)):
            b = rng.choice(base)
            w += [word() for _ in range(rng.randrange(0, 2 * size))]
            if rng.random() < 0.6:
                a = rng.randrange(len(b))
                w += b[a : a + rng.randrange(1, 3 * size)]
        rows.append((rng.choice([None, rng.randrange(-50, 100), k]), "  ".join(w)))
    return rows + rows[10:20]


@pytest.mark.parametrize("size, bits", [(5, 48), (5, 8), (50, 64), (1, 3), (7, 1)])
def test_against_plain(spark, size, bits):
    rows = corpus(size, size * 100 + bits)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, kept string, src int").repartition(5)
    found = substrings.dedup(docs, size=size, bits=bits).collect()
    got = [(r.doc_id, r.n_words, [(s.start, s.length) for s in r.removed], r.kept) for r in found]
    assert sorted(got, key=str) == plain(rows, size)
    assert any(g[2] for g in got)


def test_passage_in_every_document(spark):
    """A hot passage is a row for each batch, not for each document, and only the first document keeps it."""
    passage = " ".join(f"p{k}" for k in range(60))
    docs = spark.range(3000).select("id", "id").toDF("doc_id", "n").selectExpr("doc_id", f"concat('own', n, ' {passage} ', n) AS text")
    got = substrings.dedup(docs.repartition(3))
    assert got.selectExpr("doc_id", "aggregate(removed, 0L, (n, s) -> n + s.length) AS n").filter("n != CASE WHEN doc_id = 0 THEN 0 ELSE 60 END").count() == 0


def test_rows_of_one_batch_are_combined():
    windows = substrings.Windows(3, 64).read([b"a b c d", b" a  b c d", b"a b c d"], [9, 4, None])
    rows = substrings._rows([windows.hashes(0)], windows.docs, 5).to_pydict()
    assert rows["tag"] == [11, 11] and rows["low"] == [4, 4]


def test_hashes_are_of_the_words_alone():
    words = [str(k % 7).encode() * (1 + 40 * (k % 2)) for k in range(500)]
    for which in (0, 1):
        found = substrings.Windows(20, 64).read([b" \t".join(words), b"x"], [1, 2]).hashes(which).tolist()
        want = [int(substrings.Windows(20, 64).read([b"", b" ".join(words[i : i + 20])], [3, 1]).hashes(which)[0]) for i in range(481)]
        assert found == want
        assert len(set(want)) == 14


@pytest.mark.parametrize("step", [1, 2, 3, 1000])
def test_stream_over_batch_borders(step):
    rng = random.Random(step)
    rows = sorted((rng.randrange(30), rng.randrange(3), rng.randrange(9), rng.random() < 0.1) for _ in range(60))
    groups = {}
    for h, low, src, many in rows:
        groups.setdefault(h, []).append((low, src, many))
    want = sorted((h, s, min(g)[0]) for h, g in groups.items() for _, s, _ in g if len(g) > 1 or g[0][2])
    data = [np.array([r[0] for r in rows]), np.array([2 * r[2] + r[3] for r in rows]), np.array([r[1] for r in rows])]
    batches = [pa.RecordBatch.from_arrays([pa.array(c[a : a + step]) for c in data], ["h", "tag", "low"]) for a in range(0, len(rows), step)]
    got = [(r["h"], r["src"], r["least"]) for b in substrings._repeated(1)(batches) for r in b.to_pylist()]
    assert sorted(got) == want
