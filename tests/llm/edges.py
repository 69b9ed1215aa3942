"""Small tables with nulls, empty and very long texts, ties, repeated rows and extra columns."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = "the of and to in is was that it for on with as at by this from are be or had not but an they which you one".split()


def prose(rng, n):
    out = []
    for i in range(n):
        w = rng.choice(WORDS)
        out.append(w.capitalize() if i % 9 == 0 else w + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def documents(longest=3_000):
    """`longest`: words of the longest text; the SQL forms take time in its square."""
    rng = random.Random(11)
    item = prose(random.Random(77), 60)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t\x0b ", None, "a"), (4, "word", "en", None), (5, "... !!! 123", "de", ""),
        (None, "A text without an id, quite short.", "en", "b"), (None, None, None, None), (6, "same row", "en", "b"), (6, "same row", "en", "b"),
        (7, "x " * longest, "en", "hot"), (8, "Ünïcödé Straße 中文字 \U0001d400 İstanbul   nbsp sep 😀😀", "de", "b"),
        (9, item, "en", "a"), (10, "Before it " + item.upper() + " and after", "en", "hot"), (11, " ".join(item.split()[5:17]), "en", "b"),
        (12, "short item here\nand\nshort item here\n\nand", "en", "b"), (13, "Tie. Tie. Tie.", "fr", "c"), (14, "<|endoftext|> it's don't'll ''s 's", "en", "c"),
        (15, "a\r\nb\x00c \x1f d\u0085e", "en", "d"), (-3, "negative id", "en", "d"),
    ]
    rows += [(100 + i, prose(rng, rng.randrange(1, 120)), rng.choice(["en", "de"]), "hot" if i % 3 else f"s{i % 7}") for i in range(60)]
    return rows


def write(folder, rows=None, items=None, pages=None, labels=None, vectors=None):
    """Parquet files of the tables used here; None means the edge cases, [] an empty table."""
    rows = documents() if rows is None else rows
    d, t, lang, s = (list(x) for x in zip(*rows)) if rows else ([], [], [], [])
    n = len(rows)
    clash = {"size": pa.array(["x"] * n, pa.string()), "row": pa.array([1] * n, pa.int32()), "fp": pa.array([None] * n, pa.string()), "Found": pa.array([0.5] * n)}
    docs = {"doc_id": pa.array(d, pa.int64()), "text": pa.array(t, pa.string()), "lang": pa.array(lang, pa.string()), "source": pa.array(s, pa.string()), "n_chars": pa.array([None if x is None else len(x) for x in t], pa.int64())}
    pq.write_table(pa.table(docs | clash), os.path.join(folder, "documents.parquet"))
    if items is None:
        items = [(0, prose(random.Random(77), 60)), (1, "short item"), (2, None), (3, ""), (None, "tie"), (4, "SHORT ITEM"), (5, prose(random.Random(5), 40)), (4, "short item")]
    i, x = (list(v) for v in zip(*items)) if items else ([], [])
    pq.write_table(pa.table({"item_id": pa.array(i, pa.int64()), "text": pa.array(x, pa.string()), "doc_id": pa.array(["q"] * len(i), pa.string())}), os.path.join(folder, "benchmark.parquet"))
    if pages is None:
        big = "<html>" + prose(random.Random(2), 90_000) + "\r\n\r\nWARC/1.1\r\n</html>"
        pages = [
            (1, "http://a.example.com/fr/1", "<p>é</p>" * 30), (2, "https://b.example.org/es/2?x=1", "<p>é</p>" * 30), (3, None, None), (4, "no scheme", ""), (5, "http://EXAMPLE.org/en/1", "small"),
            (6, "http://example.org/en/1x#top", "small"), (7, "http://x.example.com/de/?a=b&c=d", big), (8, "http://y.example.com/de", big), (None, "http://example.net", "<p>no id</p>" * 20), (9, "ftp://h?q", "<p>no id</p>" * 20),
            (10, "http://example.com.evil/fr/", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n0\r\n\r\n" * 9), (10, "http://example.com.evil/fr/", "\r\n\r\nHTTP/1.1 200 OK\r\n\r\n0\r\n\r\n" * 9), (11, "", "q" * 99), (12, "http://", "q" * 99), (13, "http://q", "q" * 100), (14, "http://q", "q" * 100),
        ]
    p, u, h = (list(v) for v in zip(*pages)) if pages else ([], [], [])
    pq.write_table(pa.table({"page_id": pa.array(p, pa.int64()), "url": pa.array(u, pa.string()), "html": pa.array(h, pa.string()), "host": pa.array([1] * len(p))}), os.path.join(folder, "pages.parquet"))
    if labels is None:
        labels = [(r[0], k % 2, 0) for k, r in enumerate(rows)] + [(None, 1, 0), (999, 1, None), (9, None, 1)]
    a, b, c = (list(v) for v in zip(*labels)) if labels else ([], [], [])
    pq.write_table(pa.table({"doc_id": pa.array(a, pa.int64()), "quality": pa.array(b, pa.int32()), "toxic": pa.array(c, pa.int32())}), os.path.join(folder, "labels.parquet"))
    if vectors is None:
        rng = random.Random(3)
        vectors = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(50)] + [(None, [0.5] * 8), (60, None), (61, [None] * 8), (62, [float("nan")] * 8), (63, []), (3, [1e30] * 8)]
    i, v = (list(x) for x in zip(*vectors)) if vectors else ([], [])
    pq.write_table(pa.table({"vec_id": pa.array(i, pa.int64()), "embedding": pa.array(v, pa.list_(pa.float32())), "deviation": pa.array([""] * len(i))}), os.path.join(folder, "embeddings.parquet"))
    return str(folder)
