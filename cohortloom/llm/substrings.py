"""Removal of repeated passages: Rabin-Karp hashes of every window of words, counted in Spark.

Rolling hashes. The number of a stretch u[i], u[i + 1], ... is the sum of u[i + k] * B^k modulo 2^64, the
difference of two running sums of u[i] * B^i times a power of B's inverse, so all windows of many texts take a few array
operations however long the window is. Words get their numbers from their bytes in the same way.

Counting. Documents are dealt into batches, written once. A window that stands in several documents
of a batch is one row, with the smallest document of them; the rows are sorted by hash in Spark and read
as a stream, so that a passage of every document needs no memory and a row for a batch, not for a document.
Hashes of more than one row go back to their batches. There the windows get a second, independent hash
of 64 bits, and those few are counted again by both: a chance agreement of the first hash (48 bits) only makes a
candidate. Windows that agree in all 112 bits are taken as equal, which among 10^13 windows fails with a
chance of about 1e-8.

Windows with a smaller document for owner are then merged into maximal intervals in each text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import pieces, settings, utf8
from cohortloom.session import drop_cut, work_path

#: Bytes of text in a batch, unless one text alone has more.
BATCH = 8 << 20
#: Bytes hashed at once, unless one text alone has more.
CHUNK = 1 << 20
#: Bytes from which a word is hashed by itself.
LONG = 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_BASES = (np.uint64(0x9E3779B97F4A7C15 | 3), np.uint64(0xD6E8FEB86659FD93))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Rolling:
    """Hashes of stretches of a row of numbers."""

    def __init__(self, base: np.uint64):
        self.base, self.inverse = base, np.uint64(pow(int(base), -1, 1 << 64))
        self.up = self.down = np.zeros(0, np.uint64)

    def __call__(self, u: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash for each stretch from a begin up to its end, mixed so that sums of them say nothing of their sum."""
        n = len(u)
        if len(self.up) < n:
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(u * self.up[:n], dtype=np.uint64, out=sums[1:])
        out = (sums[ends] - sums[begins]) * self.down[begins]
        out ^= out >> np.uint64(32)
        out *= _MIX
        return out ^ (out >> np.uint64(29))


class Windows:
    """The windows of some texts: their places, documents and two independent hashes, made when asked for."""

    def __init__(self, size: int, bits: int):
        self.size, self.bits = size, bits
        self.bytes_, self.words = [[Rolling(b) for b in _BASES] for _ in range(2)]

    def read(self, texts: list[bytes], ids: list[int | None]) -> Windows:
        """Take these texts; only those with an id have windows. Places count the words of all texts in a row."""
        joined = b" ".join(texts)
        self.raw = np.frombuffer(joined, np.uint8)
        inside = np.concatenate(([False], ~_SPACE[self.raw], [False]))
        turns = np.flatnonzero(inside[1:] != inside[:-1])
        self.begins, self.ends = turns[::2], turns[1::2]
        text_ends = np.cumsum([len(t) + 1 for t in texts])
        self.stops = np.searchsorted(self.begins, text_ends)  # words up to the end of each text
        self.counts = np.diff(self.stops, prepend=0)
        left = np.repeat(self.stops, self.counts) - np.arange(len(self.begins))
        known = np.repeat(np.array([i is not None for i in ids], bool), self.counts)
        self.at = np.flatnonzero((left >= self.size) & known)
        self.docs = np.repeat(np.array([i or 0 for i in ids], np.int64), self.counts)[self.at]
        return self

    def hashes(self, which: int) -> np.ndarray:
        """The first or the second hash of each window."""
        if not len(self.at):
            return np.zeros(0, np.int64)
        u = self.bytes_[which](self.raw + np.uint64(1), self.begins, self.ends)
        for k in np.flatnonzero(self.ends - self.begins > LONG):  # long regular words could agree in sums modulo 2^64
            u[k] = xxhash.xxh3_64_intdigest(self.raw[self.begins[k] : self.ends[k]].tobytes(), which)
        out = self.words[which](u, self.at, self.at + self.size)
        return (out >> np.uint64(64 - (64 if which else self.bits))).view(np.int64)


def _deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches: a number and the packed rows of neighbours with about BATCH bytes of text together."""
    number = TaskContext.get().partitionId() << 33
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch.column(1)).to_pylist()]
        for a, b in pieces(sizes, BATCH):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, batch.schema, options=options) as out:
                out.write_batch(batch.slice(a, b - a))
            yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["src", "block"])
            number += 1


def _unpack(block: bytes) -> tuple[list[int | None], list[bytes | None]]:
    """Ids and texts of a batch."""
    rows = pa.ipc.open_stream(block).read_all().combine_chunks()
    return rows.column(0).to_pylist(), utf8(rows.column(1).combine_chunks())


def _rows(keys: list[np.ndarray], docs: np.ndarray, src: int) -> pa.RecordBatch:
    """A row for each distinct key: the key, twice the batch's number, plus 1 if several documents have it, and the smallest."""
    order = np.argsort(keys[0]) if len(keys) == 1 else np.lexsort(keys[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([k[order[1:]] != k[order[:-1]] for k in keys], axis=0)
    starts = np.flatnonzero(new)
    low, high = (f.reduceat(docs[order], starts) for f in (np.minimum, np.maximum))
    # Rows in the order of the texts, which compresses better than that of the hashes.
    lows, highs, one = np.zeros_like(docs), np.zeros_like(docs), np.zeros(len(docs), bool)
    lows[order[starts]], highs[order[starts]], one[order[starts]] = low, high, True
    many = (lows != highs)[one].astype(np.int64)
    columns = [pa.array(k[one]) for k in keys] + [pa.array((src << 1) + many), pa.array(lows[one])]
    return pa.RecordBatch.from_arrays(columns, ["h", "g"][: len(keys)] + ["tag", "low"])


def _spans(texts: list[bytes | None], ids: list[int | None], windows: Windows) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about CHUNK bytes together, taken in by `windows`."""
    for a, b in pieces([len(t or b"") for t in texts], CHUNK):
        windows.read([t or b"" for t in texts[a:b]], ids[a:b])
        yield a, b


def _every_window(size: int, bits: int):
    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(size, bits)
        for batch in batches:
            for src, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids, texts = _unpack(block.as_py())
                for _ in _spans(texts, ids, windows):
                    if len(windows.at):
                        yield _rows([windows.hashes(0)], windows.docs, src)

    return hashed


def _repeated(keys: int):
    """Rows sorted by key and smallest document in; out the rows of keys with two rows or documents, with the key's smallest."""
    names = ["h", "g"][:keys]

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None  # the last row, its key's smallest document, and whether the row before has its key
        for batch in batches:
            cols = [batch.column(k).to_numpy() for k in range(keys + 2)]
            if not len(cols[0]):
                continue
            if rest is not None:
                cols = [np.concatenate((r[:1], c)) for r, c in zip(rest, cols, strict=False)]
            new = np.ones(len(cols[0]) + 1, bool)
            new[1:-1] = np.any([c[1:] != c[:-1] for c in cols[:keys]], axis=0)
            starts = np.flatnonzero(new[:-1])
            firsts = cols[-1][starts]
            if rest is not None:
                firsts[0], new[0] = rest[-2][0], not rest[-1][0]
            least = np.repeat(firsts, np.diff(np.append(starts, len(cols[0]))))
            told = ~new[:-1] | ~new[1:] | ((cols[keys] & 1) == 1)
            told[-1] = False  # kept back until the next row is known
            if told.any():
                out = [c[told] for c in cols[:keys]] + [cols[keys][told] >> 1, least[told]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], [*names, "src", "least"])
            rest = [c[-1:] for c in cols] + [least[-1:], ~new[len(cols[0]) - 1 : len(cols[0])]]
        if rest is not None and (rest[-1][0] or rest[keys][0] & 1):
            out = [c for c in rest[:keys]] + [rest[keys] >> 1, rest[-2]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], [*names, "src", "least"])

    return stream


def _written(df: DataFrame) -> DataFrame:
    """`df` as a table in the shared folder, packed well; the shuffles behind it go at once."""
    spark = df.sparkSession
    path = work_path(spark, "table")
    with settings(
        spark,
        spark__sql__classic__shuffleDependency__fileCleanup__enabled="true",
        spark__sql__execution__arrow__maxRecordsPerBatch="100000",
    ):
        df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.cut_path = path
    return table


def _count(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, src, least): the keys with several rows or documents, for each batch that has them."""
    columns = ", ".join(f"{k} BIGINT" for k in [*keys, "src", "least"])
    dealt = rows.repartition(*keys).sortWithinPartitions(*keys, "low")
    return _written(dealt.mapInArrow(_repeated(len(keys)), columns))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Places of the values that are in the sorted array `known`."""
    if not len(known):
        return np.zeros(0, np.int64)
    return np.flatnonzero(known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values)


def _second_hashes(size: int, bits: int):
    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted, windows, parts = np.unique(right.column("h").to_numpy()), Windows(size, bits), []
        ids, texts = _unpack(left.column("block")[0].as_py()) if len(wanted) else ([], [])
        for _ in _spans(texts, ids, windows):
            first = windows.hashes(0)
            at = _among(first, wanted)
            if len(at):
                parts.append(_rows([first[at], windows.hashes(1)[at]], windows.docs[at], left.column("src")[0].as_py()))
        names = ["h", "g", "tag", "low"]
        return pa.Table.from_batches(parts) if parts else pa.table({n: pa.array([], pa.int64()) for n in names})

    return tell


def _owned(h: np.ndarray, g: np.ndarray, told: list[np.ndarray]) -> np.ndarray:
    """The smallest document of each window, or the largest number where there is none; told is sorted by hash."""
    out = np.full(len(h), np.iinfo(np.int64).max)
    at = np.searchsorted(told[0], h)
    open_ = np.arange(len(h))
    while len(open_):
        open_ = open_[at[open_] < len(told[0])]
        open_ = open_[told[0][at[open_]] == h[open_]]
        hit = told[1][at[open_]] == g[open_]
        out[open_[hit]] = told[2][at[open_[hit]]]
        open_ = open_[~hit]
        at[open_] += 1
    return out


def _intervals(size: int, bits: int):
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))

    def judge(left: pa.Table, right: pa.Table) -> pa.Table:
        told = [right.column(c).to_numpy() for c in ("h", "g", "least")]
        order = np.argsort(told[0], kind="stable")
        told = [t[order] for t in told]
        windows = Windows(size, bits)
        counts, spans, kept = [], [], []
        ids, texts = _unpack(left.column("block")[0].as_py())
        for x, y in _spans(texts, ids, windows):
            first = windows.hashes(0) if len(told[0]) else np.zeros(0, np.int64)
            gone = _among(first, told[0])
            if len(gone):
                gone = gone[_owned(first[gone], windows.hashes(1)[gone], told) < windows.docs[gone]]
            # Windows of one text that touch or overlap are one interval.
            place, stops = windows.at[gone], windows.stops
            owner = np.searchsorted(stops, place, side="right")
            breaks = np.flatnonzero((np.diff(place) > size) | (np.diff(owner) > 0)) + 1
            heads, tails = (np.append(0, breaks), np.append(breaks - 1, len(place) - 1)) if len(place) else (place, place)
            found: list[list[dict[str, int]]] = [[] for _ in range(x, y)]
            before = (stops - windows.counts)[owner[heads]]
            for k, a, n in zip(owner[heads].tolist(), (place[heads] - before).tolist(), (place[tails] - place[heads] + size).tolist(), strict=True):
                found[k].append({"start": a, "length": n})
            for text, mine in zip(texts[x:y], found, strict=True):
                words, rest, done = (text or b"").split(), [], 0
                for s in mine:
                    rest += words[done : s["start"]]
                    done = s["start"] + s["length"]
                kept.append(b" ".join(rest + words[done:] if mine else words))
            counts += windows.counts.tolist()
            spans += found
        return pa.table(
            {"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(counts, pa.int64()), "removed": pa.array(spans, span_type), "kept": pa.array(kept, pa.binary())}
        )

    return judge


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 50, bits: int = 48) -> DataFrame:
    """A row per document: doc_id, n_words, removed and kept.

    removed: the maximal intervals (start, length), in words from 0, of the words that lie in a window of
    `size` words whose sequence also begins in a document with a smaller id. kept: the other words, joined by one space.
    Windows are judged on the whole input. Ids are integers; a row with a null id neither
    removes nor loses words, and rows with one id do not take from each other. A null or empty text, and one with fewer
    words than `size`, loses nothing; an empty table gives no rows; other columns are not read. A text is
    held whole by one task, with about 60 bytes for each byte of a very long one. The first hash has `bits` bits: fewer make smaller
    shuffles and more candidates, and change no result. The tables that the result reads stay in the shared folder.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    dealt = _written(rows.mapInArrow(_deal, "src BIGINT, block BINARY"))
    first = _count(dealt.mapInArrow(_every_window(size, bits), "h BIGINT, tag BIGINT, low BIGINT"), ["h"])
    told = dealt.groupBy("src").cogroup(first.groupBy("src"))
    second = _count(told.applyInArrow(_second_hashes(size, bits), "h BIGINT, g BIGINT, tag BIGINT, low BIGINT"), ["h", "g"])
    drop_cut(first)
    shape = "doc_id BIGINT, n_words BIGINT, removed ARRAY<STRUCT<start: BIGINT, length: BIGINT>>, kept BINARY"
    out = dealt.groupBy("src").cogroup(second.groupBy("src")).applyInArrow(_intervals(size, bits), shape)
    return out.withColumn("kept", F.col("kept").cast("string"))
