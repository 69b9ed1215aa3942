"""Benchmark decontamination as a prefix-filtered set join.

A window is `size` consecutive words of a benchmark item (a shorter item is one window). A document
contains a window only if it contains all of the window's shingles, so the rarest one alone is its
necessary prefix: shingles are counted over all documents, every window keeps its rarest, and
windows with a shingle that no document has are gone at once. Documents give a candidate wherever a
prefix shingle stands with room for its window around it (length and positional bounds), and the
candidate's words are compared with the window's by an equi-join.

The filters are bit arrays of fixed size (two probes), whatever the size of the benchmark; a false
positive only makes a candidate that the join does not match. Both sides of the join are
distributed, so neither table has to fit a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import numbered, utf8
from cohortloom.session import cut

#: Words: runs of ASCII letters and digits and of all bytes above ASCII, letters in lower case.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
#: log2 of the bits of a filter.
FILTER_BITS = 24
#: Words handled at once inside a task.
CHUNK = 80_000
_P = np.uint64(0x100000001B3)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORD_BYTES).split()


class Hasher(dict):
    """64-bit numbers of words, remembered up to a bound; hash(word) of Python differs between workers, so not that."""

    def __init__(self, most: int = 100_000):
        import xxhash

        super().__init__()
        self.most, self.digest = most, xxhash.xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        number = self[word] = self.digest(word)
        return number

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of `size` word hashes; empty if there are fewer."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = (out ^ words[k : k + n]) * _P
        out ^= out >> np.uint64(29)
    return out * _MIX


class Filter:
    """Bits at two places for each member."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @staticmethod
    def places(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64((1 << FILTER_BITS) - 1)
        return (hashes & low).astype(np.int64), ((hashes >> np.uint64(40)) & low).astype(np.int64)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        a, b = self.places(hashes)
        first = (self.bits[a >> 3] >> (a & 7).astype(np.uint8)) & 1
        out = first.astype(bool)
        at = np.flatnonzero(out)  # few pass: the second probe looks at those only
        out[at] = ((self.bits[b[at] >> 3] >> (b[at] & 7).astype(np.uint8)) & 1).astype(bool)
        return out


def _filter_of(members: DataFrame) -> Filter:
    """The filter with all values of column `hash`, made of at most two places for each and their OR, in the driver.

    What arrives is bounded by the filter's 2^FILTER_BITS places; it comes as bitmaps of 4 KB.
    """
    mask = (1 << FILTER_BITS) - 1
    places = F.array(F.col("hash").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("hash", 40).bitwiseAND(F.lit(mask)))
    spots = members.select(F.explode(places).alias("spot"))
    maps = spots.groupBy(F.floor(F.col("spot") / 32768).cast("long").alias("part")).agg(
        F.bitmap_construct_agg((F.col("spot") % 32768)).alias("bits")
    )
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for row in maps.toLocalIterator():
        bits[row["part"] * 4096 : row["part"] * 4096 + 4096] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return Filter(bits)


def item_windows(items: DataFrame, item_id: str, text: str, size: int, shingle: int) -> DataFrame:
    """(item_id, window, shingles): the words of each window, space-joined, and the hash of each of its shingles.

    A window's shingles are `shingle` words long, or the whole window if that is shorter.
    """

    def cut_items(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                words = tokens(text)
                if not words:
                    continue
                long = min(size, len(words))
                short = min(shingle, long)
                hashes = shingle_hashes(hasher(words), short).view(np.int64)
                starts = range(len(words) - long + 1)
                step = 20_000
                for a in range(0, len(starts), step):
                    part = starts[a : a + step]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([item] * len(part), pa.string()),
                            pa.array([b" ".join(words[i : i + long]) for i in part], pa.binary()),
                            pa.array([long] * len(part), pa.int32()),
                            pa.array([hashes[i : i + long - short + 1].tolist() for i in part], pa.list_(pa.int64())),
                        ],
                        ["item_id", "window", "length", "shingles"],
                    )

    rows = items.select(F.col(item_id).cast("string"), F.col(text))
    return rows.mapInArrow(cut_items, "item_id STRING, window BINARY, length INT, shingles ARRAY<BIGINT>")


def _chunks(batches: Iterable[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, int, int, list[list[bytes]]]]:
    """Rows of a batch with about CHUNK words together, tokenised."""
    for batch in batches:
        texts, at, held, total = utf8(batch.column(text_at)), 0, [], 0
        for i, text in enumerate(texts):
            held.append(tokens(text))
            total += len(held[-1])
            if total >= CHUNK or i + 1 == len(texts):
                yield batch, at, i + 1, held
                at, held, total = i + 1, [], 0


def _flat(held: list[list[bytes]], hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes of all texts in a row, number of each text's words, words left at each place in its text)."""
    sizes = np.fromiter(map(len, held), np.int64, len(held))
    hashes = hasher([w for words in held for w in words])
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(hashes))
    return hashes, sizes, left


def shingle_counts(docs: DataFrame, text: str, wanted: Filter, lengths: list[int]) -> DataFrame:
    """(hash, n): how often the shingles that pass `wanted` stand in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted.bits)  # 2^FILTER_BITS bits

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, passed = Hasher(), Filter(shared.value)
        for _, _, _, held in _chunks(batches, 0):
            words, _, left = _flat(held, hasher)
            for size in lengths:
                hashes = shingle_hashes(words, size)
                hashes = hashes[(left[: len(hashes)] >= size)]
                hashes = hashes[passed.has(hashes)]
                if len(hashes):
                    keys, n = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["hash", "n"])

    return docs.select(text).mapInArrow(count, "hash BIGINT, n BIGINT").groupBy("hash").agg(F.sum("n").alias("n"))


def prefixes(docs: DataFrame, windows: DataFrame, text: str) -> DataFrame:
    """(window, length, hash, offset): each distinct window with its rarest shingle, ties by hash, and that one's place.

    Windows with a shingle that stands in no document have no row.
    """
    distinct = cut(windows.groupBy("window", "length").agg(F.first("shingles").alias("shingles")))
    each = distinct.select("window", "length", F.posexplode("shingles").alias("offset", "hash"), F.size("shingles").alias("of"))
    kinds = distinct.select(F.size("shingles").alias("of"), "length").distinct().collect()  # at most `size` kinds
    lengths = sorted({r["length"] - r["of"] + 1 for r in kinds})
    counts = shingle_counts(docs, text, _filter_of(each.select("hash")), lengths)
    rare = F.min(F.struct("n", "hash", "offset")).alias("rare")
    found = each.join(counts, "hash").groupBy("window", "length", "of").agg(rare, F.count("*").alias("present"))
    return found.filter("present = of").select("window", "length", "of", "rare.hash", "rare.offset")


def find(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", size: int = 13, shingle: int = 5,
) -> DataFrame:
    """A row per document: doc_id, n_words, hits and items.

    hits: the places of the words that lie in a window of an item, in order. items: the ids, as
    sorted strings, of items with a window in the document (a null id is none). Documents without
    words have none of either; repeated rows are judged one by one; an empty benchmark hits nothing.
    Other columns of either table are not read.
    """
    windows = cut(item_windows(items, item_id, item_text, size, shingle))
    wanted = cut(prefixes(docs, windows, text))
    shapes = [
        (r["length"], r["of"], r["offset"], r["length"] - r["of"] + 1)
        for r in wanted.select("length", "of", "offset").distinct().collect()  # at most size * size rows
    ]
    shared = docs.sparkSession.sparkContext.broadcast((_filter_of(wanted.select("hash")).bits, sorted(shapes)))

    def candidates(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        bits, shapes = shared.value
        passed = Filter(bits)
        for batch, a, b, held in _chunks(batches, 1):
            words, sizes, left = _flat(held, hasher)
            starts = np.cumsum(sizes) - sizes
            owner = np.repeat(np.arange(len(held)), sizes)
            spots: list[list[int]] = [[] for _ in held]
            longs: list[list[int]] = [[] for _ in held]
            texts: list[list[bytes]] = [[] for _ in held]
            for short in sorted({s[3] for s in shapes}):
                hashes = shingle_hashes(words, short)
                at = np.flatnonzero(passed.has(hashes) & (left[: len(hashes)] >= short))
                for length, _, offset, _ in (s for s in shapes if s[3] == short):
                    place = at - starts[owner[at]] - offset  # where the window would begin in its text
                    fits = (place >= 0) & (left[at] + offset >= length)
                    for doc, i in zip(owner[at[fits]].tolist(), place[fits].tolist(), strict=True):
                        spots[doc].append(i)
                        longs[doc].append(length)
                        texts[doc].append(b" ".join(held[doc][i : i + length]))
            shape = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("window", pa.binary())])
            rows = [
                [{"start": i, "length": n, "window": t} for i, n, t in zip(*x, strict=True)]
                for x in zip(spots, longs, texts, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(a, b - a), pa.array(sizes), pa.array(rows, pa.list_(shape))],
                ["doc_id", "n_words", "candidates"],
            )

    kind = docs.select(F.col(doc_id)).schema[0].dataType.simpleString()
    marked = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        candidates, f"doc_id {kind}, n_words BIGINT, candidates ARRAY<STRUCT<start: INT, length: INT, window: BINARY>>"
    )
    marked = cut(marked.withColumn("row", F.monotonically_increasing_id()))
    tried = marked.filter(F.size("candidates") > 0).select("row", F.inline("candidates"))
    sources = windows.join(wanted.select("window"), "window", "left_semi").filter(F.col("item_id").isNotNull())
    hits = (
        tried.join(wanted.select("window"), "window", "left_semi")
        .groupBy("row")
        .agg(F.collect_set(F.struct("start", "length")).alias("spans"))
        .select("row", F.array_sort(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))).alias("hits"))
    )
    found = (
        tried.select("row", "window").distinct().join(sources.select("window", "item_id").distinct(), "window")
        .groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    none = F.array().cast("array<int>"), F.array().cast("array<string>")
    return marked.select("row", "doc_id", "n_words").join(hits, "row", "left").join(found, "row", "left").select(
        "doc_id", "n_words", F.coalesce("hits", none[0]).alias("hits"), F.coalesce("items", none[1]).alias("items")
    )


def contaminated(n_words: Column, n_hit: Column, share: int = 20) -> Column:
    """Hit words are at least one in `share`."""
    return (n_hit > 0) & (F.lit(share) * n_hit >= n_words)


def keep_clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """`docs` without the contaminated rows, all columns."""
    rows, key = numbered(docs)
    found = find(rows, items, doc_id=key, **options)
    gone = found.filter(contaminated(F.col("n_words"), F.size("hits"))).select(F.col("doc_id").alias(key))
    return rows.join(gone, key, "left_anti").drop(key)
