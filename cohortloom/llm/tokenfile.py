"""Token ids as Parquet list columns, written in id order and read back selectively.

Documents are range-partitioned and sorted by id, encoded, and written by Spark's Parquet writer
with a dictionary (or delta) encoding, row groups of a set size and pages of a set number of rows;
the writer adds page indexes, so a reader that wants some documents, or the metadata alone, skips
the rest. Each row carries its position within its part file and the file's number in the order;
adding the sizes of the parts before gives a document's place in the whole.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortloom.llm.text import pieces as ranges
from cohortloom.llm.text import utf8
from cohortloom.session import work_path

if TYPE_CHECKING:
    from tokenizers import Tokenizer

#: Bytes of text handled at once inside a task.
CHUNK = 1_000_000
#: Options of the Parquet writer by encoding.
WRITER = {
    "dictionary": {"parquet.enable.dictionary": "true", "parquet.dictionary.page.size": str(1 << 20)},
    "delta": {"parquet.enable.dictionary": "false", "parquet.writer.version": "PARQUET_2_0"},
}
#: Kinds of bytes: ASCII white space; letters; digits; other visible ASCII; what makes a word go whole to the library.
_SPACE, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)
_KINDS = bytes(
    _SPACE if c in b" \t\n\v\f\r" else _LETTER if chr(c).isalpha() and c < 128 else _DIGIT if chr(c).isdigit() and c < 128
    else _OTHER if 33 <= c <= 126 and c != ord("'") else _WHOLE for c in range(256)
)
#: The alphabet of byte-level tokenizers: visible Latin-1 characters stand for their bytes, the other bytes follow from U+0100 on.
_HIDDEN = [c for c in range(256) if not (33 <= c <= 126 or 161 <= c <= 172 or c >= 174)]
_ALPHABET = {c: 256 + i for i, c in enumerate(_HIDDEN)}
_BLANK = re.compile(rb"[\x20\x09-\x0D]")
_ODD = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)]
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: The steps before the merges for which texts are known to be encoded word by word.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_ENCODERS: dict[str, Encoder] = {}


def settings_of(tokenizer: Tokenizer) -> dict:
    """The steps around the merges and the added strings, without the vocabulary, which takes much memory when parsed."""
    state = lambda step: None if step is None else json.loads(step.__getstate__())
    names = ("content", "normalized", "lstrip", "rstrip", "single_word")
    return {
        "normalizer": state(tokenizer.normalizer), "pre_tokenizer": state(tokenizer.pre_tokenizer), "post_processor": state(tokenizer.post_processor),
        "added_tokens": [{n: getattr(t, n) for n in names} for t in tokenizer.get_added_tokens_decoder().values()],
    }


def word_by_word(settings: dict) -> bool:
    """Whether the tokenizer of these settings lower-cases, drops white space and never joins two words.

    Its special strings must be matched as written, take no neighbour with them and hold `<|` and no white space.
    """
    steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    split = {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True}
    special = all(
        "<|" in t["content"] and not any(map(str.isspace, t["content"])) and not (t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"])
        for t in settings.get("added_tokens") or []
    )
    return (
        (settings.get("normalizer") or {}).get("normalizers") == _NORMALIZERS and steps[0] == split
        and [(s["type"], s.get("add_prefix_space"), s.get("use_regex")) for s in steps[1:]] == [("ByteLevel", False, False)]
        and settings.get("post_processor") is None and special
    )


class Pieces:
    """Numbers of byte strings of 1 to 16 bytes without zeros: an open-addressing table of their bytes as two whole numbers.

    The bytes themselves are compared, so no two strings ever share a number.
    """

    def __init__(self) -> None:
        self.slots, self.filled = np.full(1 << 16, -1, np.int32), 0
        self.first, self.second = np.zeros(1, np.uint64), np.zeros(1, np.uint64)

    def place_of(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        mixed = (first ^ second * _ODD[0]) * _ODD[1]
        return ((mixed ^ mixed >> np.uint64(32)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def look_up(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The number of each string, -1 for one that has none."""
        out, left, at = np.full(len(first), -1, np.int64), np.arange(len(first)), self.place_of(first, second)
        while len(left):
            number = self.slots[at]
            same = (number >= 0) & (self.first[number] == first) & (self.second[number] == second)
            out[left[same]] = number[same]
            on = np.flatnonzero(~same & (number >= 0))
            left, first, second, at = left[on], first[on], second[on], at[on] + 1 & len(self.slots) - 1
        return out

    def add(self, first: np.ndarray, second: np.ndarray, start: int) -> None:
        """Give the numbers from `start` on to distinct strings that have none."""
        pad = np.zeros(max(0, start - len(self.first)), np.uint64)
        self.first = np.concatenate([self.first[:start], pad, first])
        self.second = np.concatenate([self.second[:start], pad, second])
        numbers = np.arange(start, start + len(first), dtype=np.int32)
        self.filled += len(first)
        if 2 * self.filled > len(self.slots):
            numbers = np.concatenate([self.slots[self.slots >= 0], numbers])
            self.slots = np.full(1 << (4 * self.filled - 1).bit_length(), -1, np.int32)
        at = self.place_of(self.first[numbers], self.second[numbers])
        while len(numbers):
            empty = self.slots[at] < 0
            self.slots[at[empty]] = numbers[empty]
            on = np.flatnonzero(self.slots[at] != numbers)
            numbers, at = numbers[on], at[on] + 1 & len(self.slots) - 1


def cut_pieces(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(begin, end, kind) of the pieces of a text, as a tokenizer that works word by word cuts them, and the text lowered.

    Inside words of ASCII and the letters of U+00C0 to U+00FF these are runs of letters, single digits and
    runs of other characters; only these letters are lowered. A word with an apostrophe, a control
    character, `<|` or any other character is one piece, of kind _WHOLE. The lowered text ends in zeros.
    """
    kind = np.frombuffer(bytearray(raw.translate(_KINDS)), np.uint8)
    low = bytearray(raw.lower() + bytes(24 - len(raw) % 8))
    lead = np.flatnonzero(np.frombuffer(raw, np.uint8) == 0xC3)
    if len(lead):
        code = np.frombuffer(low, np.uint8)
        tail = code[lead + 1]
        letter = (tail >= 0x80) & (tail <= 0xBF) & (tail != 0x97) & (tail != 0xB7)
        kind[lead[letter]] = kind[lead[letter] + 1] = _LETTER
        code[lead[letter & (tail <= 0x9E)] + 1] += 0x20
    whole = kind == _WHOLE
    if b"<|" in raw:
        code = np.frombuffer(raw, np.uint8)
        whole[:-1] |= (code[:-1] == ord("<")) & (code[1:] == ord("|"))
    if whole.any():
        inside = kind != _SPACE
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        word = np.cumsum(opens, dtype=np.int32)
        hit = np.zeros(int(word[-1]) + 1, bool)
        hit[word[whole]] = True
        kind = np.where(hit[word] & inside, np.uint8(_WHOLE), kind)
    edge = kind == _DIGIT
    edge[1:] |= kind[1:] != kind[:-1]
    edge[:1] = True
    marks = np.flatnonzero(edge)
    piece = kind[marks] != _SPACE
    begin, end = marks[piece], np.append(marks[1:], len(raw))[piece]
    return begin, end, kind[begin], bytes(low)


class Encoder:
    """A tokenizer of the tokenizers library that remembers the ids of what it met before, up to a bound.

    Where its settings lower-case and drop white space (`word_by_word`), its pieces never reach over
    a white-space character, so a text's ids are those of the pieces of its words (`cut_pieces`). Any
    other tokenizer gets whole texts and nothing is remembered.
    Pieces are known by their bytes: in arrays up to 16 of them, in a dictionary beyond that. A-Z are
    lowered first, but not in words that go to the library as they are.
    """

    def __init__(self, path: str, most: int = 1_500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.batch = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        self.most = most
        self.by_words = word_by_word(settings_of(self.tokenizer))
        # Whether the steps before the merges leave a word of lower-case letters as it is, but for the alphabet of bytes.
        probes = ["a", "the", "tokenizer", "qzxjkv", "abcdefghijklmnopqrstuvwxyz", "aaaaaaaa", *(chr(c) for c in range(0xDF, 0x100) if c != 0xF7)]
        self.plain = all(self.tokenizer.encode(p, add_special_tokens=False).ids == self.merge(p.encode()) for p in probes)
        self.forget()

    def forget(self) -> None:
        self.short, self.long, self.held = Pieces(), {}, 0
        self.begin, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def merge(self, word: bytes) -> list[int]:
        """Ids of a word by the library's merges alone."""
        text = word.decode() if word.isascii() else word.decode("latin-1").translate(_ALPHABET)
        return [t.id for t in self.tokenizer.model.tokenize(text)]

    def remember(self, pieces: list[bytes], lowered: np.ndarray) -> None:
        """Give the next numbers to new pieces; those that are lower-case letters alone need only the merges."""
        lists: list[list[int]] = [[]] * len(pieces)
        rest = []
        for i, (p, plain) in enumerate(zip(pieces, (lowered & self.plain).tolist(), strict=True)):
            if plain:
                lists[i] = self.merge(p)
            else:
                rest.append(i)
        for a in range(0, len(rest), 5000):
            part = rest[a : a + 5000]
            coded = self.batch([pieces[i].decode("utf-8", "replace") for i in part], add_special_tokens=False)
            for i, c in zip(part, coded, strict=True):
                lists[i] = c.ids
        sizes = np.fromiter(map(len, lists), np.int32, len(lists))
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(sizes, dtype=np.int64) - sizes])
        self.length = np.concatenate([self.length, sizes])
        self.ids = np.concatenate([self.ids, np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum()))])

    def numbers(self, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(number, begin) of each piece of `raw`; new ones are encoded and remembered."""
        begin, end, kind, low = cut_pieces(raw)
        size = end - begin
        out = np.empty(len(begin), np.int64)
        brief = (size <= 16) & (kind != _WHOLE)
        short = np.flatnonzero(brief)
        lanes, at, bits = np.frombuffer(low, "<u8"), begin[short] >> 3, ((begin[short] & 7) << 3).astype(np.uint64)
        back = np.uint64(64) - bits
        middle = lanes[at + 1]
        first = (lanes[at] >> bits | np.where(bits > 0, middle << back, 0)) & _MASKS[np.minimum(size[short], 8)]
        second = np.zeros(len(short), np.uint64)
        two = np.flatnonzero(size[short] > 8)
        second[two] = (middle[two] >> bits[two] | np.where(bits[two] > 0, lanes[at[two] + 2] << back[two], 0)) & _MASKS[size[short][two] - 8]
        found = self.short.look_up(first, second)
        new = np.flatnonzero(found < 0)
        if len(new):
            order = new[np.lexsort((second[new], first[new]))]
            change = (first[order[1:]] != first[order[:-1]]) | (second[order[1:]] != second[order[:-1]])
            once = order[np.concatenate(([True], change))]
            start = len(self.length)
            spots = short[once]
            self.remember([low[a:b] for a, b in zip(begin[spots].tolist(), end[spots].tolist(), strict=True)], kind[spots] == _LETTER)
            self.short.add(first[once], second[once], start)
            found[new] = self.short.look_up(first[new], second[new])
        out[short] = found
        rest = np.flatnonzero(~brief)
        if len(rest):
            spans = zip(begin[rest].tolist(), end[rest].tolist(), (kind[rest] == _WHOLE).tolist(), strict=True)
            words = [(raw if whole else low)[a:b] for a, b, whole in spans]
            kinds = dict(zip(words, kind[rest].tolist(), strict=True))
            fresh = [w for w in kinds if w not in self.long]
            start = len(self.length)
            self.remember(fresh, np.fromiter((kinds[w] == _LETTER for w in fresh), bool, len(fresh)))
            self.long.update(zip(fresh, range(start, start + len(fresh)), strict=True))
            self.held += sum(map(len, fresh)) + 150 * len(fresh)
            out[rest] = np.fromiter(map(self.long.__getitem__, words), np.int64, len(words))
        return out, begin

    def encode_words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of each text's ids)."""
        if len(self.length) > self.most or len(self.ids) > 16 * self.most or self.held > 64 * self.most:
            self.forget()
        raw = b"\n".join(texts) + b"\n"
        number, begin = self.numbers(raw)
        sizes = self.length[number].astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        flat = self.ids[np.repeat(self.begin[number] - ends[:-1], sizes) + np.arange(ends[-1])]
        text_ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        return flat, np.diff(ends[np.searchsorted(begin, text_ends)], prepend=0)

    def encode(self, texts: list[bytes | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, each followed by `end`; number of each text's ids, that one included)."""
        if not self.by_words:
            coded = self.batch([(t or b"").decode("utf-8", "replace") for t in texts], add_special_tokens=False)
            lists = [np.append(np.array(c.ids, np.int32), np.int32(end)) for c in coded]
            return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))
        parts, owner = [], []
        for i, t in enumerate(texts):
            for part in split_long(t or b"", CHUNK):
                parts.append(part)
                owner.append(i)
        coded = [self.encode_words(parts[a:b]) for a, b in ranges([len(p) for p in parts], CHUNK)]
        sizes = np.bincount(owner, weights=np.concatenate([c[1] for c in coded]), minlength=len(texts)).astype(np.int64)
        return np.insert(np.concatenate([c[0] for c in coded]), np.cumsum(sizes), end), sizes + 1


def split_long(text: bytes, most: int) -> Iterator[bytes]:
    """A text in parts, each cut before the first ASCII white space that follows `most` bytes."""
    at = 0
    while (found := _BLANK.search(text, at + most)) is not None:
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


def encoder(path: str) -> Encoder:
    """One per worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write(
    docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text", end: int = 1,
    encoding: str = "dictionary", row_group_bytes: int = 8 << 20, page_rows: int = 1000,
) -> None:
    """Write (doc_id, n_tokens, part, offset, ids) of `docs` under `path`, in ascending doc_id order, nulls first.

    offset: ids of the part before the document; equal ids are in the order of their texts' hashes.
    A null or empty text gives the end id alone. `tokenizer` is a path that the executors can read.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, offset, coder = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in batches:
            texts, at, total = utf8(batch.column(1)), 0, 0
            for i, t in enumerate(texts):
                total += len(t or b"")
                if total < CHUNK and i + 1 < len(texts):
                    continue
                ids, sizes = coder.encode(texts[at : i + 1], end)
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, i + 1 - at),
                        pa.array(sizes),
                        pa.array(np.full(len(sizes), part, np.int32)),
                        pa.array(offset + ends - sizes),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids)),
                    ],
                    ["doc_id", "n_tokens", "part", "offset", "ids"],
                )
                offset, at, total = offset + int(ends[-1]), i + 1, 0

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    order = [F.asc_nulls_first("doc_id"), "tie", "row"]
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    coded = placed.mapInArrow(encode, f"doc_id {kind}, n_tokens BIGINT, part INT, offset BIGINT, ids ARRAY<INT>")
    options = WRITER[encoding] | {"parquet.block.size": str(row_group_bytes), "parquet.page.row.count.limit": str(page_rows)}
    coded.write.options(**options, compression="snappy").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of the files under `path`; a reader of the first three touches no ids."""
    rows = spark.read.parquet(path)
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("before"))
    placed = rows.join(F.broadcast(parts), "part")  # one row per part file
    return placed.select("doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids")


def digests(rows: DataFrame, columns: list[str], ids: str = "ids") -> DataFrame:
    """`columns` and ids_crc32, the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(columns))
            ends = lists.offsets.to_numpy()
            data = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(sums, pa.int64())], [*columns, "ids_crc32"])

    fields = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.select(*columns, ids).mapInArrow(crc, f"{fields}, ids_crc32 BIGINT")


def round_trip(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of `docs`, written to a new folder of the shared one and read back."""
    spark = docs.sparkSession
    path = work_path(spark, "tokens")
    write(docs, path, tokenizer, **options)
    return digests(read(spark, path), ["doc_id", "start", "n_tokens"])
