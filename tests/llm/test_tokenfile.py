"""Token files against the tokenizers library itself."""

import json
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from cohortloom.llm import tokenfile
from cohortloom.llm.plans import public_tokenizer
from tests.llm import edges

PATH = public_tokenizer("word_bpe_49k.json")


def plain(rows):
    """(doc_id, start, n_tokens, crc) in id order; equal ids in any order of their own."""
    t = Tokenizer.from_file(PATH)
    out, start = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def key(r):
    return [x is not None and x for x in r]


def test_words_of_a_text_are_encoded_one_by_one():
    t, e = Tokenizer.from_file(PATH), tokenfile.Encoder(PATH)
    rng = random.Random(1)
    alphabet = ["a", "B", "\u00e9", "e\u0301", "\u03a3", "'s", "'", "n.t", "Word.", "End?!", "x.y.", "<|ENDOFTEXT|>", " ", "\t", "\u00a0", "\u2028", "\x1c", "\x85", "7", "<|endoftext|>", "\u4e2d", "\U0001f600", "\u0301", "!", "\u0130"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(30))) for _ in range(3000)]
    ids, sizes = e.encode([x.encode() for x in texts], 1)
    ends = np.cumsum(sizes)
    for x, a, b in zip(texts, ends - sizes, ends):
        assert ids[a:b].tolist() == t.encode(x, add_special_tokens=False).ids + [1], repr(x)


def test_forgetting_changes_nothing():
    small, large = tokenfile.Encoder(PATH, most=3), tokenfile.Encoder(PATH)
    for text in (b"one two three four five", b"two six", b"", None, b"one"):
        assert small.encode([text], 1)[0].tolist() == large.encode([text], 1)[0].tolist()


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_round_trip_on_edges(spark, tmp_path, encoding):
    rows = edges.documents(longest=100_000)
    docs = spark.read.parquet(edges.write(tmp_path, rows=rows) + "/documents.parquet")
    got = [tuple(r) for r in tokenfile.round_trip(docs, PATH, encoding=encoding).collect()]
    want = plain([(r[0], r[1]) for r in rows])
    assert sorted(key((r[0], r[2], r[3])) for r in got) == sorted(key((r[0], r[2], r[3])) for r in want)
    assert sorted(r[1] for r in got if r[0] is not None) == sorted(r[1] for r in want if r[0] is not None)
    at = 0
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == at
        at += r[2]


def test_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(tuple(r) for r in tokenfile.round_trip(docs, PATH).collect())
    assert got == plain([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])


def test_layout_of_the_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    path = str(tmp_path / "tokens")
    tokenfile.write(docs.coalesce(1), path, PATH, row_group_bytes=1 << 18, page_rows=50)
    files = sorted((tmp_path / "tokens").glob("part-*.parquet"))
    meta = [pq.ParquetFile(f).metadata for f in files]
    assert max(m.num_row_groups for m in meta) > 1
    column = next(c for c in (meta[0].row_group(0).column(i) for i in range(meta[0].num_columns)) if c.path_in_schema.startswith("ids"))
    assert "RLE_DICTIONARY" in column.encodings or "PLAIN_DICTIONARY" in column.encodings
    assert column.has_offset_index and column.has_column_index
    plan = tokenfile.read(spark, path).select("doc_id", "start")._jdf.queryExecution().toString()
    assert "ids" not in plan.split("ReadSchema")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_librarys_for_every_vocabulary(name):
    t, e = Tokenizer.from_file(public_tokenizer(name)), tokenfile.Encoder(public_tokenizer(name))
    assert e.by_words == (name == "word_bpe_49k.json")
    texts = ["Hello World, two  spaces", "", None, " lead\n\ntail ", "it's A<|endoftext|>b", "\u00dcber \u4e2d\u6587 7x!"] * 2
    ids, sizes = e.encode([None if x is None else x.encode() for x in texts], 1)
    ends = np.cumsum(sizes)
    for x, a, b in zip(texts, ends - sizes, ends):
        assert ids[a:b].tolist() == t.encode(x or "", add_special_tokens=False).ids + [1]


def test_settings_that_need_whole_texts():
    settings = tokenfile.settings_of(Tokenizer.from_file(PATH))
    with open(PATH, encoding="utf-8") as file:
        whole = json.load(file)
    assert all(settings[k] == whole[k] for k in ("normalizer", "pre_tokenizer", "post_processor"))
    assert tokenfile.word_by_word(settings)
    assert not tokenfile.word_by_word(settings | {"normalizer": None})
    assert not tokenfile.word_by_word(settings | {"pre_tokenizer": {"type": "Whitespace"}})
    assert not tokenfile.word_by_word(settings | {"post_processor": {"type": "ByteLevel"}})
    assert not tokenfile.word_by_word(settings | {"added_tokens": [settings["added_tokens"][0] | {"content": "[SEP]"}]})


def test_pieces_of_every_kind(monkeypatch):
    t, e = Tokenizer.from_file(PATH), tokenfile.Encoder(PATH)
    rng = random.Random(2)
    alphabet = ["É", "é", "ß", "×", "÷", "ÿ", "Ü", "Ÿ", "ǅ", "K", "A", "z", "0", "9", "$", "&", "<", "|", "'", "'S", "'ll", "’", "\x00", "\x7f", "́", " ", " ", "\n", "ABCDEFGH", "abcdefghijklmnopqrs", "--------"]
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(40))) for _ in range(4000)]
    want = [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]
    for most in (1_000_000, 50):
        monkeypatch.setattr(tokenfile, "CHUNK", most)
        ids, sizes = e.encode([x.encode() for x in texts], 1)
        ends = np.cumsum(sizes)
        for x, w, a, b in zip(texts, want, ends - sizes, ends, strict=True):
            assert ids[a:b].tolist() == w, repr(x)


def test_bytes_that_are_not_utf8():
    t, e = Tokenizer.from_file(PATH), tokenfile.Encoder(PATH)
    for x in (b"\xc3", b"a\xc3 b", b"\xc3A\xc3\xa9", b"\xa9b", b"\xc3\x97\xc3\x89t\xc3\x89"):
        assert e.encode([x], 1)[0].tolist() == t.encode(x.decode("utf-8", "replace"), add_special_tokens=False).ids + [1]


def test_strings_in_one_place_keep_their_own_numbers(monkeypatch):
    monkeypatch.setattr(tokenfile.Pieces, "place_of", lambda self, first, second: np.full(len(first), len(self.slots) - 1))
    table, rng = tokenfile.Pieces(), np.random.default_rng(3)
    keys = np.unique(rng.integers(1, 50, (300, 2)).astype(np.uint64), axis=0)
    table.add(keys[:100, 0], keys[:100, 1], 0)
    table.add(keys[100:, 0], keys[100:, 1], 150)
    got = table.look_up(keys[:, 0], keys[:, 1])
    assert got.tolist() == [*range(100), *range(150, 50 + len(keys))]
    assert table.look_up(np.array([77], np.uint64), np.array([0], np.uint64)).tolist() == [-1]


def test_a_table_of_pieces_grows():
    table, keys = tokenfile.Pieces(), np.arange(1, 100_001, dtype=np.uint64)
    for a in range(0, len(keys), 30_000):
        table.add(keys[a : a + 30_000], keys[a : a + 30_000], a)
    assert table.look_up(keys, keys).tolist() == list(range(100_000))
