"""Token counts against the tokenizers library, and the transducers' composition."""

import random

import numpy as np
from tokenizers import Tokenizer

from cohortloom.llm import tokencount
from cohortloom.llm.plans import QUERIES, public_tokenizer
from tests.llm import edges

PATH = public_tokenizer("byte_bpe_50k.json")
PARTS = ["a", "re", "ve", "ll", "s", "d", "m", "t", "l", "v", "r", "e", "S", "'", "''", " ", "  ", "\n", "\t", " ", "　", "\x1c", "\x85", "1", "²", "٠", "!", ".", "́", "é", "ß", "中", "\U0001f600", "՘", "\x00", "<|endoftext|>", "<|", "​"]


def texts(n, longest=60, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choices(PARTS, k=rng.randrange(longest))) for _ in range(n)]


def plain(items):
    t = Tokenizer.from_file(PATH)
    return [len(t.encode(x, add_special_tokens=False).ids) for x in items]


def test_any_mixture_of_characters():
    items = texts(4000) + texts(30, longest=3000, seed=2) + ["", "'", "'r", "'re", "'l", " ", "\n\n"]
    assert tokencount.Machine(PATH).count(items).tolist() == plain(items)


def test_forgetting_and_one_long_word_change_nothing():
    m = tokencount.Machine(PATH, remembered=5)
    for part in ([*texts(50, seed=3)], ["x" * 5000 + " y"], ["ab" * 700_000], texts(50, seed=3)):
        assert m.count(part).tolist() == plain(part)


def test_pretokens_begin_where_the_library_says():
    t, m = Tokenizer.from_file(PATH), tokencount.Machine(PATH)
    for x in texts(500, seed=4):
        classes = np.append(m.classify(np.frombuffer(x.encode("utf-32-le"), "<u4")), np.uint8(tokencount.END))
        got = np.flatnonzero(tokencount.begins(classes)).tolist()
        assert got == sorted({a for _, (a, b) in t.pre_tokenizer.pre_tokenize_str(x)}), repr(x)


def test_prefix_scan_equals_running_one_after_the_other():
    rng = np.random.default_rng(1)
    maps = rng.integers(0, 12, (37, 12)).astype(np.uint8)
    state, want = np.arange(12), []
    for m in maps:
        state = m[state]
        want.append(state)
    assert np.array_equal(tokencount.compose_prefixes(maps), np.array(want))


def test_white_space_table():
    import regex

    assert [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and regex.fullmatch(r"\p{White_Space}", chr(c))] == tokencount.SPACES


def test_on_edges_and_tables(spark, tmp_path):
    for folder in (edges.write(tmp_path, rows=edges.documents(longest=100_000)), "/root/testdata/sf0.001"):
        docs = {(str(r["doc_id"]), r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
        want = {(d, len((t or "").encode()), n, n > 1024) for (d, t), n in zip(docs, plain([t or "" for _, t in docs]))}
        got = {(str(r["doc_id"]), r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in QUERIES["op10_token_count"](spark, folder).collect()}
        assert got == want
