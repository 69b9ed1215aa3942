"""The pipeline stage by stage against plain Python, and that its decisions take effect."""

import re
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohortloom.llm import language
from cohortloom.llm.plans import public_tokenizer
from tests.llm import edges
from tests.llm.test_simhash import plain_components

WORD = r"[^\x20\x09-\x0D]+"


def written(spark, df, path):
    df.write.parquet(str(path))
    return spark.read.parquet(str(path))


def rows_of(df):
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in df.collect()), key=str)


def plain_contaminated(text, items):
    def words(t):
        t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)

    mine, hit = words(text), set()
    for item in map(words, items):
        n = min(13, len(item))
        windows = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        for k in range(len(mine) - n + 1) if n else []:
            if tuple(mine[k : k + n]) in windows:
                hit.update(range(k, k + n))
    return bool(hit) and 20 * len(hit) >= len(mine)


@pytest.mark.parametrize("where", ["edges", "tables"])
def test_stages(spark, tmp_path, where):
    folder = edges.write(tmp_path) if where == "edges" else "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]

    one = written(spark, stages["language_id"](spark, docs, folder), tmp_path / "1")
    assert one.columns == docs.columns
    gone = [r["text"] for r in docs.exceptAll(one).collect()]
    lettered = [t for t in gone if t and any(c.isalpha() for c in t)]
    assert len(lettered) <= 0.02 * docs.count()  # und goes, clean prose stays
    assert all(r["text"] and any(c.isalpha() for c in r["text"]) for r in one.collect())

    two = written(spark, stages["near_duplicates"](spark, one, folder), tmp_path / "2")
    assert two.columns == docs.columns
    found = plain_components([(r["doc_id"], r["text"]) for r in one.collect()])
    assert sorted(r["doc_id"] for r in two.collect() if r["doc_id"] is not None) == sorted({c for _, _, c in found if c is not None})

    three = written(spark, stages["decontaminate"](spark, two, folder), tmp_path / "3")
    assert three.columns == docs.columns
    assert rows_of(three) == sorted(((r["doc_id"], r["text"], r["source"]) for r in two.collect() if not plain_contaminated(r["text"], items)), key=str)

    four = written(spark, stages["mix"](spark, three, folder), tmp_path / "4")
    assert four.columns == docs.columns
    size = lambda r: len(re.findall(WORD, r["text"] or ""))
    before, after = three.collect(), four.collect()
    assert abs(sum(map(size, after)) - 1.5 * sum(map(size, before))) <= 4 * max(map(size, before)) * len({r["source"] for r in before})
    times = {}
    for r in after:
        times[r["doc_id"]] = times.get(r["doc_id"], 0) + 1
    assert set(times) <= {r["doc_id"] for r in before} and max(times.values()) <= 2

    five = written(spark, stages["tokens"](spark, four, folder), tmp_path / "5")
    t = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json"))
    want = []
    for r in after:
        ids = t.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        want.append((str(r["doc_id"]), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in five.collect()) == sorted(want)


def test_run_on_empty_tables(spark, tmp_path):
    folder = edges.write(tmp_path, rows=[], items=[], pages=[], labels=[])
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_language_rejection_spares_clean_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.fit(docs, calibration=None)
    model.cutoff = np.full(len(model.langs), 2.5)
    odd = spark.createDataFrame([("qzxv wqkj xzzq vvkq jjxq zzkw qqvx kjwz " * 20,), (None,), ("12 34",)], "text STRING")
    assert all(r["language"]["rejected"] for r in language.identify(odd, model).collect())
