"""Base counts and log-likelihood ratios against plain Python."""

import math
import re

import pytest
import xxhash

from cohortloom.llm import quality
from tests.llm import edges


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs, covered = {}, set()
    for i in range(len(words) - 2):
        runs.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in runs.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(3))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def grams(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    hashed = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = [xxhash.xxh64_intdigest(w.encode(), h) for h, w in zip(hashed, words[1:])]
    return [signed(h) % quality.BUCKETS for h in hashed + pairs]


@pytest.mark.parametrize("where", ["edges", "tables"])
def test_against_plain_python(spark, tmp_path, where):
    folder = edges.write(tmp_path, rows=edges.documents(longest=60_000)) if where == "edges" else "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = {r["doc_id"]: r["held"] for r in quality.trusted_ids(labels).collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"] and r["doc_id"] is not None}
    assert set(held) == good
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    raw, target = {}, {}
    for d, t in rows:
        for g in grams(t):
            raw[g] = raw.get(g, 0) + 1
            if held.get(d) is False:
                target[g] = target.get(g, 0) + 1
    all_raw, all_target, prior = sum(raw.values()), sum(target.values()), quality.SMOOTHING * quality.BUCKETS

    def weight(g):
        share = raw[g] / all_raw
        return math.log((target.get(g, 0) + prior * share) / (all_target + prior) / share) if all_target else 0.0

    want = []
    for d, t in rows:
        found = grams(t)
        want.append((str(d), *base(t), round(sum(map(weight, found)) / len(found), 9) if found else None))
    calibration = sorted(w[-1] for (d, _), w in zip(rows, want) if held.get(d) and not w[-2])
    got = quality.judge(docs, labels).collect()
    key = lambda r: [str(x) for x in r]
    assert sorted([(str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"], r["llr"] and round(r["llr"], 9)) for r in got], key=key) == sorted(want, key=key)
    limit = calibration[0] - quality.MARGIN if calibration else quality.THRESHOLD
    assert all(r["kept"] == (not r["base_failed"] and round(r["llr"], 9) >= round(limit, 9)) for r in got)


def test_junk_goes_and_clean_stays(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    judged = quality.judge(docs, labels).filter("NOT base_failed").join(labels, "doc_id")
    rows = judged.select("quality", "kept").collect()
    assert all(r["kept"] for r in rows if r["quality"] == 1)
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(bad) <= 0.2 * len(bad)


def test_nobody_trusted(spark):
    docs = spark.createDataFrame([(1, "a b c " * 30), (2, None)], "doc_id BIGINT, text STRING")
    labels = spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT")
    assert {r["doc_id"]: (r["llr"], r["kept"]) for r in quality.judge(docs, labels).collect()} == {1: (0.0, False), 2: (None, False)}
