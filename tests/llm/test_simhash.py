"""SimHash components against brute force."""

import random
import re

import numpy as np
import pytest
import xxhash

from cohortloom.llm import simhash

SCHEMA = "doc_id BIGINT, text STRING, fp STRING, size INT"


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """doc_id -> smallest id within reach, over all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                root[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted([(str(d), f"{fps[i]:016x}", least.get(top(i))) for i, (d, _) in enumerate(rows)], key=str)


def found(df):
    rows = simhash.near_duplicates(df).withColumn("hex", simhash.hexadecimal(simhash.F.col("fp"))).collect()
    return sorted([(str(r["doc_id"]), r["hex"], r["component_id"]) for r in rows], key=str)


def edge_rows():
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "A"), (5, "a"), (6, "É x"), (7, "é x"), (None, "a"), (None, "lonely text of nobody"), (None, None), (8, "a b c"), (8, "a b c"), (9, "dots\x00 and\x1funits")]
    base = " ".join(rng.choice(words) for _ in range(400))
    for i in range(40):
        near = base.split()
        near[rng.randrange(400)] = "changed"
        rows.append((100 + i, " ".join(near)))
    rows += [(200 + i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    return rows


def test_against_all_pairs(spark):
    rows = edge_rows() + [(500, "long " * 200_000)]
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)
    assert found(df) == plain_components(rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert found(df) == []
    assert simhash.keep_one(df).count() == 0


def test_keep_one_keeps_columns_and_distinct_null_ids(spark):
    rows = edge_rows()
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.collect()]
    want = {c for _, _, c in plain_components(rows)}
    assert {i for i in ids if i is not None} == {c for c in want if c is not None}
    assert ids.count(None) == 1  # the lonely text; the other two have copies with an id


@pytest.mark.parametrize("tile", [8, 64])
def test_crowded_buckets_lose_no_link(spark, tile):
    """Fingerprints around a few centres, far more than a tile: all three levels of buckets are used."""
    rng = np.random.default_rng(5)
    fps = set()
    for centre in rng.integers(0, 2**63, 3):
        for _ in range(150):
            x = int(centre)
            for b in rng.integers(0, 64, rng.integers(1, 6)):
                x ^= 1 << int(b)
            fps.add(x)
    fps = sorted(fps)
    signed = [int(np.array(x, dtype=np.uint64).view(np.int64)) for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp BIGINT")
    got = simhash.components(simhash.links(df, 4, tile)).collect()
    root = {r["node"]: r["root"] for r in got}
    label = {x: x for x in signed}
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(fps):
            for j in range(i):
                if (x ^ fps[j]).bit_count() <= 4:
                    low = min(label[signed[i]], label[signed[j]])
                    for k in (signed[i], signed[j]):
                        if label[k] != low:
                            label[k], changed = low, True
    assert {x: root.get(x, x) for x in signed} == label


def test_on_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found(docs) == plain_components(rows)
