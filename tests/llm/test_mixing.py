"""The mix: exact targets at any size, even prefixes, and groups of equal rows spread over many."""

import math

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import mixing


def table(spark, sizes):
    rows = [(i, i, s, n) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "row BIGINT, doc_id BIGINT, source STRING, size BIGINT")


@pytest.mark.parametrize("block", [1, 7, 64, mixing.BLOCK])
def test_targets_are_met_by_whole_blocks_and_one_cut_one(spark, block):
    docs = table(spark, [("abcdef"[i % 6 if i % 2 else 0], 1 + i * 37 % 300) for i in range(400)] + [(None, 5), ("b", None), ("c", 0)])
    pieces, plan = mixing.mix(docs, [3, 1, 2], block=block)
    want = {r["source"]: round(r["target"]) for r in plan.collect()}
    rows = pieces.collect()
    got, slots = {}, {}
    for r in rows:
        words = r["to_word"] - r["from_word"]
        assert words > 0
        got[r["source"]] = got.get(r["source"], 0) + words
        slots.setdefault(r["turn"], [set(), 0])
        slots[r["turn"]][0].add(r["source"])
        slots[r["turn"]][1] += words
    assert got == {s: n for s, n in want.items() if n}
    assert sorted(slots) == list(range(sum(-(-n // block) for n in want.values())))
    assert all(len(s) == 1 for s, _ in slots.values())
    cut = [n for _, n in slots.values() if n != block]
    assert len(cut) <= len(want) and all(n < block for n in cut)


@pytest.mark.parametrize("slots", [1, 2, 38, 97, 1024, 30030, 65536, 100_000, 720_720])
def test_every_prefix_has_its_share(slots):
    step = mixing.multiplier(slots)
    assert slots == 1 or math.gcd(step, slots) == 1
    spots = [k * step % slots for k in range(slots)]
    assert len(set(spots)) == slots
    for low, high in ((0, slots // 3), (slots // 3, slots // 2), (slots // 2, slots)):
        seen = worst = 0
        for k, spot in enumerate(spots, 1):
            seen += low <= spot < high
            worst = max(worst, abs(seen - k * (high - low) / slots))
        assert worst <= 2 + math.log2(slots)


def test_products_of_large_turns(spark):
    slots = (1 << 41) - 21
    step = mixing.multiplier(slots)
    turns = [0, 1, 12345, (1 << 33) + 7, slots - 1]
    rows = spark.createDataFrame([(t,) for t in turns], "turn BIGINT")
    got = rows.select("turn", mixing.product(F.col("turn"), step, slots).alias("at")).collect()
    assert {r["turn"]: r["at"] for r in got} == {t: t * step % slots for t in turns}


def test_null_ids_spread_over_many_groups(spark):
    rows = spark.range(60_000).select(F.col("id").alias("row"), F.lit(None).cast("long").alias("doc_id"), F.lit("hot").alias("source"), (F.col("id") % 3 + 1).alias("size"))
    docs = rows.withColumn("mark", F.lit("same"))
    seen = mixing.copies(docs, "mix")
    assert seen.groupBy("source", "draw", "size", "chunk").count().agg(F.max("count")).first()[0] <= mixing.RANGE
    stacks = seen.groupBy("source", "draw", "size", "chunk").count().count()
    assert stacks <= 3 * (60_000 // mixing.RANGE + 1)  # what one window over the hot id holds
    told_apart = mixing.copies(rows.withColumn("mark", F.md5(F.col("row").cast("string"))), "mix")
    assert told_apart.select("draw").distinct().count() == 60_000
    out = mixing.taken(docs, [3, 1, 2], share=1.5).agg(F.sum("taken"), F.max(F.col("taken") - 2 * F.col("size")), F.count("*")).first()
    assert tuple(out) == (180_000, 0, 60_000)


def test_copies_do_not_depend_on_row_numbers(spark):
    rows = [(i, i % 4 or None, "ab"[i % 2], 10 + i % 4, str(i % 4)) for i in range(200)]
    schema = "row BIGINT, doc_id BIGINT, source STRING, size BIGINT, mark STRING"
    one = spark.createDataFrame(rows, schema)
    other = spark.createDataFrame([(7919 * (199 - r[0]) + 5, *r[1:]) for r in rows], schema)
    got = [sorted(map(str, mixing.taken(d, [3, 1, 2], block=16).drop("row").collect())) for d in (one, other)]
    assert got[0] == got[1]
