"""Similarity, walks and power iteration against brute force on small graphs."""

import os
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import pic, similarity, walk

ITEMS = "patient_id BIGINT, item STRING"


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def item_frame(spark, sets):
    return spark.createDataFrame([(p, i) for p, items in sets.items() for i in sorted(items)], ITEMS)


def random_sets(seed, n=60):
    """Small sets over a few common and many rare items, some of them equal."""
    rnd = random.Random(seed)
    sets = {}
    for p in range(n):
        if p % 7 == 3:
            sets[p] = set(sets[p - 1])
        else:
            common = rnd.sample(["h0", "h1", "h2"], rnd.randint(0, 3))
            sets[p] = set(common) | {f"r{rnd.randint(0, 12)}" for _ in range(rnd.randint(0 if common else 1, 5))}
    return sets


@pytest.mark.parametrize("threshold", [0.2, 0.34, 0.5, 0.8, 1.0])
@pytest.mark.parametrize("hot", [3, 1000])
def test_similar_sets_match_brute_force(spark, threshold, hot):
    sets = random_sets(int(threshold * 100) + hot)
    found, members = similarity.distinct_sets(item_frame(spark, sets))
    got = {(r.s1, r.s2): r.similarity for r in similarity.similar_sets(found, threshold, hot).collect()}
    rep = {r.patient_id: r.set_id for r in members.collect()}
    assert rep == {p: min(q for q in sets if sets[q] == sets[p]) for p in sets}
    reps = sorted(set(rep.values()))
    want = {(a, b): jaccard(sets[a], sets[b]) for a in reps for b in reps if a < b and jaccard(sets[a], sets[b]) >= threshold}
    assert got == pytest.approx(want)


def work(sized, threshold, hot):
    """Pairs that the lists compare: all of an open list, and those of equal key in a crowded one."""
    levels, _ = similarity.candidate_lists(sized, threshold, hot)
    total = 0
    for _, open_, crowded in levels:
        sizes = open_.groupBy("list", "key").agg(F.count("*").alias("n"))
        total += sizes.agg(F.coalesce(F.sum(F.col("n") * (F.col("n") - 1)), F.lit(0))).first()[0]
    return len(levels), total


def test_crowded_item_costs_linear_work(spark):
    """Sets {x, a_i} share one item by the thousand and none reaches one half."""
    sets = {p: {"x", f"a{p}"} for p in range(4000)} | {9000: {"x"}}
    found, _ = similarity.distinct_sets(item_frame(spark, sets))
    sized = found.select("set_id", "items", F.size("items").alias("size"))
    _, compared = work(sized, 0.6, 50)
    assert compared <= 4000
    assert similarity.similar_sets(found, 0.6, 50).count() == 0
    pairs = similarity.similar_sets(found, 0.5, 50)
    assert {tuple(r) for r in pairs.collect()} == {(p, 9000, 0.5) for p in range(4000)}


def test_paths_grow_until_no_list_is_crowded(spark):
    """Four items in every set, six more of their own: only paths of several items tell the sets apart."""
    rnd = random.Random(3)
    sets = {p: {"w", "x", "y", "z"} | {f"r{rnd.randrange(400)}" for _ in range(6)} for p in range(300)}
    sets |= {1000 + p: (sets[p] - {"w"}) | {"q"} for p in range(20)}
    found, _ = similarity.distinct_sets(item_frame(spark, sets))
    sized = found.select("set_id", "items", F.size("items").alias("size"))
    levels, compared = work(sized, 0.3, 20)
    assert levels > 1 and compared < 320 * 319
    got = {(r.s1, r.s2): r.similarity for r in similarity.similar_sets(found, 0.3, 20).collect()}
    want = {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b and jaccard(sets[a], sets[b]) >= 0.3}
    assert got == pytest.approx(want)


def test_sets_that_share_little_are_no_candidates(spark):
    """Sets of eight items out of four hundred meet by the thousand, over one item of the first half; hardly one pair is compared."""
    rnd = random.Random(5)
    sets = {p: {f"r{i}" for i in rnd.sample(range(400), 8)} for p in range(400)}
    found, _ = similarity.distinct_sets(item_frame(spark, sets))
    sized = found.select("set_id", "items", F.size("items").alias("size"))
    levels, _ = similarity.candidate_lists(sized, 0.5)
    compared = [similarity._met(open_, depth, 0.5).count() for depth, open_, _ in levels]
    assert sum(compared) < 100


def test_rows_without_hope_leave_a_crowded_list(spark):
    """Two common items behind two rare ones make no pair at one half: their lists are not kept, nor made longer."""
    sets = {p: {"x", "y"} | {f"a{p}.{i}" for i in range(2)} for p in range(300)}
    found, _ = similarity.distinct_sets(item_frame(spark, sets))
    sized = found.select("set_id", "items", F.size("items").alias("size"))
    levels, _ = similarity.candidate_lists(sized, 0.5, 50)
    assert len(levels) <= 2
    assert all(crowded is None or crowded.isEmpty() for _, _, crowded in levels)


def test_no_sets_have_no_pairs(spark):
    assert similarity.all_pairs(spark.createDataFrame([], ITEMS), 0.5).collect() == []


def test_all_pairs_of_many_copies_stay_linear(spark):
    sets = {p: {"a", "b"} for p in range(500)} | {1000: {"a", "b", "c"}, 1001: {"z"}}
    rows = similarity.all_pairs(item_frame(spark, sets), 0.5).collect()
    assert len(rows) == 499 + 1
    assert {(r.p1, r.p2) for r in rows if r.similarity < 1} == {(0, 1000)}


@pytest.mark.parametrize("most_items", [20, 4_000_000])
def test_every_pair_has_its_similarity(spark, most_items):
    """No threshold: copies and pairs without a common item among them, within a block and across blocks."""
    sets = random_sets(3) | {100: {"alone"}, 101: {"alone"}}
    frame = item_frame(spark, sets)
    want = {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b}
    assert {0.0, 1.0} < set(want.values())
    rows = similarity.all_pairs(frame).collect()
    assert len(rows) == len(want) and {(r.p1, r.p2): r.similarity for r in rows} == want
    rows = similarity.every_pair(similarity.item_sets(frame), most_items).collect()
    assert len(rows) == len(want) and {(r.p1, r.p2): r.similarity for r in rows} == want


def test_registered_pairs_are_all_of_them(spark, tmp_path):
    from cohortloom.plans import QUERIES

    write = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    write("part", [(k, ["LARGE", "SMALL"][k % 2]) for k in range(9)], "p_partkey BIGINT, p_type STRING")
    lines = [(s, (s * 5 + i * 3) % 9) for s in range(12) for i in range(1 + s % 3)]
    write("lineitem", lines, "l_orderkey BIGINT, l_partkey BIGINT")
    sets = {s: {x for o, k in lines if o == s for x in (k, "LS"[k % 2])} for s in range(12)}
    got = {(r.p1, r.p2): r.similarity for r in QUERIES["jaccard_all_pairs"](spark, str(tmp_path)).collect()}
    assert got == {(a, b): jaccard(sets[a], sets[b]) for a in sets for b in sets if a < b}
    assert min(got.values()) == 0.0


def test_no_patients_have_no_pairs(spark):
    assert similarity.all_pairs(spark.createDataFrame([], ITEMS)).collect() == []


def test_pairs_asked_for(spark):
    sets = {1: {"a", "b"}, 2: {"a", "b"}, 3: {"c"}, 4: {"b", "c", "d"}}
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (5, 6)], "p1 BIGINT, p2 BIGINT")
    got = {(r.p1, r.p2): r.similarity for r in similarity.for_pairs(pairs, item_frame(spark, sets)).collect()}
    assert got == {(1, 2): 1.0, (1, 3): 0.0, (1, 4): 0.25, (5, 6): 0.0}


def test_one_vs_all_keeps_zeros(spark):
    sets = {1: {"a", "b"}, 2: {"b"}, 3: {"c"}}
    people = spark.createDataFrame([(1,), (2,), (3,), (4,)], "patient_id BIGINT")
    rows = similarity.one_vs_all(people, item_frame(spark, sets), 1).collect()
    assert [tuple(r) for r in rows] == [(2, 0.5), (3, 0.0), (4, 0.0)]


def walked(n, edges, start, rounds, alpha=0.15):
    out = {v: [d for s, d in edges if s == v] for v in range(n)}
    p = [1.0 if v == start else 0.0 for v in range(n)]
    for _ in range(rounds):
        q = [0.0] * n
        q[start] += alpha
        for v in range(n):
            for d in out[v] or [start]:
                q[d] += (1 - alpha) * p[v] / max(len(out[v]), 1)
        p = q
    return p


@pytest.mark.parametrize("split", [2, 100_000])
def test_walk_matches_brute_force(spark, split):
    # A hub (0) with many edges, a vertex without out-edges (9), an unreachable one (10).
    edges = [(0, v) for v in range(1, 9)] + [(v, 0) for v in range(1, 8)] + [(1, 2), (2, 1), (3, 9), (8, 9)]
    nodes = spark.range(11).withColumnRenamed("id", "vid")
    frame = spark.createDataFrame(edges, "src BIGINT, dst BIGINT")
    got = walk.restart_walk(nodes, frame, 1, rounds=7, rows_per_split=split, cut_every=3).collect()
    p = [r.probability for r in sorted(got, key=lambda r: r.vid)]
    assert p == pytest.approx(walked(11, edges, 1, 7))
    assert sum(p) == pytest.approx(1.0)


def test_walk_stops_when_settled(spark):
    nodes = spark.range(3).withColumnRenamed("id", "vid")
    frame = spark.createDataFrame([(0, 1), (1, 0), (1, 2), (2, 1)], "src BIGINT, dst BIGINT")
    got = walk.restart_walk(nodes, frame, 0, rounds=60, tolerance=1e-2).orderBy("vid").collect()
    assert [r.probability for r in got] == pytest.approx(walked(3, [(0, 1), (1, 0), (1, 2), (2, 1)], 0, 200), abs=2e-2)


def test_power_iteration_separates_components(spark):
    groups = [range(0, 6), range(6, 12), range(12, 18)]
    rows = [(a, b, 1.0) for g in groups for a in g for b in g if a < b]
    pairs = spark.createDataFrame(rows, "src BIGINT, dst BIGINT, weight DOUBLE")
    got = {r.id: r.cluster for r in pic.assign_clusters(pairs, 3, rounds=20).collect()}
    assert [len({got[v] for v in g}) for g in groups] == [1, 1, 1]
    assert len(set(got.values())) == 3


def test_split_hub_gives_the_same_embedding(spark):
    rows = [(0, v, 1.0 + v % 3) for v in range(1, 30)] + [(3, 4, 2.0)]
    pairs = spark.createDataFrame(rows, "src BIGINT, dst BIGINT, weight DOUBLE")
    one = pic.embed(pairs, rounds=4, rows_per_split=3).orderBy("id").select(F.round("x", 12)).collect()
    two = pic.embed(pairs, rounds=4).orderBy("id").select(F.round("x", 12)).collect()
    assert one == two


def test_copies_count_as_on_all_pairs(spark):
    """Four equal patients, three equal ones and a single one: the compact graph gives what all pairs give."""
    import numpy as np

    from cohortloom.functions.columns import hash_unit

    members = [(i, 0) for i in range(4)] + [(i, 4) for i in range(4, 7)] + [(7, 7)]
    weights = {(0, 4): 0.6, (4, 7): 0.3}
    n = len(members)
    full = np.zeros((n, n))
    for i, (_, a) in enumerate(members):
        for j, (_, b) in enumerate(members):
            if i != j:
                full[i, j] = 1.0 if a == b else weights.get((a, b), weights.get((b, a), 0.0))
    start = spark.createDataFrame(members, "id BIGINT, set_id BIGINT")
    x = np.array([r.x for r in start.withColumn("x", hash_unit("id")).orderBy("id").collect()])
    for _ in range(3):
        x = (full / full.sum(axis=1, keepdims=True)) @ x
    pairs = spark.createDataFrame([(a, b, w) for (a, b), w in weights.items()], "src BIGINT, dst BIGINT, weight DOUBLE")
    got = [r.x for r in pic.embed(pairs, rounds=3, members=start).orderBy("id").collect()]
    assert got == pytest.approx(list(x / x.sum()))


def test_rounds_up_to_a_check_are_one_table(spark):
    """Twelve rounds on sets with copies: the values of all pairs of ids, without a table for every round."""
    import numpy as np

    from cohortloom.functions.columns import hash_unit
    from cohortloom.session import noted_paths

    members = [(i, 0) for i in range(3)] + [(3, 3), (4, 4)] + [(i, 5) for i in range(5, 7)] + [(7, 7)]
    weights = {(0, 3): 0.6, (3, 4): 0.3, (4, 7): 0.2}
    full = np.zeros((8, 8))
    for i, a in members:
        for j, b in members:
            if i != j:
                full[i, j] = 1.0 if a == b else weights.get((a, b), weights.get((b, a), 0.0))
    start = spark.createDataFrame(members, "id BIGINT, set_id BIGINT")
    x = np.array([r.x for r in start.withColumn("x", hash_unit("id")).orderBy("id").collect()])
    for _ in range(12):
        x = (full / full.sum(axis=1, keepdims=True)) @ x
    pairs = spark.createDataFrame([(a, b, w) for (a, b), w in weights.items()], "src BIGINT, dst BIGINT, weight DOUBLE")
    with noted_paths() as paths:
        got = [r.x for r in pic.embed(pairs, rounds=12, tolerance=0.0, members=start).orderBy("id").collect()]
    assert got == pytest.approx(list(x / x.sum()))
    assert len(paths) < 12


@pytest.mark.parametrize("common", [[], [0, 1, 2], list(range(12))])
@pytest.mark.parametrize("rows", [(3, 4), (128, 2048)])
def test_sums_of_blocks_match_brute_force(common, rows):
    import numpy as np

    rng = random.Random(4)
    sets = [sorted(rng.sample(range(12), rng.randrange(0, 9))) for _ in range(17)]
    x = np.array([rng.random() for _ in sets])
    flat = lambda some: (np.array([len(s) for s in some], dtype=np.int32), np.array([i for s in some for i in s], dtype=np.int32))
    weight = lambda a, b: w if (w := len({*a} & {*b}) / max(1, len({*a} | {*b}))) >= 0.4 else 0.0
    want = np.array([sum(weight(a, b) * x[j] for j, b in enumerate(sets) if i != j) for i, a in enumerate(sets)])
    often = np.array(common, dtype=np.int64)
    one, two = similarity.similar_sums(flat(sets), flat(sets), x, x, often, 0.4, True, rows)
    assert one + two == pytest.approx(want)
    one, two = similarity.similar_sums(flat(sets[:7]), flat(sets[7:]), x[:7], x[7:], often, 0.4, False, rows)
    assert one == pytest.approx([sum(weight(a, b) * x[7 + j] for j, b in enumerate(sets[7:])) for a in sets[:7]])
    assert two == pytest.approx([sum(weight(a, b) * x[j] for j, a in enumerate(sets[:7])) for b in sets[7:]])


@pytest.mark.parametrize("most_items", [20, 4_000_000])
def test_sets_compared_anew_embed_as_their_pairs(spark, most_items):
    """Copies, a patient similar to none, a null one: the same values with the pairs' table and without it."""
    rng = random.Random(9)
    pools = ["abcdef", "defghi", "klmn"]
    people = {i: {"x", *rng.sample(pools[i % 3], rng.randrange(1, 4))} for i in range(25)} | {25: {"alone"}, 26: {"alone2"}, 27: {"alone2"}, None: {"a", "x"}}
    items = spark.createDataFrame([(p, i) for p, s in people.items() for i in s], "patient_id BIGINT, item STRING")
    sets, members = similarity.distinct_sets(items)
    members = members.select(F.col("patient_id").alias("id"), "set_id")
    pairs = similarity.similar_sets(sets, 0.3).select(F.col("s1").alias("src"), F.col("s2").alias("dst"), F.col("similarity").alias("weight"))
    want = {r.id: r.x for r in pic.embed(pairs, rounds=12, tolerance=0.0, members=members).collect()}
    got = {r.id: r.x for r in pic.embed_sets(sets, members, 0.3, rounds=12, tolerance=0.0, most_items=most_items).collect()}
    assert 25 not in want and 26 in want and got.keys() == want.keys()
    assert [got[i] for i in want] == pytest.approx([want[i] for i in want])


def test_clusters_of_patients_keep_no_pairs(spark, tmp_path):
    """All of 80 patients share a lab: no table that the query leaves is near their 3,160 pairs."""
    from cohortloom.plans import QUERIES
    from cohortloom.session import noted_paths

    write = lambda name, rows, kind: spark.createDataFrame(rows, kind).write.parquet(f"{tmp_path}/{name}.parquet")
    write("part", [(k, f"med {k % 9}", "Brand#1", "LARGE") for k in range(90)], "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING")
    write("orders", [(k, k, datetime(1995, 1, 1)) for k in range(80)], "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP")
    lines = [(k, (k * 7 + i * 11) % 90, 1.0) for k in range(80) for i in range(1 + k % 4)]
    write("lineitem", lines, "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE")
    with noted_paths() as paths:
        found = QUERIES["pic_patients"](spark, str(tmp_path)).collect()
    assert sorted(r.id for r in found) == list(range(80))
    tables = [p for p in paths if os.path.isdir(p.removeprefix("file:"))]
    assert tables and max(spark.read.parquet(p).count() for p in tables) < 1000


def test_walk_keeps_its_edges_in_blocks(spark):
    """Ids that are no vertex, a double edge, a vertex without edges and one that comes twice; a hundred rounds are few jobs' tables."""
    from cohortloom.session import noted_paths

    edges = [(0, 1), (0, 1), (0, 2), (1, 0), (2, 3), (1, 99), (88, 0)]
    nodes = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 4)], "vid BIGINT")
    frame = spark.createDataFrame(edges, "src BIGINT, dst BIGINT")
    with noted_paths() as paths:
        got = {r.vid: r.probability for r in walk.restart_walk(nodes, frame, 0, rounds=100, rows_per_block=2).collect()}
    out = {0: [1, 1, 2], 1: [0, 99], 2: [3], 3: [0], 4: [0]}
    p = {v: float(v == 0) for v in out}
    for _ in range(100):
        q = {v: 0.15 * (v == 0) for v in out}
        for v, to in out.items():
            for d in to:
                if d in q:
                    q[d] += 0.85 * p[v] / len(to)
        p = q
    assert got == pytest.approx(p)
    assert len(paths) < 20
    assert {r.probability for r in walk.restart_walk(nodes, frame, 77, rounds=3).collect()} == {0.0}
