"""Patient-item graph as a vertex table and an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.ordered import dense_index
from cohortloom.session import cut


def latest_events(events: DataFrame) -> DataFrame:
    """(patient_id, kind, item, date, value): the latest record per patient and item.

    Ties on the date go to the larger value, so the choice does not depend on row order. The largest (date, value) is
    combined before the one shuffle; records without a date count only where there are no others, and give no value.
    """
    last = events.groupBy("patient_id", "kind", "item").agg(F.max(F.struct("date", "value")).alias("last"))
    return last.select("patient_id", "kind", "item", "last.date", F.when(F.col("last.date").isNotNull(), F.col("last.value")).alias("value"))


def vertices(patients: DataFrame, events: DataFrame) -> DataFrame:
    """(vid, kind, key): one dense numbering over patients and all item kinds."""
    people = patients.select(F.lit("patient").alias("kind"), F.col("patient_id").cast("string").alias("key"))
    things = events.select("kind", F.col("item").alias("key"))
    return dense_index(people.unionByName(things).distinct(), ["kind", "key"], "vid").select("vid", "kind", "key")


def build(patients: DataFrame, events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) with edges (src, dst, kind, date, value) in both directions.

    Events are reduced to one row per patient and item first; that table is written once and gives
    both the item vertices and the edges.
    """
    latest = cut(latest_events(events))
    nodes = vertices(patients, latest)
    people = nodes.filter(F.col("kind") == "patient").select(
        F.col("vid").alias("src"), F.col("key").cast("bigint").alias("patient_id")
    )
    things = nodes.filter(F.col("kind") != "patient").select(F.col("vid").alias("dst"), "kind", F.col("key").alias("item"))
    # The items first: the second shuffle then carries a number in place of the item's name.
    joined = latest.join(things, ["kind", "item"]).select("patient_id", "dst", "kind", "date", "value").join(people, "patient_id")
    # Both directions from one row, so that the joins run once.
    ways = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return nodes, joined.select("kind", "date", "value", F.inline(ways)).select("src", "dst", "kind", "date", "value")


def reverse(edges: DataFrame) -> DataFrame:
    """The same edges with source and target exchanged."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), *rest)


def neighbors(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(vid, neighbor), one row per distinct neighbour; a vertex without any has one NULL row.

    Long form: the neighbour list of a hub item would be as large as the population.
    """
    pairs = edges.select(F.col("src").alias("vid"), F.col("dst").alias("neighbor")).distinct()
    return nodes.select("vid").join(pairs, "vid", "left")


def out_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(vid, degree, edge_weight) with edge_weight = 1 / degree, NULL where there is no edge."""
    counted = edges.groupBy(F.col("src").alias("vid")).agg(F.count("*").alias("n"))
    return nodes.select("vid").join(counted, "vid", "left").select(
        "vid", F.coalesce("n", F.lit(0)).alias("degree"), (F.lit(1.0) / F.col("n")).alias("edge_weight")
    )
