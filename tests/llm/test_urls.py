"""URL rules against plain Python; the trees by held-out accuracy."""

import random

from pyspark.sql import functions as F

from cohortloom.llm import urls
from cohortloom.llm.plans import QUERIES, URL_RULES
from tests.llm import edges


def plain(url):
    """(host, path, rule, verdict of the rule)."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]
    best = None
    for rule, verdict in URL_RULES:
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(start) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return (host, path, *(best or (None, None)))


def test_rules_on_edges_and_tables(spark, tmp_path):
    for folder in (edges.write(tmp_path), "/root/testdata/sf0.01"):
        pages = spark.read.parquet(f"{folder}/pages.parquet")
        want = sorted((str(r["page_id"]), *map(str, plain(r["url"])[:3])) for r in pages.collect())
        rows = QUERIES["op9_url_filter"](spark, folder).collect()
        assert sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in rows) == want
        assert {r["verdict"] for r in rows} <= {"allow", "block"}
        verdicts = dict(URL_RULES)
        assert all(r["verdict"] == verdicts[r["rule"]] for r in rows if r["rule"])


def test_trees_on_held_out_urls(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        bad = rng.random() < 0.5
        tail = "".join(rng.choices("0123456789", k=20)) + "?a=1&b=2&c=3" if bad else "/".join(rng.choices(["about", "news", "team"], k=3))
        rows.append((i, f"http://{rng.choice('abc')}.example.net/{tail}", "block" if bad else "allow", 1.0))
    df = spark.createDataFrame(rows, "id INT, url STRING, verdict STRING, length DOUBLE")
    trees = urls.Filter(df.filter("id < 400"), rounds=5)
    got = trees.probabilities(df.filter("id >= 400"), "url", "share")
    assert got.columns == [*df.columns, "share"]
    right = got.filter((F.col("share") > 0.5) == (F.col("verdict") == "block")).count()
    assert right >= 190


def test_one_class_and_none(spark):
    df = spark.createDataFrame([("http://a/", "block"), (None, "allow")], "url STRING, verdict STRING")
    assert urls.Filter(df).probabilities(df, "url", "p").agg(F.min("p")).collect()[0][0] == 1.0
    assert urls.Filter(df.filter("false")).probabilities(df, "url", "p").agg(F.max("p")).collect()[0][0] == 0.0


def test_shares_of_endings_cover_all_labelled_rows(spark):
    """Also where the trees see a few of them, and where one URL holds a third of the rows."""
    rows = [(f"http://h{i}.net/{k}", "block" if i % 2 else "allow") for i in range(100) for k in range(4)]
    rows += [("http://hot.org/", "block")] * 200
    trees = urls.Filter(spark.createDataFrame(rows, "url STRING, verdict STRING"), rounds=1, depth=1, sample=50)
    prior = 400 / 600
    assert abs(trees.prior - prior) < 1e-12
    bucket = urls.ending(urls.host_of(F.col("url")))
    found = spark.createDataFrame(rows, "url STRING, verdict STRING").groupBy(bucket.alias("ending_bucket")).agg(
        F.sum((F.col("verdict") == "block").cast("double")).alias("blocked"), F.count("*").alias("n")
    )
    want = {r["ending_bucket"]: (r["blocked"] + 10 * prior) / (r["n"] + 10) for r in found.collect()}
    got = {r["ending_bucket"]: r["ending"] for r in trees.endings.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
