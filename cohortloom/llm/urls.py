"""URL filters: allow and block rules, and gradient-boosted trees on lexical features for the rest.

A rule names a host with all its subdomains and the start of a path; the longest rule that fits
decides. URLs that no rule fits are judged by boosted trees learned from labelled URLs. The features
are lexical: lengths, depth, digit ratio, entropy, parameter counts, and the share of blocked URLs
among the labelled ones with the same host ending, for endings hashed into a fixed number of buckets.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import free
from cohortloom.session import cut

#: Distinct labelled URLs that the trees are fitted on, about at most: those with the smallest hashes, weighted by their rows.
SAMPLE = 20_000
#: Hash buckets of host endings.
ENDINGS = 4096
FEATURES = ["length", "host_length", "labels", "depth", "path_length", "digit_ratio", "entropy", "parameters", "signs", "secure", "fragment", "ending"]
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def decide(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest of `rules`, ("example.org/es/", "block"), that fits; null if none does.

    The rules are an argument, a few to a few hundred; of rules of one length the later in order wins.
    """
    found = []
    for rule, verdict in rules:
        name, slash, start = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + start))
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    nothing = F.lit(None).cast("struct<size: int, rule: string, verdict: string>")
    return F.greatest(nothing, nothing, *found)


def _entropy(text: Column) -> Column:
    """Bits per character of the distribution of a text's own characters; 0 for an empty one."""
    n = F.length(text)

    def part(c: Column) -> Column:
        share = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    distinct = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    return F.coalesce(F.aggregate(distinct, F.lit(0.0), lambda a, c: a + part(c)), F.lit(0.0))


def ending(host: Column) -> Column:
    """Bucket of the host's last two labels."""
    return F.pmod(F.xxhash64(F.substring_index(host, ".", -2)), F.lit(ENDINGS)).cast("int")


def features(urls: DataFrame, endings: DataFrame, url: str, prior: float) -> DataFrame:
    """`urls` with the columns of FEATURES added; `endings` is (ending_bucket, ending), at most ENDINGS rows."""
    u, host, path = F.coalesce(F.col(url), F.lit("")), host_of(F.col(url)), path_of(F.col(url))
    count = lambda what: F.regexp_count(u, F.lit(what)).cast("double")
    size = F.length(u).cast("double")
    out = urls.withColumns(
        {
            "length": size,
            "host_length": F.length(host).cast("double"),
            "labels": F.size(F.split(host, r"\.")).cast("double"),
            "depth": F.regexp_count(path, F.lit("/[^/]")).cast("double"),
            "path_length": F.length(path).cast("double"),
            "digit_ratio": count("[0-9]") / F.greatest(size, F.lit(1.0)),
            "entropy": _entropy(u),
            "parameters": count("[?&][^=&#]+="),
            "signs": count("[-_~%+.]"),
            "secure": F.startswith(u, F.lit("https:")).cast("double"),
            "fragment": F.contains(u, F.lit("#")).cast("double"),
            "ending_bucket": ending(host),
        }
    )
    return out.join(F.broadcast(endings), "ending_bucket", "left").withColumn("ending", F.coalesce("ending", F.lit(prior))).drop("ending_bucket")


class Filter:
    """Trees fitted on labelled URLs; without both classes the one there is, or `allow`, holds for all."""

    def __init__(self, labelled: DataFrame, url: str = "url", label: str = "verdict", rounds: int = 20, depth: int = 4, sample: int = SAMPLE):
        """`labelled` has a URL and `allow` or `block`; null URLs and other labels are left out."""
        rows = labelled.select(F.col(url).alias("url"), (F.col(label) == "block").cast("double").alias("label"))
        rows = rows.filter(F.col("url").isNotNull() & F.col("label").isNotNull())
        rows = cut(rows.groupBy("url", "label").agg(F.count("*").cast("double").alias("weight")))
        classes = {r["label"]: r["rows"] for r in rows.groupBy("label").agg(F.sum("weight").alias("rows")).collect()}  # two rows
        self.prior = classes.get(1.0, 0) / max(1, sum(classes.values()))
        self.model, self.only = None, "block" if set(classes) == {1.0} else "allow"
        # Over all labelled rows; the sample below is for the trees alone.
        shares = rows.groupBy(ending(host_of(F.col("url"))).alias("ending_bucket")).agg(
            ((F.sum(F.col("label") * F.col("weight")) + 10 * self.prior) / (F.sum("weight") + 10)).alias("ending")
        )
        self.endings = cut(shares)
        if len(classes) == 2:
            n = rows.count()
            draw = F.pmod(F.xxhash64("url", F.lit("sample")), F.lit(1 << 20))
            part = (1 << 20) if n <= sample else int((1 << 20) * sample / n)
            drawn = rows.filter(draw < part)
            table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(drawn, self.endings, "url", self.prior))
            fitted = cut(table.select("features", "label", "weight"))
            self.model = GBTClassifier(maxIter=rounds, maxDepth=depth, seed=7, checkpointInterval=-1, weightCol="weight").fit(fitted)

    def probabilities(self, urls: DataFrame, url: str, name: str) -> DataFrame:
        """`urls` with `name`, the probability of `block`."""
        if self.model is None:
            return urls.withColumn(name, F.lit(float(self.only == "block")))
        mine = urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("kept_row"), F.col(url).alias("kept_url"))
        table = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features(mine, self.endings, "kept_url", self.prior))
        scored = self.model.transform(table).select("kept_row", vector_to_array("probability")[1].alias("kept_share"))
        return scored.select("kept_row.*", F.col("kept_share").alias(name))


def judge(pages: DataFrame, rules: list[tuple[str, str]], trees: Filter | None = None, url: str = "url", name: str = "judged") -> DataFrame:
    """`pages` with a struct `name` of host, path, rule, verdict and block_share (the trees' probability).

    The trees are learned from the URLs that the rules decide, unless given. A null URL has an empty
    host and path, fits no rule and is judged by its features like an empty one. Columns of any name stay.
    """
    parsed, share = free(pages, "parsed"), free(pages, "share")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rows = pages.withColumn(parsed, F.struct(host.alias("host"), path.alias("path"), decide(host, path, rules).alias("found")))
    found = F.col(f"{parsed}.found")
    trees = trees or Filter(rows.select(F.col(url).alias("url"), found["verdict"].alias("verdict")).filter("verdict IS NOT NULL"))
    scored = trees.probabilities(rows, url, share)
    verdict = F.coalesce(found["verdict"], F.when(F.col(share) > 0.5, "block").otherwise("allow"))
    judged = F.struct(F.col(f"{parsed}.host").alias("host"), F.col(f"{parsed}.path").alias("path"), found["rule"].alias("rule"), verdict.alias("verdict"), F.col(share).alias("block_share"))
    return scored.withColumn(name, judged).drop(parsed, share)
