"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and the raw corpus.

Words and word pairs fall into a fixed number of hash buckets. Two multinomials over the buckets,
one from the trusted documents and one from all, give each bucket the logarithm of their ratio; a
document's score is the mean over its n-grams, and documents below a threshold go. The
corpus' counts are an aggregation over all documents; the table of weights has one row per bucket,
whatever the corpus, and is broadcast to the scoring pass. A tenth of the trusted documents stays
out of the target and places the threshold, because texts the target has seen score higher than others
like them, and the more so the smaller the target is.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.text import words
from cohortloom.session import cut

#: Hash buckets of n-grams.
BUCKETS = 1 << 16
#: Trusted documents that the target is estimated from, at most: those with the smallest hashes of their ids.
TRUSTED = 100_000
#: Added to every bucket's count, in proportion to the corpus.
SMOOTHING = 1.0
#: The threshold lies by this much below the 0.2 % quantile of trusted documents that the target leaves out ...
MARGIN = 0.05
#: ... and here where there are none.
THRESHOLD = -0.35
WHITE = " \t\n\x0b\x0c\r"


def buckets(split: str, buckets: int = BUCKETS) -> Column:
    """array<int>: the bucket of each word in array column `split` and of each pair of neighbours."""
    pairs = F.greatest(F.size(split) - 1, F.lit(0))
    one = F.transform(split, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.zip_with(
        F.slice(split, F.lit(1), pairs), F.slice(split, F.lit(2), pairs),
        lambda v, w: F.pmod(F.xxhash64(v, w), F.lit(buckets)).cast("int"),
    )
    return F.concat(one, two)


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """(doc_id, held) of at most `most` documents with quality 1 and without a toxic mark, by the order of an id hash.

    held marks a tenth of them, by another hash.

    The threshold on the hash comes from their number, so no row passes through one task.
    """
    good = labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull())
    ids = good.select("doc_id").distinct().withColumn("draw", F.pmod(F.xxhash64("doc_id", F.lit("trust")), F.lit(1 << 20)))
    n = ids.count()
    part = (1 << 20) if n <= most else int((1 << 20) * (0.98 * most / n))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(10)) == 0
    return ids.filter(F.col("draw") < part).select("doc_id", held.alias("held"))


def weights(docs: DataFrame, trusted: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(bucket, weight): log of the target's share of a bucket over the corpus' share, for buckets that occur.

    The target is the documents of `trusted` that are not held, the corpus all of `docs`.
    """
    target = F.broadcast(trusted.filter(~F.col("held")).select("doc_id", F.lit(1).alias("trusted")))  # TRUSTED ids at most
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(target, "doc_id", "left")
    split = rows.select("trusted", words("text").alias("words"))
    grams = split.select("trusted", F.explode(buckets("words")).alias("bucket"))
    counts = cut(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.count("trusted").alias("target")))
    total = counts.agg(F.sum("raw"), F.sum("target")).collect()[0]
    raw, given = float(total[0] or 0), float(total[1] or 0)
    if not given:
        return counts.select("bucket", F.lit(0.0).alias("weight"))  # nothing is trusted: nothing is told apart
    prior = SMOOTHING * BUCKETS
    share = F.col("raw") / raw
    return counts.select("bucket", F.log((F.col("target") + prior * share) / (given + prior) / share).alias("weight"))


def repeated_words(rows: DataFrame, split: str, name: str, window: int = 3) -> DataFrame:
    """`rows` with `name`: words in runs of `window` words that stand twice or more in the text, the first one included.

    Runs are sorted by the high bits of a hash with their place in the low bits, as many as the text
    needs; neighbours with equal hash bits are compared word by word.
    """
    mask, runs = "_mask", "_runs"
    n = F.size(split)
    bits = F.ceil(F.log2(F.greatest(n, F.lit(2)))).cast("int")
    digest = lambda w, i: F.xxhash64(w, *[F.get(split, i + k) for k in range(1, window)])
    packed = F.transform(
        F.slice(split, F.lit(1), F.greatest(n - (window - 1), F.lit(0))),
        lambda w, i: digest(w, i).bitwiseAND(F.bitwise_not(F.col(mask))).bitwiseOR(i.cast("long")),
    )
    rows = rows.withColumn(mask, F.pow(F.lit(2.0), bits).cast("long") - 1)
    rows = rows.withColumn(runs, F.sort_array(packed))

    def place(x: Column) -> Column:
        return x.bitwiseAND(F.col(mask)).cast("int")

    def equal(x: Column, y: Column) -> Column:
        hashes = x.bitwiseAND(F.bitwise_not(F.col(mask))) == y.bitwiseAND(F.bitwise_not(F.col(mask)))
        for k in range(window):
            hashes = hashes & (F.get(split, place(x) + k) == F.get(split, place(y) + k))
        return F.coalesce(hashes, F.lit(False))

    twice = F.filter(runs, lambda x, i: equal(x, F.get(runs, i - 1)) | equal(x, F.get(runs, i + 1)))
    inside = F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(*[place(x) + k for k in range(window)]))))
    return rows.withColumn(name, F.size(inside).cast("long")).drop(mask, runs)


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    A null text has no words and fails; its llr, as that of any text without words, is null.
    Repeated rows are judged one by one. Without a trusted document every llr is 0. Other columns
    are not read.
    """
    trusted = cut(trusted_ids(labels))
    weight = F.broadcast(weights(docs, trusted, text, doc_id))  # BUCKETS rows at most
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(trusted), "doc_id", "left").withColumn("words", words("text"))  # TRUSTED ids at most
    rows = rows.select(
        "row",
        "doc_id",
        "held",
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        duplicate_lines(F.col("text")).alias("n_dup_lines"),
    )
    rows = repeated_words(rows, "words", "n_repeat_words")
    facts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = rows.select("row", "held", *facts, F.explode_outer(buckets("words")).alias("bucket"))
    # A document's n-grams are in one task, so this is one row per document before the shuffle.
    found = grams.join(weight, "bucket", "left").groupBy("row").agg(*[F.first(c).alias(c) for c in ["held", *facts]], F.avg("weight").alias("llr"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    found = cut(found.select(*facts, "held", failed.alias("base_failed"), "llr"))
    lowest = found.filter("held AND NOT base_failed").agg(F.percentile_approx("llr", 0.002)).collect()[0][0]  # one number
    threshold = THRESHOLD if lowest is None else lowest - MARGIN
    kept = ~F.col("base_failed") & F.coalesce(F.col("llr") >= threshold, F.lit(False))
    return found.select(*facts, "base_failed", "llr", kept.alias("kept"))
