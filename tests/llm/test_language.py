"""Kneser-Ney models against a plain version, and held-out accuracy."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import language
from cohortloom.llm.plans import QUERIES

TEXTS = {"xx": ["banana bandana", "an ananas!", "BAN the 3 bananas"], "yy": ["lorem ipsum", "dolor  sit", "ipsum lorem dolor é"]}


def normal(text):
    out = []
    for c in text:
        if c.isalpha():
            out.append(c.lower())
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out)


def plain_counts(texts):
    counts = Counter()
    for t in map(normal, texts):
        padded = "   " + t
        counts.update(padded[i : i + 4] for i in range(len(t)))
    return counts


class Plain:
    """The same estimate with dictionaries of strings."""

    def __init__(self, counts, alphabet):
        self.alphabet, self.orders = alphabet, {4: counts}
        for k in (3, 2, 1):
            self.orders[k] = Counter(g[1:] for g in self.orders[k + 1])

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / self.alphabet
        counts = self.orders[k]
        n1, n2 = sum(n == 1 for n in counts.values()), sum(n == 2 for n in counts.values())
        d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        same = [n for g, n in counts.items() if g[:-1] == gram[:-1]]
        if not same:
            return self.p(gram[1:])
        return max(counts.get(gram, 0) - d, 0) / sum(same) + d * len(same) / sum(same) * self.p(gram[1:])


def packed(gram):
    key = 0
    for c in gram:
        key = key << 16 | ord(c)
    return key


def test_ngrams_and_probabilities_equal_the_plain_version():
    counts = {name: plain_counts(texts) for name, texts in TEXTS.items()}
    for name, texts in TEXTS.items():
        keys, n = np.unique(language.ngrams(texts)[0], return_counts=True)
        assert dict(zip(keys.tolist(), n.tolist())) == {packed(g): c for g, c in counts[name].items()}
    per_lang = []
    for name in sorted(TEXTS):
        keys = np.array(sorted(packed(g) for g in counts[name]), np.uint64)
        per_lang.append((keys, np.array([{packed(g): c for g, c in counts[name].items()}[int(k)] for k in keys], float)))
    model = language.kneser_ney(sorted(TEXTS), per_lang)
    alphabet = len({g[-1] for c in counts.values() for g in c}) + 1
    plain = [Plain(counts[name], alphabet) for name in sorted(TEXTS)]
    grams = ["nana", "bana", "   b", " ips", "zzzz", "anaz", "zana", "qan ", "m ip", "   é"]
    got = model.log2_probabilities(np.array([packed(g) for g in grams], np.uint64))
    want = [[math.log2(p.p(g)) for p in plain] for g in grams]
    assert got == pytest.approx(np.array(want), abs=1e-4)
    bits, letters = model.entropies(["Banana", "", "12 !", "x"])
    text = "   banana"
    assert bits[0, 0] == pytest.approx(-sum(math.log2(plain[0].p(text[i : i + 4])) for i in range(6)) / 6, abs=1e-4)
    assert letters.tolist() == [6, 0, 0, 1] and bits[1].tolist() == [0, 0]


def test_counts_do_not_depend_on_partitions_or_flushes(spark):
    rows = [(t, name) for name, texts in TEXTS.items() for t in texts] + [(None, "xx"), ("lost", None), ("", "yy")]
    df = spark.createDataFrame(rows, "text STRING, lang STRING")
    want = {(name, packed(g)): n for name, texts in TEXTS.items() for g, n in plain_counts(texts).items()}
    for parts, flush in ((1, 10), (5, 1_000_000)):
        got = language.count_ngrams(df.repartition(parts), "text", "lang", flush).collect()
        assert {(r["lang"], r["key"] % (1 << 64)): r["n"] for r in got} == want


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.avg(F.col("rejected").cast("double")), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.98 and right[1] <= 0.01 and 0 <= right[2] <= right[3] <= 1


def test_nothing_learned_and_nothing_to_read(spark):
    df = spark.createDataFrame([(1, "text", None, 0.5), (2, None, None, 0.5)], "id INT, text STRING, lang STRING, found DOUBLE")
    model = language.fit(df)
    rows = language.identify(df, model).collect()
    assert all(r["language"]["lang"] == "und" and r["language"]["rejected"] and r["found"] == 0.5 for r in rows)
    taught = language.fit(spark.createDataFrame([("some text", "en")], "text STRING, lang STRING"))
    got = {r["id"]: r["language"] for r in language.identify(df, taught).collect()}
    assert got[1]["lang"] == "en" and got[2]["lang"] == "und" and got[2]["score"] == 0


def test_the_estimate_by_spark_equals_the_one_in_memory(spark):
    rows = [(t, name) for name, texts in TEXTS.items() for t in texts]
    model = language.fit(spark.createDataFrame(rows, "text STRING, lang STRING"))
    per_lang = []
    for name in sorted(TEXTS):
        keys, n = np.unique(language.ngrams(TEXTS[name])[0], return_counts=True)
        per_lang.append((keys, n.astype(float)))
    want = language.kneser_ney(sorted(TEXTS), per_lang)
    for mine, other in ((model.keys, want.keys), (model.contexts, want.contexts)):
        assert [x.tolist() for x in mine] == [x.tolist() for x in other]
    for mine, other in ((model.logp, want.logp), (model.backoff, want.backoff)):
        assert all(x == pytest.approx(y, abs=1e-5) for x, y in zip(mine, other, strict=True))
    assert model.floor == pytest.approx(want.floor)


def test_a_rare_language_beside_a_hot_one(spark, monkeypatch):
    """No n-gram gives way, whatever the number: the bound that there was is set far below the counts."""
    monkeypatch.setattr(language, "MAX_ENTRIES", 2000, raising=False)
    rng = random.Random(6)
    hot = ["".join(rng.choices("abcdefghij ", k=3000)) for _ in range(40)]
    rare = "klmnop qrstuv wxyz klqrwx mnstyz"
    df = spark.createDataFrame([(t, "hot") for t in hot] + [(rare, "rare")], "text STRING, lang STRING")
    model = language.fit(df)
    assert len(model.keys[3]) == len(np.unique(language.ngrams([*hot, rare])[0]))
    got = language.identify(spark.createDataFrame([("qrstuv klmnop wxyz",), (hot[0],)], "text STRING"), model).collect()
    assert [r["language"]["lang"] for r in got] == ["rare", "hot"]


def test_marks_alone_are_no_letters(spark):
    """Combining marks stay in the n-grams, but a text without a letter is `und`."""
    assert language.ngrams(["\u0301\u0301", "123 \u0651", "e\u0301", "\U0001e944", "\U00020000"])[2].tolist() == [0, 0, 1, 0, 1]
    rows = spark.createDataFrame([("der die das und ist nicht ein", "de"), ("the of and to in is that", "en")], "text STRING, lang STRING")
    found = language.identify(spark.createDataFrame([("\u0301\u0301",), ("123 \u0651",), ("the of",)], "text STRING"), language.fit(rows))
    assert [(r["language"]["lang"], r["language"]["score"] > 0, r["language"]["rejected"]) for r in found.collect()] == [("und", False, True), ("und", False, True), ("en", True, False)]


def test_predictions_equal_the_plain_version(spark):
    """Language and score of every text from plain models: least entropy, shares under the model's sharpness."""
    texts = {"de": ["Der Hund und die Katze", "nicht ein Haus, das ist es"], "en": ["the dog and the cat", "that is not a house"], "fr": ["le chien et le chat", "ce n'est pas une maison"]}
    rows = spark.createDataFrame([(t, x) for x, ts in texts.items() for t in ts], "text STRING, lang STRING")
    model = language.fit(rows)
    counts = {x: plain_counts(ts) for x, ts in texts.items()}
    alphabet = {g[-1] for c in counts.values() for g in c} | {"unseen"}
    plain = {x: Plain(c, len(alphabet)) for x, c in counts.items()}
    asked = ["the house", "das Haus", "la maison", "zzz", "x", "A dog; un chien"]
    found = language.identify(spark.createDataFrame(list(enumerate(asked)), "i INT, text STRING"), model).orderBy("i").collect()
    for text, row in zip(asked, found, strict=True):
        grams = [g for g, n in plain_counts([text]).items() for _ in range(n)]
        bits = {x: -sum(math.log2(plain[x].p(g)) for g in grams) / len(grams) for x in plain}
        best = min(bits, key=lambda x: (bits[x], x))
        letters = sum(c.isalpha() for c in text)
        share = 1 / sum(math.exp(-model.beta * math.sqrt(letters) * (b - bits[best])) for b in bits.values())
        assert row["language"]["lang"] == best and row["language"]["letters"] == letters
        assert row["language"]["score"] == pytest.approx(share, abs=1e-3) and row["language"]["bits"] == pytest.approx(bits[best], abs=1e-3)
