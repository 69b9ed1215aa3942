"""The registered queries of this subpackage, each the thin digest of its operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import (
    decontaminate,
    language,
    licenses,
    mixing,
    quality,
    runs,
    simhash,
    substrings,
    tokencount,
    tokenfile,
    urls,
    warc,
    whitening,
)
from cohortloom.llm.text import words
from cohortloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` is the DuckDB text it must agree with, where one exists."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark, texts=True), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def public_tokenizer(name: str) -> str:
    """Path of an installed vocabulary file; every machine has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; documents of fold 1 of 3 are never learned from.

    A tenth of the other documents sets the calibration. A null doc_id is neither held out nor learned from.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = F.crc32(F.col("doc_id").cast("string"))
    model = language.fit(docs.filter(fold % 3 != 1), calibration=F.floor(fold / 3) % 10 == 0)
    return language.identify(docs, model).select(
        "doc_id",
        F.coalesce(fold % 3 == 1, F.lit(False)).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
        F.col("language.rejected").alias("rejected"),
        F.col("language.bits").alias("bits"),
    )


@query("op6_simhash")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(
    "op7_decontaminate",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[k:k + least(13, len(w)) - 1], ' ') AS s
            FROM i, unnest(range(1, len(w) - least(13, len(w)) + 2)) t(k) WHERE len(w) > 0),
    occ AS (SELECT r, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
            FROM d, (SELECT DISTINCT n FROM win), unnest(range(1, len(w) - n + 2)) t(k)),
    hit AS (SELECT r, k, win.n, item_id FROM occ JOIN win ON occ.s = win.s AND occ.n = win.n),
    places AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(k, k + n)) t(p) GROUP BY r),
    items AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    found = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_words"), n_hit).alias("contaminated"),
    )


@query(
    "op2_mixing",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(md5(text), 'null') AS mark,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM d GROUP BY source),
    c AS (SELECT *, [3, 1, 2][(k - 1) % 3 + 1] AS weight, 2 * source_size AS cap FROM s),
    o AS (SELECT *, row_number() OVER (ORDER BY cap / weight, k) AS o FROM c),
    l AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s)::DOUBLE - coalesce((SELECT sum(cap) FROM o b WHERE b.o < a.o), 0)::DOUBLE)
                     / (SELECT sum(weight) FROM o b WHERE b.o >= a.o)::DOUBLE AS level FROM o a),
    t AS (SELECT k, source, source_size, least(cap::DOUBLE, (SELECT max(level) FROM l b WHERE b.level * b.weight <= b.cap) * weight) AS target FROM l),
    e AS (SELECT *, round(target)::BIGINT AS take, (round(target)::BIGINT + 2047) // 2048 AS blocks FROM t),
    f AS (SELECT *, sum(blocks) OVER (ORDER BY k)::BIGINT AS stop FROM e),
    n AS (SELECT max(stop) AS m FROM f),
    g AS (SELECT max(x) AS g FROM n, range((SELECT greatest(0, m * 2654435769 // 4294967296 - 500) FROM n), (SELECT m * 2654435769 // 4294967296 + 1 FROM n)) u(x)
          WHERE gcd(x, m) = 1),
    p AS (SELECT i AS turn, ((i::HUGEINT * g) % m)::BIGINT AS spot FROM n, g, range((SELECT m FROM n)) x(i)),
    w AS (SELECT k, turn, row_number() OVER (PARTITION BY k ORDER BY turn) - 1 AS rank FROM p JOIN f ON spot >= stop - blocks AND spot < stop),
    b AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY md5('mix:' || coalesce(doc_id::VARCHAR, 'null') || ':' || mark), size, r
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin FROM d),
    z AS (SELECT r, k, begin + epoch * source_size AS begin, least(begin + epoch * source_size + size, take) AS till
          FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source, (VALUES (0), (1)) v(epoch)),
    x AS (SELECT r, k, begin, till, unnest(range(begin // 2048, (till - 1) // 2048 + 1)) AS rank FROM z WHERE begin < till),
    y AS (SELECT r, min(turn) AS first_turn, sum(least(till, 2048 * (rank + 1)) - greatest(begin, 2048 * rank))::BIGINT AS taken
          FROM x JOIN w USING (k, rank) GROUP BY r)
    SELECT doc_id, size, e.source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_turn::BIGINT AS first_turn
    FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source LEFT JOIN y USING (r)
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    docs = mixing.sized(table(spark, sf_dir, "documents"))
    return mixing.taken(docs, weights=[3, 1, 2]).select("doc_id", "size", "source_size", "target", "taken", "first_turn")


@query("op5_token_file")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written in order and read back."""
    return tokenfile.round_trip(table(spark, sf_dir, "documents"), public_tokenizer("word_bpe_49k.json"))


@query("op1_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document."""
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr"
    )


@query("op10_token_count")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents")
    counted = docs.select(
        "doc_id",
        F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
        tokencount.token_count(F.col("text"), public_tokenizer("byte_bpe_50k.json")).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


#: Rules of the URL query, host and start of the path.
URL_RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


@query("op9_url_filter")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page; the trees learn from the URLs that the rules decide."""
    judged = urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "judged.host", "judged.path", "judged.rule", "judged.verdict", "judged.block_share")


@query(
    "op3_warc",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
    d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS digest, min(page_id) OVER (PARTITION BY h) AS first FROM p),
    r AS (SELECT *, CASE WHEN n >= 100 AND page_id IS DISTINCT FROM first THEN first END AS refers_to FROM d)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
           refers_to, true AS verified
    FROM r
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as WARC archives, written and read back."""
    back = warc.round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


_TEMPLATES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(licenses.TEMPLATES))


@query(
    "op8_license",
    rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    t AS (SELECT k, name, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM (VALUES {_TEMPLATES}) v(k, name, text)),
    ts AS (SELECT DISTINCT k, name, array_to_string(w[p:p + 4], ' ') AS s FROM t, unnest(range(1, len(w) - 3)) u(p)),
    n AS (SELECT k, count(*) AS n FROM ts GROUP BY k),
    m AS (SELECT r, ts.k, name, n, p, s FROM (SELECT r, p, array_to_string(w[p:p + 4], ' ') AS s FROM d, unnest(range(1, len(w) - 3)) u(p))
          JOIN ts USING (s) JOIN n USING (k)),
    c AS (SELECT a.r, a.name, count(DISTINCT b.s) / a.n::DOUBLE AS share, count(DISTINCT b.s) >= ceil(0.8 * a.n) AS hit
          FROM m a JOIN m b ON a.r = b.r AND a.k = b.k AND b.p >= a.p AND b.p < a.p + a.n GROUP BY a.r, a.k, a.name, a.n, a.p),
    h AS (SELECT r, count(DISTINCT name) AS n_licenses, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, max(share) AS best FROM c WHERE hit GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses, coalesce(best, 0) AS best
    FROM d LEFT JOIN h USING (r)
    """,
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences that every document states."""
    found = licenses.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["license"])))
    best = F.coalesce(F.array_max(F.transform("hits", lambda h: h["containment"])), F.lit(0.0))
    return found.select(
        "doc_id", "n_words", F.size(names).cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"), best.alias("best")
    )


def with_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by crc32 of the id, goes on from a word with a period.

    From word a on, word i becomes word a + (i - a) % p of the same text. Other texts, and all with a null id, stay.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words("text")).alias("w"))
    n = F.when(F.size("w") > 0, F.size("w"))
    cut = cut.withColumn("a", (F.col("g") % n).cast("int"))
    cut = cut.withColumn("p", (F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8))).cast("int"))
    repeated = F.transform("w", lambda x, i: F.when(i < F.col("a"), x).otherwise(F.get("w", F.col("a") + (i - F.col("a")) % F.col("p"))))
    return cut.select("doc_id", F.coalesce(F.array_join(repeated, " "), "text").alias("text"))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document."""
    found = runs.find(with_period(table(spark, sf_dir, "documents").select("doc_id", "text")))
    best = found.withColumn("best", runs.strongest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op12_substring_dedup",
    r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    win AS (SELECT r, doc_id, k, md5(array_to_string(w[k:k + 49], ' ')) AS s FROM d, unnest(range(1, len(w) - 48)) t(k) WHERE doc_id IS NOT NULL),
    own AS (SELECT s, min(doc_id) AS least FROM win GROUP BY s HAVING min(doc_id) < max(doc_id)),
    places AS (SELECT r, list(DISTINCT p) AS gone FROM win JOIN own USING (s), unnest(range(k, k + 50)) t(p) WHERE least < doc_id GROUP BY r),
    kept AS (SELECT r, string_agg(w[p], ' ' ORDER BY p) AS text, count(*) AS n
             FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS p, coalesce(gone, []) AS gone FROM d LEFT JOIN places USING (r))
             WHERE NOT list_contains(gone, p) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
    FROM d LEFT JOIN kept USING (r)
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a document with a smaller id."""
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["length"])
    return found.select("doc_id", "n_words", n_removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leading 32 whitened components of every embedding."""
    white, model, error = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    long = white.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return long.select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("k")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
