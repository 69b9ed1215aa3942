"""Language identification by interpolated Kneser-Ney character models.

Every language has a character model of order four. Counting is a Spark aggregation over all
training texts, and the estimate a few joins over all counts. It is stored as sorted arrays in
files that the executors map: a mixed 64-bit hash of each n-gram seen in any language, and beside it
one log probability per language, already interpolated. A text gets the language with the lowest
cross-entropy per character; two calibrated rules turn that into a score and a rejection.

Texts are reduced to lower-case letters, with one space for any run of other characters. An n-gram
is the letter with the three characters before it, spaces before the start, 16 bits each; letters
outside the basic plane count as one letter, U+FFFD.
"""

from __future__ import annotations

import dataclasses
import os
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.text import decoded, free
from cohortloom.session import cut, drop_cut

ORDER = 4
SPACE = 32
#: Bytes of text handled at once inside a task.
CHUNK = 150_000
#: Odd constant of the multiplicative hash; a bijection on 64 bits, so equal hashes are equal n-grams.
MIX = np.uint64(0x9E3779B97F4A7C15)
_MASK = [np.uint64((1 << 16 * k) - 1) for k in range(ORDER)] + [np.uint64(0xFFFFFFFFFFFFFFFF)]
_LETTERS: list[np.ndarray] = []
_ALPHABETIC: list[np.ndarray] = []
#: Stands for every mark beyond 16 bits, as U+FFFD does for every letter there.
_MARK = 0xFFFC


def _letters() -> np.ndarray:
    """Code point -> lower-case letter of 16 bits, or SPACE; built once per worker."""
    if not _LETTERS:
        table = np.full(0x110000, SPACE, dtype=np.uint16)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 and ord(low) < 0x10000 else (cp if cp < 0x10000 else 0xFFFD)
            elif unicodedata.category(c) in ("Mn", "Mc"):
                table[cp] = cp if cp < 0x10000 else _MARK  # marks belong to the letter before them
        _LETTERS.append(table)
    return _LETTERS[0]


def _alphabetic() -> np.ndarray:
    """Folded character of 16 bits -> whether it is a letter, and no mark or space; built once per worker."""
    if not _ALPHABETIC:
        table = np.array([chr(cp).isalpha() for cp in range(0x10000)])
        table[0xFFFD] = True
        _ALPHABETIC.append(table)
    return _ALPHABETIC[0]


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, sizes, letters): the packed n-grams of all texts in a row, their number and the number of letters of each."""
    raw = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype="<u4")
    chars = _letters()[raw]
    owner = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    space = chars == SPACE
    first = np.ones(len(chars), dtype=bool)
    first[1:] = owner[1:] != owner[:-1]
    keep = ~(space & np.concatenate(([True], space[:-1])) | space & first)
    chars, owner = chars[keep], owner[keep]
    sizes = np.bincount(owner, minlength=len(texts))
    letters = np.bincount(owner[_alphabetic()[chars]], minlength=len(texts))
    padded = np.full(len(chars) + (ORDER - 1) * len(texts), SPACE, dtype=np.uint64)
    at = np.arange(len(chars)) + (ORDER - 1) * (owner + 1)
    padded[at] = chars
    keys = np.zeros(len(chars), dtype=np.uint64)
    for back in range(ORDER - 1, -1, -1):
        keys = (keys << np.uint64(16)) | padded[at - back]
    return keys, sizes, letters


def count_ngrams(rows: DataFrame, text: str, lang: str, flush: int = 300_000) -> DataFrame:
    """(lang, key, n): n-gram counts of every language over all rows; combined per task, then summed by Spark.

    A task holds at most about `flush` counts and hands them on when it has more.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[int, int]] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), dtype=object)
            for name in sorted(set(langs)):
                mine = held.setdefault(name, {})
                for texts in decoded(batch.column(0).filter(pa.array(langs == name)), CHUNK):
                    keys, n = np.unique(ngrams(texts)[0], return_counts=True)
                    for key, k in zip(keys.view(np.int64).tolist(), n.tolist(), strict=True):
                        mine[key] = mine.get(key, 0) + k
            if sum(map(len, held.values())) > flush:
                yield from out(held)
                held = {}
        yield from out(held)

    def out(held: dict[str, dict[int, int]]) -> Iterator[pa.RecordBatch]:
        for name, mine in held.items():
            keys, n = pa.array(mine.keys(), pa.int64()), pa.array(mine.values(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(mine), pa.string()), keys, n], ["lang", "key", "n"])

    known = rows.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    return known.mapInArrow(count, "lang STRING, key BIGINT, n BIGINT").groupBy("lang", "key").agg(F.sum("n").alias("n"))


@dataclasses.dataclass
class Model:
    """`keys[k]`: sorted hashes of the n-grams of order k + 1; `logp[k]`: their log2 probabilities by language.

    `contexts[k]`, `backoff[k]`: likewise for the contexts of that order and the log2 of the mass
    they hand to the shorter context. `floor`: log2 of the uniform probability below the shortest order.
    `files`: the name under which Spark gives every executor the arrays, if they are in files; the
    model then travels without them and maps them where it arrives.
    """

    langs: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    backoff: list[np.ndarray]
    floor: np.ndarray
    beta: float = 1.0
    cutoff: np.ndarray = dataclasses.field(default_factory=lambda: np.zeros(0))
    files: str = ""

    def __getstate__(self) -> dict:
        mapped = ("keys", "logp", "contexts", "backoff") if self.files else ()
        return {k: v for k, v in self.__dict__.items() if k not in mapped}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        if self.files:
            self.keys, self.logp, self.contexts, self.backoff = _mapped(self.files, len(self.langs))

    def log2_probabilities(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """(len(keys), languages) for distinct n-grams of `order`; unseen ones by the shorter context."""
        if order == 0:
            return np.broadcast_to(self.floor, (len(keys), len(self.langs)))
        at, found = _find(self.keys[order - 1], keys)
        out = np.empty((len(keys), len(self.langs)), dtype=np.float32)
        out[found] = self.logp[order - 1][at[found]]
        if not found.all():
            rest = keys[~found]
            shorter, back = np.unique(rest & _MASK[order - 1], return_inverse=True)
            lower = self.log2_probabilities(shorter, order - 1)[back]
            c_at, c_found = _find(self.contexts[order - 1], rest >> np.uint64(16))
            lower = lower + np.where(c_found[:, None], self.backoff[order - 1][c_at], np.float32(0)) if len(self.contexts[order - 1]) else lower
            out[~found] = lower
        return out

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per character of each text under each language, number of letters)."""
        keys, sizes, letters = ngrams(texts)
        bits = np.zeros((len(texts), len(self.langs)))
        if len(keys):
            distinct, at = np.unique(keys, return_inverse=True)
            table = -self.log2_probabilities(distinct)
            full = np.flatnonzero(sizes)
            starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))[full]
            for lang in range(len(self.langs)):
                bits[full, lang] = np.add.reduceat(table[at, lang].astype(np.float64), starts) / sizes[full]
        return bits, letters


def _hashed(keys: np.ndarray) -> np.ndarray:
    return keys * MIX


def _find(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the sorted hash array and whether the key is there."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    hashed = _hashed(keys)
    at = np.minimum(np.searchsorted(table, hashed), len(table) - 1)
    return at, table[at] == hashed


def _mapped(name: str, langs: int) -> list[list[np.ndarray]]:
    """keys, logp, contexts and backoff of a model, mapped from the files that Spark has brought here."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    for part in range(2 * ORDER):
        first = 0 if part < ORDER else 2
        for at, (kind, dtype, width) in enumerate((("keys", np.uint64, 0), ("values", np.float32, langs))):
            path = SparkFiles.get(f"{name}-{part}-{kind}")
            flat = np.memmap(path, dtype, "r") if os.path.getsize(path) else np.zeros(0, dtype)
            out[first + at].append(flat.reshape(-1, width) if width else flat)
    return out


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the sum of their values, how often each occurs."""
    distinct, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    return distinct, np.bincount(at, weights=values, minlength=len(distinct)), n


def kneser_ney(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Model:
    """Interpolated Kneser-Ney from the highest-order counts (keys, n) of every language, in memory; see `estimate`.

    Shorter n-grams count the different characters found before them. One discount per order and
    language, n1 / (n1 + 2 n2); the shortest order is interpolated with the uniform distribution.
    """
    by_order: list[list[tuple[np.ndarray, np.ndarray]]] = [counts]
    for k in range(ORDER - 1, 0, -1):
        shorter = [np.unique(keys & _MASK[k], return_counts=True) for keys, _ in by_order[0]]
        by_order.insert(0, shorter)
    union = [np.unique(np.concatenate([k for k, _ in of] or [np.zeros(0, np.uint64)])) for of in by_order]
    alphabet = len(union[0]) + 1
    floor = np.full(len(langs), 1.0 / alphabet)
    table: list[np.ndarray] = []
    contexts: list[np.ndarray] = []
    backoff: list[np.ndarray] = []
    for k in range(1, ORDER + 1):
        grams = union[k - 1]
        p = np.empty((len(grams), len(langs)))
        seen = np.unique(grams >> np.uint64(16))
        bow = np.ones((len(seen), len(langs)))
        suffix = np.searchsorted(union[k - 2], grams & _MASK[k - 1]) if k > 1 else None
        for at, (keys, n) in enumerate(by_order[k - 1]):
            n1, n2 = int((n == 1).sum()), int((n == 2).sum())
            discount = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
            ctx, total, types = _summed(keys >> np.uint64(16), n)
            bow[np.searchsorted(seen, ctx), at] = discount * types / total
            mine = np.zeros(len(grams))
            mine[np.searchsorted(grams, keys)] = np.maximum(n - discount, 0) / total[np.searchsorted(ctx, keys >> np.uint64(16))]
            lower = table[-1][suffix, at] if k > 1 else np.full(len(grams), 1.0 / alphabet)
            p[:, at] = mine + bow[np.searchsorted(seen, grams >> np.uint64(16)), at] * lower
        table.append(p)
        contexts.append(seen)
        backoff.append(bow)

    def stored(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashed = _hashed(keys)
        order = np.argsort(hashed)
        return hashed[order], np.log2(values[order]).astype(np.float32)

    logp = [stored(*x) for x in zip(union, table, strict=True)]
    bows = [stored(*x) for x in zip(contexts, backoff, strict=True)]
    return Model(
        langs, [x for x, _ in logp], [y for _, y in logp], [x for x, _ in bows], [y for _, y in bows],
        np.log2(floor).astype(np.float32),
    )


def _values(name: str, langs: list[str]) -> list[str]:
    return [f"{name}{i}" for i in range(len(langs))]


def estimate(counts: DataFrame, langs: list[str]) -> Model:
    """The model of `kneser_ney` from (lang, key, n) of any number, by Spark; the arrays go to files.

    A row holds an n-gram with one value per language. The driver sees the discounts and, one after
    the other, the packed pieces of the sorted result.
    """
    n, t, y, p, m = (_values(x, langs) for x in "ntypm")
    wide = {ORDER: cut(counts.groupBy("key").agg(*[F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)).alias(c) for x, c in zip(langs, n, strict=True)]))}
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("key").bitwiseAND(F.lit(int(_MASK[k])))
        wide[k] = cut(wide[k + 1].groupBy(shorter.alias("key")).agg(*[F.sum((F.col(c) > 0).cast("long")).alias(c) for c in n]))
    floor = 1.0 / (wide[1].count() + 1)
    lower = None
    tables, done = [], list(wide.values())
    for k in range(1, ORDER + 1):
        ones = wide[k].agg(*[F.sum((F.col(c) == v).cast("long")) for v in (1, 2) for c in n]).first()
        discount = [a / (a + 2 * b) if a and b else 0.5 for a, b in zip(ones[: len(n)], ones[len(n) :], strict=True)]
        ctx = F.shiftrightunsigned("key", 16)
        totals = wide[k].groupBy(ctx.alias("ctx")).agg(
            *[F.sum(c).alias(x) for c, x in zip(n, t, strict=True)], *[F.sum((F.col(c) > 0).cast("long")).alias(x) for c, x in zip(n, y, strict=True)]
        )
        left = [F.when(F.col(a) > 0, d * F.col(b) / F.col(a)).otherwise(1.0) for a, b, d in zip(t, y, discount, strict=True)]
        rows = wide[k].withColumn("ctx", ctx).join(totals if k > 1 else F.broadcast(totals), "ctx")  # one row of no letters
        if k > 1:
            rows = rows.withColumn("suffix", F.col("key").bitwiseAND(F.lit(int(_MASK[k - 1])))).join(
                lower.select(F.col("key").alias("suffix"), *[F.col(a).alias(b) for a, b in zip(p, m, strict=True)]), "suffix"
            )
        known = [F.when(F.col(a) > 0, F.greatest(F.col(c) - d, F.lit(0.0)) / F.col(a)).otherwise(0.0) for a, c, d in zip(t, n, discount, strict=True)]
        below = [F.col(c) if k > 1 else F.lit(floor) for c in m]
        lower = cut(rows.select("key", *[(a + b * c).alias(x) for a, b, c, x in zip(known, left, below, p, strict=True)]))
        done.append(lower)
        logs = lambda cols: F.array(*[F.log2(c).cast("float") for c in cols]).alias("logs")
        tables.append(lower.select(F.lit(k - 1).alias("part"), "key", logs(map(F.col, p))))
        tables.append(totals.select(F.lit(ORDER + k - 1).alias("part"), F.col("ctx").alias("key"), logs(left)))
    whole = tables[0]
    for one in tables[1:]:
        whole = whole.unionByName(one)
    name = _to_files(whole)
    for one in done:
        drop_cut(one)
    arrays = _mapped(name, len(langs))
    return Model(langs, *arrays, np.full(len(langs), np.log2(floor), np.float32), files=name)


def _to_files(rows: DataFrame) -> str:
    """Give (part, key, logs) to all executors as two files a part, by hash of the key; their common name."""
    sign = np.uint64(1 << 63)  # Spark sorts signed numbers

    @F.arrow_udf("long")
    def place(keys: pa.Array) -> pa.Array:
        return pa.array((_hashed(keys.to_numpy(zero_copy_only=False).view(np.uint64)) ^ sign).view(np.int64))

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0).to_numpy(zero_copy_only=False)
            hashed = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64) ^ sign
            starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
            for a, b in zip(starts, starts[1:]):
                logs = batch.column(2).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part[a]], pa.int32()), pa.array([hashed[a:b].tobytes()]), pa.array([logs.tobytes()])], ["part", "keys", "values"]
                )

    spark = rows.sparkSession
    placed = rows.select("part", place("key").alias("place"), "logs").orderBy("part", "place")
    name = f"characters-{uuid.uuid4().hex[:12]}"
    folder = tempfile.mkdtemp(dir=SparkFiles.getRootDirectory())  # goes with the session
    paths = {(part, kind): os.path.join(folder, f"{name}-{part}-{kind}") for part in range(2 * ORDER) for kind in ("keys", "values")}
    for path in paths.values():
        open(path, "wb").close()
    for row in placed.mapInArrow(pack, "part INT, keys BINARY, values BINARY").toLocalIterator():
        for kind in ("keys", "values"):
            with open(paths[row["part"], kind], "ab") as out:
                out.write(row[kind])
    for path in paths.values():
        spark.sparkContext.addFile(path)
    return name


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", calibration: Column | None = None) -> Model:
    """Train on the rows with a text and a language; rows where `calibration` holds set the two rules instead.

    The model holds every n-gram of those rows, however many. No rows give a model of no language,
    under which every text is `und`.
    """
    held = F.coalesce(calibration, F.lit(False)) if calibration is not None else F.lit(False)
    counts = cut(count_ngrams(rows.filter(~held), text, lang))
    langs = sorted(r[0] for r in counts.select("lang").distinct().collect())  # one row per language
    model = estimate(counts, langs) if langs else kneser_ney([], [])
    drop_cut(counts)
    model.cutoff = np.full(len(langs), np.inf)
    return calibrated(rows.filter(held), text, lang, model) if calibration is not None and langs else model


#: Candidate values for the sharpness of the score.
BETAS = [0.05, 0.1, 0.2, 0.4, 0.8, 1.6, 3.2]


def calibrated(rows: DataFrame, text: str, lang: str, model: Model) -> Model:
    """Set `beta` by the least log loss and `cutoff` by the 99.9 % quantile of entropies in the known language.

    The fewer texts the quantile rests on, the wider the cutoff: 8 / sqrt(texts) is added, and a
    language without any has none.
    """
    bits = entropies(rows.sparkSession, F.col(text), model)
    index = F.array_position(F.array(*[F.lit(x) for x in model.langs]), F.col("lang")).cast("int")
    known = rows.select(F.col(lang).alias("lang"), bits.alias("found")).filter(F.col("found.letters") > 0)
    known = known.withColumn("at", index).filter(F.col("at") > 0).select("lang", "found.letters", "found.bits", F.element_at("found.bits", F.col("at")).alias("own"))
    losses = [
        F.avg(F.log(F.aggregate("bits", F.lit(0.0), lambda a, h: a + F.exp(F.lit(-b) * F.sqrt("letters") * (h - F.array_min("bits"))))) + F.lit(b) * F.sqrt("letters") * (F.col("own") - F.array_min("bits"))).alias(f"b{i}")
        for i, b in enumerate(BETAS)
    ]
    loss = known.agg(*losses).collect()[0]
    ranked = sorted((loss[f"b{i}"], b) for i, b in enumerate(BETAS) if loss[f"b{i}"] is not None)
    limit = F.percentile_approx("own", 0.999) + 8 / F.sqrt(F.count("*"))
    high = {r[0]: r[1] for r in known.groupBy("lang").agg(limit).collect()}  # one row per language
    return dataclasses.replace(
        model, beta=ranked[0][1] if ranked else 1.0, cutoff=np.array([high.get(x, np.inf) for x in model.langs])
    )


def entropies(spark: SparkSession, text: Column, model: Model) -> Column:
    """struct<letters, bits>: bits per character under every language of the model."""
    shared = spark.sparkContext.broadcast(model)  # without the arrays, which are in files

    @F.arrow_udf("struct<letters: long, bits: array<double>>")
    def measured(column: pa.Array) -> pa.Array:
        out, n = [], []
        for texts in decoded(column, CHUNK):
            bits, letters = shared.value.entropies(texts)
            out += bits.tolist()
            n += letters.tolist()
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(out, pa.list_(pa.float64()))], ["letters", "bits"])

    return measured(text)


def identify(docs: DataFrame, model: Model, text: str = "text", name: str = "language", slack: float = 1.5) -> DataFrame:
    """`docs` with a struct column `name` of lang, score, bits, letters and rejected.

    lang: the language with the lowest cross-entropy (`und`: null, or no letter; equal ones: the
    first by name). score: its share under exp(-beta sqrt(letters) bits), 0 for `und`. rejected:
    `und`, or bits above the language's calibrated cutoff by more than `slack` plus 4 / sqrt(letters).
    Very short texts so have wide bounds; other columns of any name stay as they are.
    """
    if not model.langs:
        nothing = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"), F.lit(None).cast("double").alias("bits"), F.lit(0).cast("long").alias("letters"), F.lit(True).alias("rejected"))
        return docs.withColumn(name, nothing)
    found, at = free(docs, "found"), free(docs, "at")
    with_bits = docs.withColumn(found, entropies(docs.sparkSession, F.col(text), model))
    bits, letters = F.col(f"{found}.bits"), F.col(f"{found}.letters")
    best = with_bits.withColumn(at, F.array_position(bits, F.array_min(bits)).cast("int"))
    root = F.sqrt(letters)
    mass = F.aggregate(bits, F.lit(0.0), lambda a, h: a + F.exp(F.lit(-model.beta) * root * (h - F.array_min(bits))))
    limit = F.element_at(F.array(*[F.lit(float(x)) for x in model.cutoff]), F.col(at)) + slack + 4 / root
    und = letters == 0
    result = F.struct(
        F.when(und, "und").otherwise(F.element_at(F.array(*[F.lit(x) for x in model.langs]), F.col(at))).alias("lang"),
        F.when(und, 0.0).otherwise(1 / mass).alias("score"),
        F.when(~und, F.array_min(bits)).alias("bits"),
        letters.alias("letters"),
        (und | (F.array_min(bits) > limit)).alias("rejected"),
    )
    return best.withColumn(name, result).drop(found, at)
