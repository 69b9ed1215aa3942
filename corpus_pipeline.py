"""The pipeline over documents: language ID, near-duplicates, decontamination, mixing, token output.

Each stage takes what the stage before kept, as Parquet, and applies one operator of cohortloom.llm.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm import decontaminate, language, mixing, simhash, tokenfile
from cohortloom.llm.plans import public_tokenizer
from cohortloom.llm.text import free
from cohortloom.session import noted_paths, remove, tune, work_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Shared-folder tables of the stage before, by application; they go once their result has been written and read again.
_LEFT: dict[str, list[str]] = {}


def _stage(fn: Stage) -> Stage:
    """Before the stage, remove the tables that the stage before left, unless `docs` still reads one of them."""

    @functools.wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tune(spark, texts=True)
        app = spark.sparkContext.applicationId
        left = _LEFT.pop(app, [])
        read = docs.inputFiles() if left else []
        for path in left:
            name = path.rstrip("/").rpartition("/")[2]
            if not any(f"/{name}/" in f for f in read):
                remove(spark, path)
        with noted_paths() as paths:
            out = fn(spark, docs, sf_dir)
        _LEFT[app] = paths
        return out

    return run_stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the rejected ones go. `lang` stays as it is given."""
    fold = F.crc32(F.col("doc_id").cast("string"))
    model = language.fit(docs.filter(fold % 3 != 1), calibration=F.floor(fold / 3) % 10 == 0)
    name = free(docs, "language")
    found = language.identify(docs, model, name=name)
    return found.filter(~F.col(f"{name}.rejected")).drop(name)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return simhash.keep_one(docs)


@_stage
def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows cover less than one word in twenty."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: 150 % of all words by weights 3, 1, 2, nobody above twice."""
    return mixing.remix(docs, weights=[3, 1, 2])


@_stage
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the token files of what is left, repeats included."""
    return tokenfile.round_trip(docs, public_tokenizer("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
    ("tokens", write_tokens),
]

#: Character models, SimHash and the tokenizer have no SQL form; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written as Parquet to the shared folder and read again."""
    tune(spark, texts=True)
    docs, docs_path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = work_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if docs_path is not None:
            remove(spark, docs_path)
        docs_path = path
        docs = spark.read.parquet(path)
    return docs
