"""A corpus from raw documents to token files, as stages that each call one operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetboard.llm import decontaminate, mixing, quality, simhash, tokens
from fleetboard.llm.common import cut, importable
from fleetboard.llm.queries import TOKENIZER, labelled_domains

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.3 or more."""
    return quality.keep_good(docs, _table(spark, sf_dir, "labels"), threshold=0.3)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of fingerprints linked at 3 bits or fewer the document of smallest id."""
    importable(spark)
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of 10 words with the benchmark."""
    return decontaminate.clean(docs, _table(spark, sf_dir, "benchmark"), window=10)


def mix_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once or more, the rarer languages more often (shares to the power 0.7)."""
    labelled = labelled_domains(docs, _table(spark, sf_dir, "labels"))
    return mixing.mix(docs, labelled, temperature=0.7, at_least=1.0)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards and their index; per document what they give back."""
    importable(spark)
    return tokens.round_trip(docs, TOKENIZER)


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("near_copies", keep_one_of_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_languages),
    ("tokens", write_tokens),
]

#: Trees, hashes and token ids have no SQL; the tests hold run() against its stages' own checks.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each gives is written before the next one reads it."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
