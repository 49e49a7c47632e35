"""The registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetboard.llm import (
    arc, chat, decontaminate, merkle, mixing, phrases, quality, search, secrets, simhash, substrings, tokens, toxicity,
)
from fleetboard.llm.common import cut, importable
from fleetboard.llm.oracle import ORACLE as ORACLE

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=3)


def op2_arc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(_table(spark, sf_dir, "pages"), min_bytes=0)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op4_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edited_pairs(_table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.5)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(_table(spark, sf_dir, "documents"), window=50, digest_only=True).drop("spans")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_hits(docs, _table(spark, sf_dir, "benchmark"), drop_text=True)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def labelled_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled table of domains: the languages of the documents that have a label."""
    return labels.select(F.col("doc_id").alias("id")).distinct().join(
        docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("domain")), "id"
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found, _ = mixing.rates(docs, labelled_domains(docs, _table(spark, sf_dir, "labels")))
    each = found.withColumn("row", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
    return each.select(
        F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_words"),
        F.transform("posterior", lambda p: F.round(p, 6)).alias("posterior"), "rate", "copies",
    )


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.round_trip(_table(spark, sf_dir, "documents"), TOKENIZER)


def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], rows.schema)
    turns = chat.paths(chat.threads(rows.unionAll(own)))
    written = cut(chat.format_paths(turns), "chats")
    return chat.digests(written).drop("rank").withColumnRenamed("tree", "conv_id")


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folded = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    rows = docs.select(
        F.col("doc_id").alias("id"), F.col("lang").alias("grp"),
        merkle.leaf("doc_id", "source", "lang", "n_chars", "text").alias("leaf"),
        F.when(changed, merkle.leaf("doc_id", "source", "lang", "n_chars", folded)).alias("seen"),
    )
    return merkle.audit(merkle.build(rows)).drop("grp", "seen").withColumnRenamed("id", "doc_id")


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = [r.kind for r in secrets.BASE]

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}") for kind in base],
        F.sha2(joined(of_kinds(*base)), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_arc": op2_arc,
    "op3_quality": op3_quality,
    "op4_phrases": op4_phrases,
    "op5_toxicity": op5_toxicity,
    "op6_substrings": op6_substrings,
    "op7_decontaminate": op7_decontaminate,
    "op8_mixing": op8_mixing,
    "op9_tokens": op9_tokens,
    "op10_chat": op10_chat,
    "op11_search": op11_search,
    "op12_merkle": op12_merkle,
    "op13_secrets": op13_secrets,
}
