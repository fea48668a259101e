"""One registered query per operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import (
    bpe,
    chat,
    collocations,
    decontaminate,
    langid,
    line_dedup,
    near_dup,
    piece_bpe,
    prefix_trie,
    quality_pu,
    quality_rules,
    toxicity,
    urls,
)
from tillroll.llm.common import fold

VOCABULARY = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"
URL_RULES: urls.Rules = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = langid.fit(docs.where(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.fit(docs, labels))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.report(docs, items)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "text", "n_lines", "n_deleted")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    planted = spark.range(2).select(
        F.lit(-7).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.col("id").cast(rows.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        said.alias("text"),
    )
    done = chat.format_conversations(rows.union(planted))
    turns = chat.parse(F.col("formatted"))
    said_back = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.masked_text()
    return done.select(
        "conv_id",
        F.size(turns).cast("long").alias("n_turns"),
        F.sha2(said_back, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 3) == 1
    model = quality_pu.fit(docs.where(~held_out), labels.where(~held_out))
    return _predicted(quality_pu.predict(docs, model), held_out)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold(F.col("doc_id"), 5) == 0
    model = toxicity.fit(docs, labels.where(~held_out))
    return _predicted(toxicity.predict(docs, model), held_out)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def _predicted(scored: DataFrame, held_out) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id,
        op2_url_filter,
        op3_quality_rules,
        op4_decontaminate,
        op5_line_dedup,
        op6_chat_format,
        op7_quality_classifier,
        op8_near_duplicates,
        op9_bpe,
        op10_toxicity,
        op11_prefix_trie,
        op12_sentencepiece,
        op13_collocations,
    )
}
