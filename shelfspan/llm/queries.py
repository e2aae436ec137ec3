"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspan.llm import conversations, divergence, fingerprints, language, licences, mixing, near_dedup, neighbours, pieces, quality, secret_scan, suffixes, toxicity
from shelfspan.llm.oracles import ORACLES
from shelfspan.llm.ship import ship

__all__ = ["ORACLES", "QUERIES"]


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.held_out_scores(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"), mixing.quality_weights(read(spark, folder, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.summary(read(spark, folder, "documents"), secret_scan.fit(secret_scan.labelled_findings(spark)))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encode(read(spark, folder, "documents"))


def op6_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    done = suffixes.remove_repeats(read(spark, folder, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.held_out_languages(read(spark, folder, "documents"))


def op8_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(read(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(read(spark, folder, "documents"))
    return found.select("doc_id", "n_sentences", *[F.array_join(c, ",").alias(c) for c in ("sentence_ids", "rule_ids", "licences")])


def op10_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.classes_of(read(spark, folder, "documents"))


def op11_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.digests(read(spark, folder, "documents"))


def op12_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(read(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations")
    return conversations.repair(conversations.damage(rows), rows.select("conv_id"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_source_mix, op3_secret_scan, op4_quality_rules, op5_sentencepiece, op6_suffix_dedup, op7_language_id,
        op8_neighbours, op9_licence_scan, op10_near_dedup, op11_fingerprints, op12_source_divergence, op13_conversation_repair,
    )
}
