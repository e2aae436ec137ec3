"""A training corpus in five stages, each of which works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspan.llm import mixing, near_dedup, pieces, secret_scan, toxicity
from shelfspan.llm.ship import ship
from shelfspan.session import settle


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the fitted model doesn't call toxic; a text's score depends on the text alone."""
    ship(spark)
    model = toxicity.fit(docs, _labels(spark, sf_dir))
    return model.keep(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal or similar texts."""
    ship(spark)
    return near_dedup.keep_one(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced."""
    ship(spark)
    return secret_scan.redact(docs, secret_scan.fit(secret_scan.labelled_findings(spark)))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    return mixing.draw(docs, mixing.quality_weights(_labels(spark, sf_dir)))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and the decoded text of each document."""
    ship(spark)
    return pieces.encode(docs, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("source_mix", mix_sources),
    ("sentencepiece", to_pieces),
]
#: Trained models and sampled signatures have no SQL; tests hold each stage against its input: labels, all pairs, masked values, the library.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    kept = STAGES[-1][1](spark, docs, sf_dir)
    return kept.select(*[c for c in kept.columns if c not in ("ids", "decoded")], F.size("ids").alias("n_ids"))
