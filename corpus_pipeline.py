"""From raw documents to token ids, in five stages that each write Parquet.

Every stage takes all rows that the one before has kept. Quality drops documents of low
quality, near duplicates leave one document of each group, secrets are masked in the text,
mixing repeats or leaves out documents until sources have their target weights, and the
texts that result are encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanebeacon.llm import bpe, jaccard, mixing, quality, secrets
from lanebeacon.llm.common import stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches one half."""
    ranking = quality.learn_quality(docs, table(spark, sf_dir, "labels"))
    row = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), docs["text"])
    return quality.score_quality(row, ranking).where("score >= 0.5").select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones: five-word shingles, similarity 0.8."""
    return jaccard.keep_one(docs, jaccard.Similarity(5, 80, 100))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked, and their new lengths."""
    row = docs.select(F.struct(*[docs[name] for name in docs.columns]).alias("row"), docs["text"])
    found = secrets.secret_spans(row)
    masked = found.select("row", F.size("secrets").alias("n"), secrets.masked(F.col("text"), F.col("secrets")).alias("masked"))
    n_chars = F.when(F.col("n") > 0, F.length("masked").cast("bigint")).otherwise(F.col("row.n_chars"))
    changed = {"text": F.col("masked"), "n_chars": n_chars}
    return masked.select(*[changed.get(name, F.col(f"row.{name}")).alias(name) for name in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources come to their target weights."""
    return mixing.take_copies(docs, mixing.mix_sources(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the bytes they decode to."""
    path, pattern = bpe.production()
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), path, pattern)
    return coded.select("doc_id", "source", "coded.n_tokens", "coded.ids", "coded.ids_sha256", "coded.decoded_sha256")


STAGES = [
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix),
    ("encode", encode),
]

# No SQL can express the ranking or the merges; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
