"""From raw documents to sampled subword pieces: five stages, each over all rows its predecessor kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each result to the shared folder and
reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.llm import mixing, near_dedup, pii, piece_sampling, quality_rules
from pelagia.llm.common import materialize, table
from pelagia.llm.queries import PIECE_MODEL, PII_KEY


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and whose host does."""
    return quality_rules.keep(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that is of five-word shingle sets alike to 0.8 or more."""
    return near_dedup.keep(docs, percent=80)


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms; n_chars follows the text."""
    out = pii.pseudonymize(docs, PII_KEY).drop("pii")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.sample(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two segmentations of every text, with what they decode to."""
    encoded = piece_sampling.encode(docs.select("doc_id", "text"), PIECE_MODEL, k=2, with_text=True)
    return encoded.select("doc_id", "sample", "ids", "log_prob", "log_inclusion", F.xxhash64("text").alias("decoded_hash"))


STAGES = [("quality rules", quality), ("near dedup", dedup), ("pii", pseudonyms), ("mixing", mix), ("piece sampling", pieces)]

#: Balanced sampling and lattice draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
