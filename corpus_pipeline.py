"""From raw documents to token ids: five stages, each over all documents the one before kept.

Every stage but the last returns the columns of `documents`. Nulls, empty tables, repeated rows
and further columns are handled as the operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.llm import decontamination, near_duplicates, pieces, secret_scan, toxicity
from barwright.llm.common import table
from barwright.llm.queries import PIECES, ship
from barwright.plans.durable import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; labels are learned from the training folds of `docs`."""
    ship(spark)
    lexicon = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.with_scores(docs, lexicon, score="_score")
    return scored.where(F.col("_score") < toxicity.THRESHOLD).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near-duplicates."""
    ship(spark)
    return near_duplicates.without_near_duplicates(docs).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark")).select(docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked; n_chars counts the text as it is then, where one was masked."""
    forest = secret_scan.learn(docs, path="source")
    masked = secret_scan.redacted(docs, forest, path="source", secrets="_secrets")
    n_chars = F.when(F.col("_secrets") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return masked.withColumn("n_chars", n_chars).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of the text and whether they decode to it."""
    ship(spark)
    coded = pieces.with_pieces(docs, public_tokenizers.path(PIECES), ids="ids", decoded="_decoded")
    return coded.select("doc_id", "lang", "source", "n_chars", F.size("ids").alias("n_pieces"), "ids",
                        (F.col("_decoded") == F.coalesce(F.col("text"), F.lit(""))).alias("lossless"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("pieces", encode),
]

#: Learned scores, signatures and pieces are not SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to `documents`; each stage's rows are written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
