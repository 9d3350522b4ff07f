"""Queries over the whole tables, one for each operator, and SQL where it can express one."""

from __future__ import annotations

import os
import tempfile
import zipfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination, divergence, fingerprints, langid, near_duplicates, oracles, outliers, pages, passages,
    pieces, secret_scan, tokens, toxicity, vector_codes,
)
from .common import fold_of, table

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, which may not have it; once for each application."""
    context = spark.sparkContext
    if getattr(context, "_barwright_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="barwright-"), "barwright.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    context._barwright_shipped = True


def _documents(spark, sf_dir) -> DataFrame:
    ship(spark)
    return table(spark, sf_dir, "documents")


def op1_pieces(spark, sf_dir):
    return pieces.encoded(_documents(spark, sf_dir), public_tokenizers.path(PIECES))


def op2_near_duplicates(spark, sf_dir):
    return near_duplicates.near_duplicates(_documents(spark, sf_dir))


def op3_fingerprints(spark, sf_dir):
    return fingerprints.edited_fingerprints(_documents(spark, sf_dir))


def op4_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    lexicon = toxicity.learn(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    scored = toxicity.toxicity(docs, lexicon)
    return scored.select("doc_id", F.coalesce(fold_of(3) == 1, F.lit(True)).alias("held_out"), "score", "predicted")


def op5_main_text(spark, sf_dir):
    ship(spark)
    return pages.main_text(table(spark, sf_dir, "pages"))


def op6_token_counts(spark, sf_dir):
    return tokens.token_counts(_documents(spark, sf_dir), public_tokenizers.path(WORDS))


def op7_contaminations(spark, sf_dir):
    return decontamination.contaminations(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op8_languages(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    model = langid.train(docs.where(~langid.held_out()))
    return langid.identify(docs, model).withColumn("held_out", langid.held_out())


def op9_passages(spark, sf_dir):
    return passages.repeated_passages(_documents(spark, sf_dir))


def op10_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    forest = secret_scan.learn(docs, path="source")
    return secret_scan.findings(docs, forest, path="source")


def op11_outliers(spark, sf_dir):
    return outliers.outliers(table(spark, sf_dir, "documents"))


def op12_divergence(spark, sf_dir):
    return divergence.divergence(_documents(spark, sf_dir))


def op13_vector_codes(spark, sf_dir):
    ship(spark)
    return vector_codes.compressed(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_pieces, op2_near_duplicates, op3_fingerprints, op4_toxicity, op5_main_text, op6_token_counts,
    op7_contaminations, op8_languages, op9_passages, op10_secrets,
    op11_outliers, op12_divergence, op13_vector_codes)}

#: SQL of the operators that it can express; tests/llm checks the others against brute force.
ORACLE_SQL: dict[str, str] = {
    "op12_divergence": oracles.divergence_sql(),
    "op13_vector_codes": oracles.vector_codes_sql(),
}
