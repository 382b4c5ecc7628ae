"""Corpus preparation in stages: language, exact copies, near copies, benchmark passages, tokens.

Each stage takes all documents that the one before kept; its result is written as Parquet and read again.  All but
the last return the columns of ``documents``.

Null text has no language and goes at the first stage, as does a text without a letter.  Repeated rows are exact copies,
of which the second stage keeps one; rows that share an id but not the text are documents of their own, and so are
rows without an id.  Texts of any length are taken whole.  Columns of any name pass through all stages but the last.
An empty table of documents gives none; an empty benchmark removes none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vigil.llm import decontaminate, exact_dedup, langid, queries, sentencepiece_bpe, simhash
from vigil.llm.shared import fresh, shared_folder, ship

#: Documents whose language is less probable than this go, as do those without a letter.
MIN_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the classifier recognises."""
    ship(spark)
    model = langid.train(docs)
    guess = fresh("guess", docs.columns)
    marked = docs.withColumn(guess, langid.predicted(spark, model, F.col("text")))
    known = (F.col(f"{guess}.lang_pred") != langid.UNDETERMINED) & (F.col(f"{guess}.score") >= MIN_LANGUAGE_SCORE)
    return marked.where(known).drop(guess)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.without_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the documents, with digests of the ids and of the text decoded from them."""
    return sentencepiece_bpe.digests(docs, queries.vocabulary(queries.PIECE_BPE), with_ids=True)


STAGES = [
    ("language ID", language),
    ("exact dedup", exact_copies),
    ("SimHash near-dedup", near_copies),
    ("benchmark decontamination", benchmark_passages),
    ("SentencePiece encoding", tokens),
]

#: Stages use fingerprints, classifiers and tokenizers that SQL can't express; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = queries.table(ship(spark), sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        rows = stage(spark, docs, sf_dir)
        folder = shared_folder(spark, f"stage-{number}")
        rows.write.parquet(folder)
        docs = spark.read.schema(rows.schema).parquet(folder)
    return docs
