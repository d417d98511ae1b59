"""From raw documents to token ids: each stage works on all rows that the one before kept.

Every function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. run() writes each result as Parquet to the shared folder and reads it again, so
a lost executor costs a stage at most."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortflow.llm import decontaminate, pieces, secret_scan, simhash, toxicity
from cohortflow.llm.queries import SECRET_RULES, TOKENIZERS
from cohortflow.llm.tables import labelled, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; learned from the labels outside the held-out fold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~labelled("doc_id", 4, 2))
    return toxicity.without_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash neighbours: the one with the smallest id."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by their kind."""
    return secret_scan.without_secrets(docs, SECRET_RULES)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces and round_trip of every document."""
    return pieces.encode_texts(docs, pieces.read_vocabulary(f"{TOKENIZERS}/piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scan", redact_secrets),
    ("sentencepiece", encode),
]

#: The learned grammar, the latent search and the Viterbi encoder have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
