"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; each result is written as
Parquet and read again.

Defined cases: null and empty texts are kept and give no tokens; rows repeated with doc_id and text are one document
after the second stage, rows with one doc_id and different texts are judged each by its own text; of equal or near texts
the row that is first by (doc_id, hash of the text) stays; very long texts are whole in every stage; extra columns of
documents, also with the names of intermediate ones, pass through up to the last stage; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framespan.llm import bpe, decontamination, jaccard, secrets, toxicity
from framespan.llm._common import discard, read_table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose toxicity score reaches 0.5; learned as in the query, outside the held-out fold."""
    return toxicity.without_toxic(docs, toxicity.fit_from_tables(docs, read_table(spark, sf_dir, "labels")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of every group of similar ones (five words, 0.8)."""
    return jaccard.one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a passage of the benchmark."""
    return decontamination.without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents; secrets in their texts become a mark."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and number of tokens of what is left."""
    # smaller tables than the query's: an executor has the other stages' Python workers too
    encoded = bpe.encode(docs, *bpe.public_vocabulary(), "doc_id", "lang", "source", share=3)
    return encoded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", without_toxic),
    ("near duplicates", one_of_each_group),
    ("benchmark", without_benchmark),
    ("secrets", without_secrets),
    ("tokens", tokens),
]
#: a trained model and the tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  Of the tables between the stages only the one that they read stays."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        found = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return found
        found = written(found)
        if k:
            discard(docs)
        docs = found
    return docs
