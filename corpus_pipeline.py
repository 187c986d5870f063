"""A corpus from raw documents to token ids, in five stages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm import contamination, jaccard, language, pieces, secret_scan
from leafmill.llm.common import saved, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that language identification rejects."""
    model = language.fit_on_documents(docs)
    return model.predict(docs).where("not rejected").select(*[F.col(f"`{c}`") for c in docs.columns])


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingle similarity links, the one with the smallest id."""
    return jaccard.one_of_each(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return contamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret; n_chars follows the text."""
    return secret_scan.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit) and decoded text of each document."""
    return pieces.encode(docs).select(
        "doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", remove_near_duplicates),
    ("benchmark", remove_benchmark),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

#: Similarity joins, taggers and tokenizers have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs)
    return docs
