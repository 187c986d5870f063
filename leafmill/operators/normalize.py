"""Bring chunk rows from any source to the fixed chunk schema."""

from pyspark.sql import DataFrame, functions as F, types as T

from leafmill import schema
from leafmill.functions import text as X
from leafmill.operators.ordinals import with_ordinal

# What a missing or null field becomes.
DEFAULTS = {
    "chunk_text": "",
    "document_name": "unknown",
    "page_number": 1,
    "section_title": "Unknown",
}


def flatten_chunks(df: DataFrame) -> DataFrame:
    """Rows of ``chunks`` (array of structs) or ``chunk`` (struct) become plain columns.

    A row with no chunks yields nothing.
    """
    if "chunks" in df.columns and isinstance(df.schema["chunks"].dataType, T.ArrayType):
        df = df.select(F.explode("chunks").alias("chunk"))
    if "chunk" in df.columns and isinstance(df.schema["chunk"].dataType, T.StructType):
        df = df.select("chunk.*")
    return df


def with_defaults(df: DataFrame) -> DataFrame:
    for name, value in DEFAULTS.items():
        given = F.col(name) if name in df.columns else F.lit(None)
        kind = schema.CHUNKS[name].dataType
        df = df.withColumn(name, F.coalesce(given.cast(kind), F.lit(value)))
    return df


def with_chunk_index(df: DataFrame, slices: int | None = None) -> DataFrame:
    """Fill a missing ``chunk_index`` with the row's place in its document, by page and text."""
    numbered = with_ordinal(
        df, ["page_number", "chunk_text"], ["document_name"], "_place", slices)
    given = F.col("chunk_index") if "chunk_index" in df.columns else F.lit(None)
    return numbered.withColumn(
        "chunk_index", F.coalesce(given.cast("int"), F.col("_place").cast("int"))).drop("_place")


def with_chunk_id(df: DataFrame) -> DataFrame:
    """Fill a missing or empty ``chunk_id`` with the hash of name, page, index and text."""
    given = F.col("chunk_id") if "chunk_id" in df.columns else F.lit(None)
    given = given.cast("string")
    hashed = X.content_id(*map(F.col, (
        "document_name", "page_number", "chunk_index", "chunk_text")))
    return df.withColumn(
        "chunk_id", F.when(F.coalesce(given, F.lit("")) == "", hashed).otherwise(given))


def normalize_chunks(df: DataFrame, number_missing: bool = True) -> DataFrame:
    """Flatten, fill defaults, index and id, and project onto ``schema.CHUNKS``.

    ``number_missing=False`` spares the ordering pass where every row has its index already.
    """
    df = with_defaults(flatten_chunks(df))
    if number_missing:
        df = with_chunk_index(df)
    return schema.conform(with_chunk_id(df), schema.CHUNKS)
