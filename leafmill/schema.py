"""Schemas shared by every stage."""

from pyspark.sql import DataFrame, functions as F, types as T

ELEMENTS = T.StructType([
    T.StructField("document_name", T.StringType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("label", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
])

CHUNKS = T.StructType([
    T.StructField("chunk_id", T.StringType()),
    T.StructField("chunk_text", T.StringType()),
    T.StructField("chunk_embedding", T.ArrayType(T.FloatType())),
    T.StructField("document_name", T.StringType()),
    T.StructField("page_number", T.IntegerType()),
    T.StructField("section_title", T.StringType()),
    T.StructField("chunk_index", T.IntegerType()),
    T.StructField("entities", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
    T.StructField("entity_count", T.IntegerType()),
    T.StructField("word_count", T.IntegerType()),
    T.StructField("char_count", T.IntegerType()),
    T.StructField("has_table", T.BooleanType()),
    T.StructField("has_image", T.BooleanType()),
    T.StructField("has_code", T.BooleanType()),
    T.StructField("element_types", T.ArrayType(T.StringType())),
    T.StructField("processed_at", T.TimestampType()),
])

MANIFEST = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("document_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_chunks", T.IntegerType()),
    T.StructField("run_ts", T.TimestampType()),
])

RUN_LOG = T.StructType([
    T.StructField("run_ts", T.TimestampType()),
    T.StructField("label", T.StringType()),
    T.StructField("line_no", T.IntegerType()),
    T.StructField("line", T.StringType()),
])


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: same names, order and types; absent columns become null."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])
