"""Chunk statistics and run counters."""

from pyspark.sql import DataFrame, Observation, functions as F


def chunk_statistics(chunks: DataFrame, by: list[str] = (), text: str = "chunk_text") -> DataFrame:
    """Count, average, shortest, longest and total length; zeros over no rows."""
    length = F.char_length(text)
    zero = F.lit(0)
    measures = [
        F.count("*").alias("total_chunks"),
        F.coalesce(F.avg(length), F.lit(0.0)).alias("avg_length"),
        F.coalesce(F.min(length), zero).cast("bigint").alias("min_length"),
        F.coalesce(F.max(length), zero).cast("bigint").alias("max_length"),
        F.coalesce(F.sum(length), zero).cast("bigint").alias("total_characters"),
    ]
    return chunks.groupBy(*by).agg(*measures)


def counted(df: DataFrame, name: str, **conditions) -> tuple[DataFrame, Observation]:
    """Count rows, and those meeting each condition, while another action runs over ``df``."""
    seen = Observation(name)
    measures = [F.count(F.lit(1)).alias("rows")]
    measures += [F.count_if(condition).alias(label) for label, condition in conditions.items()]
    return df.observe(seen, *measures), seen


def entity_rows(df: DataFrame, key: str = "chunk_id") -> DataFrame:
    """The long form of the entity map: one row per value.

    The outer explode keeps Spark from inferring a filter that would tag the text once more.
    """
    kinds = df.select(key, F.explode_outer("entities").alias("entity_type", "values"))
    return kinds.select(
        key, "entity_type", F.posexplode_outer("values").alias("pos", "value")
    ).filter(F.col("value").isNotNull())
