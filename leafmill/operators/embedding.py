"""Texts to vectors: a built-in hashing embedder and a hook for a user's provider."""

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leafmill.functions import text as X
from leafmill.functions import vectors as V

VECTOR = T.ArrayType(T.FloatType())


def _once(function):
    """Keep Spark from evaluating the function again wherever a filter uses its result."""
    return function.asNondeterministic()


def token_buckets(text: Column, dimension: int) -> Column:
    """Bucket of each token: the leading 32 bits of its MD5, modulo ``dimension``.

    A text without tokens counts as one token, so that no vector is zero.
    """
    found = X.tokens(text)
    found = F.when(F.size(found) > 0, found).otherwise(F.array(text))
    return F.transform(
        found,
        lambda t: (F.conv(F.substring(F.md5(t.cast("binary")), 1, 8), 16, 10).cast("bigint")
                   % dimension).cast("int"),
    )


def hashing_embedding(text: Column, dimension: int = 64) -> Column:
    """Unit vector of token counts per hash bucket. Hashing runs in the JVM; the counts of a
    whole batch are one ``bincount``."""

    @F.arrow_udf(VECTOR)
    def count(buckets: pa.Array) -> pa.Array:
        lengths = np.diff(buckets.offsets.to_numpy())
        rows = np.repeat(np.arange(len(buckets)), lengths)
        cells = rows * dimension + buckets.flatten().to_numpy(zero_copy_only=False)
        counts = np.bincount(cells, minlength=len(buckets) * dimension)
        counts = counts.reshape(len(buckets), dimension).astype(np.float64)
        norms = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
        unit = (counts / np.maximum(norms, 1e-300)).astype(np.float32)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(buckets) + 1, dtype=np.int32) * dimension),
            pa.array(unit.ravel()),
        )

    return _once(count)(token_buckets(F.coalesce(text, F.lit("")), dimension))


def _process_providers() -> dict[str, Callable]:
    """Providers of this worker process, kept where every task of the process finds them.

    Functions travel to workers by value, so a variable of this module would be new in each task.
    """
    name = "_leafmill_providers"
    return vars(sys.modules.setdefault(name, types.ModuleType(name)))


def provider_embedding(
    text: Column,
    key: str,
    build: Callable[[], Callable[[list[str]], list[list[float]]]],
    batch_size: int = 10,
) -> Column:
    """Vectors from ``build()(texts)``, called with up to ``batch_size`` texts in row order.

    The provider is built once per worker process and ``key``, which must name its whole
    configuration. Its errors fail the job, and so does a wrong number of vectors.
    """

    @F.pandas_udf(VECTOR)
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        providers = _process_providers()
        if key not in providers:
            providers[key] = build()
        provider = providers[key]
        for texts in batches:
            texts, vectors = texts.tolist(), []
            for at in range(0, len(texts), batch_size):
                batch = texts[at:at + batch_size]
                found = provider(batch)
                if len(found) != len(batch):
                    raise ValueError(f"{len(batch)} texts gave {len(found)} vectors")
                vectors.extend(found)
            yield pd.Series(vectors, dtype=object)

    return _once(embed)(text)


def embed_chunks(
    chunks: DataFrame, embedding: Callable[[Column], Column] = hashing_embedding
) -> DataFrame:
    return chunks.withColumn("chunk_embedding", embedding(F.col("chunk_text")))


def embed_queries(
    queries: DataFrame, embedding: Callable[[Column], Column] = hashing_embedding
) -> DataFrame:
    return queries.withColumn("query_vector", embedding(F.col("query_text")))


def valid_vector(dimension: int, vector: str = "chunk_embedding") -> Column:
    return V.has_dimension(F.col(vector), dimension) & V.is_nonzero(F.col(vector))


def require_vectors(chunks: DataFrame, dimension: int) -> DataFrame:
    """Fail the job, naming the chunk, on a missing, zero or wrongly sized vector."""
    broken = F.raise_error(F.concat(F.lit("bad vector: "), F.col("chunk_id")))
    return chunks.withColumn(
        "chunk_embedding",
        F.when(valid_vector(dimension), F.col("chunk_embedding"))
        .otherwise(broken.cast(VECTOR)),
    )


def attach_vectors(
    chunks: DataFrame, vectors: DataFrame, keys: list[str] = ("document_name", "chunk_index"),
    vector: str = "chunk_embedding",
) -> DataFrame:
    """Join chunks to vectors kept in a table; a chunk with none or several fails the job."""
    keys = list(keys)
    several = F.raise_error(F.concat_ws(" ", F.lit("several vectors for"), *keys))
    one = vectors.groupBy(*keys).agg(F.first(vector).alias(vector), F.count("*").alias("_vectors"))
    one = one.withColumn(vector, F.when(F.col("_vectors") > 1, several.cast(vectors.schema[vector].dataType)).otherwise(F.col(vector))).drop("_vectors")
    joined = chunks.drop(vector).join(one, keys, "left")
    absent = F.raise_error(F.concat_ws(" ", F.lit("no vector for"), *keys))
    kind = vectors.schema[vector].dataType
    return joined.withColumn(
        vector, F.when(F.col(vector).isNull(), absent.cast(kind)).otherwise(F.col(vector)))
