"""Approximate vector search: read only the cells near the queries, then rank exactly.

A vector's cell is the side it lies on of each of ``bits`` fixed hyperplanes. Stored with the
rows as a partition or sort column, the cell filter prunes files. Cells are never grouped or
joined on, so a cell that holds most rows only costs reading them.
"""

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from leafmill.operators.search import search_vector

MAX_BITS = 16


def hyperplanes(dimension: int, bits: int) -> np.ndarray:
    """Plus or minus one by the parity of the first hex digit of MD5("<bit>:<position>")."""
    def sign(bit, at):
        return 1.0 if int(hashlib.md5(f"{bit}:{at}".encode()).hexdigest()[0], 16) % 2 else -1.0

    return np.array([[sign(b, at) for at in range(dimension)] for b in range(bits)])


def cell(vector: Column, dimension: int, bits: int) -> Column:
    """Cell number of a vector; null for one of another dimension."""
    if bits > MAX_BITS:
        raise ValueError(f"at most {MAX_BITS} bits")
    planes = hyperplanes(dimension, bits)
    weights = 1 << np.arange(bits)

    @F.arrow_udf("int")
    def locate(vectors: pa.Array) -> pa.Array:
        fits = np.array(pc.equal(pc.list_value_length(vectors), dimension).fill_null(False))
        flat = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
        sides = flat.astype(np.float64).reshape(-1, dimension) @ planes.T >= 0
        cells = np.zeros(len(vectors), np.int32)
        cells[fits] = sides @ weights
        return pa.array(cells, mask=~fits)

    return locate(vector)


def with_cells(queries: DataFrame, dimension: int, bits: int) -> DataFrame:
    """Queries with their own cell as ``query_cell``."""
    own = cell(F.col("query_vector").cast("array<float>"), dimension, bits)
    return queries.withColumn("query_cell", own)


def probed_cells(queries: DataFrame, bits: int, radius: int) -> list[int]:
    """Cells that differ from some query's own cell in up to ``radius`` bits; at most 2^bits."""
    flips = [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    own = queries.select("query_cell").filter("query_cell is not null").distinct().collect()
    return sorted({row.query_cell ^ flip for row in own for flip in flips})


def search_approximate(
    index: DataFrame, queries: DataFrame, dimension: int, bits: int = 8, radius: int = 1,
    k: int = 10, cell_column: str | None = None, **options,
) -> DataFrame:
    """``search_vector`` where each query sees the rows of the cells around its own.

    The cells of all queries together decide what is read, so a query's hits do not depend on the others.
    ``cell_column`` names a stored cell; a partition column then prunes files.
    """
    vector = options.get("vector", "chunk_embedding")
    queries = with_cells(queries, dimension, bits)
    if not cell_column:
        cell_column = "_own_cell"
        index = index.withColumn(cell_column, cell(F.col(vector), dimension, bits))
    cells = probed_cells(queries, bits, radius)
    near = index.filter(F.col(cell_column).isin(cells))
    return search_vector(near, queries, k, near=(cell_column, radius), **options)
