"""Vector predicates."""

from pyspark.sql import Column, functions as F


def has_dimension(vector: Column, dimension: int) -> Column:
    return F.coalesce(F.size(vector) == dimension, F.lit(False))


def is_nonzero(vector: Column) -> Column:
    """Cosine is undefined for a zero vector, so such rows never reach an index."""
    return F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def dimensions_agree(vector: Column, dimension: int) -> Column:
    """Aggregate: true when every vector has the dimension, also over no rows."""
    return F.coalesce(F.every(has_dimension(vector, dimension)), F.lit(True))
