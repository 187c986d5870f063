"""Consecutive numbers and fixed-size batches over ordered rows.

A window would put all rows of a partition key, or of the whole table, into one task. Here the
rows are range-partitioned by their order, numbered within each slice, and shifted by the sizes
of the slices before it. The slices are checkpointed, because a slice recomputed with other
bounds would repeat or skip numbers.
"""

from pyspark.sql import DataFrame, Window, functions as F

from leafmill.session import use_checkpoints


def with_ordinal(
    df: DataFrame, order_by: list[str], partition_by: list[str] = (), name: str = "ordinal",
    slices: int | None = None,
) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... by ``order_by`` within each value of ``partition_by``.

    Rows equal in both are told apart by their other columns where these can be hashed, so that
    many copies of one row spread over several slices.
    """
    use_checkpoints(df.sparkSession)
    keys = list(partition_by)
    kinds = dict(df.dtypes)
    hashable = [c for c in df.columns if "map<" not in kinds[c]]
    order = [*keys, *order_by, "_tie", "_copy"]
    marked = df.withColumn("_tie", F.xxhash64(*hashable)).withColumn(
        "_copy", F.monotonically_increasing_id())
    spread = (
        marked.repartitionByRange(slices, *order) if slices
        else marked.repartitionByRange(*order)
    )
    ranked = (
        spread.sortWithinPartitions(*order)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_at", F.monotonically_increasing_id())
        .drop("_tie", "_copy")
        .checkpoint()
    )
    sizes = ranked.groupBy(*keys, "_slice").agg(
        F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = before.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    # One row per slice and key: a key that fills many slices has one row for each.
    shifts = sizes.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys],
        F.col("_slice").alias("_key__slice"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    same = [ranked[k].eqNullSafe(shifts[f"_key_{k}"]) for k in [*keys, "_slice"]]
    condition = same[0]
    for further in same[1:]:
        condition = condition & further
    return ranked.join(shifts, condition).select(
        *df.columns, (F.col("_at") + F.col("_shift")).alias(name))


def with_batch(
    df: DataFrame, order_by: list[str], batch_size: int, partition_by: list[str] = (),
    name: str = "batch_id", slices: int | None = None,
) -> DataFrame:
    """Number consecutive groups of ``batch_size`` rows; the last one may be smaller."""
    if batch_size < 1:
        raise ValueError("batch_size must be positive")
    numbered = with_ordinal(df, order_by, partition_by, "_ordinal", slices)
    return numbered.withColumn(
        name, F.floor(F.col("_ordinal") / batch_size).cast("bigint")).drop("_ordinal")
