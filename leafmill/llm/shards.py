"""Sharding by a k-d tree over the documents' metadata.

A node that is to become k shards is split at the weighted median (or, for odd k, the matching
quantile) of its bytes along the dimension in which its rows spread widest, until every leaf has the
target size. Medians are found by histograms: each pass counts the bytes of all open nodes by
bucket, and the bucket that holds the cut is divided further in the next pass. Rows that agree in the
dimension are ordered by a hash of their text, then by a hash of their id, so that equal texts mostly
stay together while one text that fills several shards is still divided evenly.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from leafmill.llm.common import stored

BUCKETS = 256
#: Bits of the hashes that order rows of one point.
KEY_BITS = 48
#: Where the bytes beside a cut may be off, as a share of a shard.
TOLERANCE = 0.002


@dataclass
class _Node:
    """Rows with ``leaf`` = first, to become ``shards`` shards; the search for its cut."""

    first: int
    shards: int
    part: int = 0  # component of the order that is searched: dimension, text, id
    fixed: list[int] = field(default_factory=list)
    low: int = 0
    high: int = 0
    below: int = 0  # bytes before the searched interval
    target: float = 0.0
    slack: float = 0.0
    dimension: str = ""
    cut: list[int] | None = None


def _before(names: list[str], cut: list[int]):
    """Whether the tuple of columns is less than ``cut``."""
    out = F.lit(False)
    for name, value in reversed(list(zip(names, cut, strict=True))):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def kd_leaves(rows: DataFrame, dimensions: list[str], shards: int) -> DataFrame:
    """Add ``leaf``, 0 to ``shards`` - 1, to ``rows``: size, long ``dimensions``, text_key and id_key (longs).

    ``rows`` is read some times for each level of the tree, so it should be stored. What comes to the
    driver is a bounded table per pass: nodes x ``BUCKETS``.
    """
    whole = rows.agg(*[F.min(d).alias(f"low_{d}") for d in dimensions], *[F.max(d).alias(f"high_{d}") for d in dimensions]).first()
    spread = {d: max(1, (whole[f"high_{d}"] or 0) - (whole[f"low_{d}"] or 0)) for d in dimensions}
    leaf, nodes = F.lit(0), [_Node(0, shards)]
    while any(n.shards > 1 for n in nodes):
        open_ = [n for n in nodes if n.shards > 1]
        placed = rows.withColumn("leaf", leaf)
        bounds = {r["leaf"]: r for r in placed.groupBy("leaf").agg(
            F.sum("size").alias("bytes"), *[f(d).alias(f"{k}_{d}") for d in dimensions for k, f in (("low", F.min), ("high", F.max))]).collect()}
        for n in open_:
            b = bounds.get(n.first)
            if b is None:  # no row
                n.dimension, n.cut = dimensions[0], [0, 0, 0]
                continue
            n.dimension = max(dimensions, key=lambda d: (b[f"high_{d}"] - b[f"low_{d}"]) / spread[d])
            n.low, n.high = b[f"low_{n.dimension}"], b[f"high_{n.dimension}"]
            n.target = b["bytes"] * (n.shards // 2) / n.shards
            n.slack = TOLERANCE * b["bytes"] / n.shards
        while searched := [n for n in open_ if n.cut is None]:
            counts = _histogram(placed, searched)
            for n in searched:
                _narrow(n, counts.get(n.first, {}))
        conditions, after = None, []
        for n in nodes:
            if n.shards == 1:
                after.append(n)
                continue
            left = n.shards // 2
            after += [_Node(n.first, left), _Node(n.first + left, n.shards - left)]
            right = (leaf == n.first) & ~_before([n.dimension, "text_key", "id_key"], n.cut)
            conditions = F.when(right, n.first + left) if conditions is None else conditions.when(right, n.first + left)
        leaf, nodes = conditions.otherwise(leaf), after
        # The next level reads the leaves from a column instead of an ever longer expression.
        rows = stored(rows.withColumn("leaf", leaf))
        leaf = F.col("leaf")
    return rows if "leaf" in rows.columns else rows.withColumn("leaf", leaf)


def _histogram(placed: DataFrame, nodes: list[_Node]) -> dict[int, dict[int, int]]:
    """Bytes by bucket of each node's interval."""
    bucket = None
    for n in nodes:
        names = [n.dimension, "text_key", "id_key"]
        inside = F.col("leaf") == n.first
        for name, value in zip(names, n.fixed, strict=False):
            inside &= F.col(name) == value
        c = F.col(names[n.part])
        inside &= c.between(n.low, n.high)
        width = -(-(n.high - n.low + 1) // BUCKETS)
        value = F.expr(f"int((`{names[n.part]}` - {n.low}L) div {width}L)")
        bucket = F.when(inside, value) if bucket is None else bucket.when(inside, value)
    found = placed.select("leaf", "size", bucket.alias("bucket")).where("bucket is not null").groupBy("leaf", "bucket").agg(F.sum("size").alias("bytes"))
    out: dict[int, dict[int, int]] = {}
    for r in found.collect():  # at most nodes x BUCKETS rows
        out.setdefault(r["leaf"], {})[r["bucket"]] = r["bytes"]
    return out


def _narrow(n: _Node, counts: dict[int, int]) -> None:
    """Take the bucket in which the target lies; cut when it is small enough, or a single value of the last component."""
    width = -(-(n.high - n.low + 1) // BUCKETS)
    below = n.below
    for b in sorted(counts):
        if below + counts[b] >= n.target:
            break
        below += counts[b]
    low = n.low + b * width
    rest = [-(1 << 62)] * (2 - n.part)
    if counts[b] <= n.slack or n.part == 2 and width == 1:
        up = n.target - below > below + counts[b] - n.target
        n.cut = [*n.fixed, low + width * up, *rest]
    elif width == 1:
        n.fixed.append(low)
        n.part, n.below, n.low, n.high = n.part + 1, below, 0, (1 << KEY_BITS) - 1
    else:
        n.below, n.low, n.high = below, low, min(n.high, low + width - 1)


def _numberer(offsets: dict[tuple[int, int], int]):
    """Slots of a partition's rows: the rows of its shard in earlier partitions, then one by one."""

    def run(batches):
        seen: dict[int, int] = {}
        for batch in batches:
            part = batch.column(batch.schema.get_field_index("part")).to_numpy()
            shard = batch.column(batch.schema.get_field_index("shard")).to_numpy()
            slots = np.zeros(len(shard), np.int64)
            for s in np.unique(shard):
                at = np.flatnonzero(shard == s)
                first = seen.get(int(s), offsets.get((int(part[0]), int(s)), 0))
                slots[at] = first + np.arange(len(at))
                seen[int(s)] = first + len(at)
            yield batch.append_column("slot", pa.array(slots))

    return run


def with_slots(rows: DataFrame) -> DataFrame:
    """Add ``slot``, gapless from 0 within each ``shard``, to the stored partitions of ``rows``.

    Only counts by partition and shard come to the driver: a number for each shard that a partition holds.
    """
    rows = stored(rows.withColumn("part", F.spark_partition_id()))
    counts: dict[int, int] = {}
    offsets = {}
    for r in rows.groupBy("part", "shard").count().orderBy("part", "shard").collect():
        offsets[r["part"], r["shard"]] = counts.get(r["shard"], 0)
        counts[r["shard"]] = offsets[r["part"], r["shard"]] + r["count"]
    schema = StructType([*rows.schema, StructField("slot", LongType())])
    return rows.mapInArrow(_numberer(offsets), schema).drop("part")


def shard(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all rows of ``docs`` (doc_id, text, lang, source).

    Give ``shards``, or ``target_bytes`` of a shard. The size of a row is the UTF-8 bytes of its text
    (none for null) plus 1. Dimensions: size (logarithm), language and source (place of their
    hash), those of equal texts being those of its smallest row. Law ``bytes``: shards have nearly the same number of bytes, except where single
    rows are larger than that. Nulls are values of their own; repeated rows are rows. An empty table
    gives no row.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    mask = (1 << KEY_BITS) - 1
    rows = docs.select(
        "doc_id", size.alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.xxhash64("text", F.lit("text")).bitwiseAND(F.lit(mask)).alias("text_key"),
        F.xxhash64("doc_id").bitwiseAND(F.lit(mask)).alias("id_key"),
        F.floor(F.log2(size) * 1000).alias("by_size"),
        F.xxhash64("lang").bitwiseAND(F.lit((1 << 31) - 1)).alias("by_lang"), F.xxhash64("source").bitwiseAND(F.lit((1 << 31) - 1)).alias("by_source"))
    rows = stored(rows)
    # Copies of a text take the metadata of one of them, so that they lie at one point.
    points = rows.groupBy("text_key", "text_crc32", "size").agg(
        F.min("by_lang").alias("by_lang"), F.min("by_source").alias("by_source"), F.count("*").alias("copies"))
    copied = points.where("copies > 1").drop("copies")
    rows = (rows.join(copied.withColumnsRenamed({"by_lang": "lang_of", "by_source": "source_of"}), ["text_key", "text_crc32", "size"], "left")
            .withColumns({"by_lang": F.coalesce("lang_of", "by_lang"), "by_source": F.coalesce("source_of", "by_source")}).drop("lang_of", "source_of"))
    rows = stored(rows)
    if shards is None:
        total = rows.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    placed = kd_leaves(rows, ["by_size", "by_lang", "by_source"], shards)
    placed = placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("leaf").cast("int").alias("shard"))
    return with_slots(placed).withColumn("grown_shard", F.lit(None).cast("int")).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
