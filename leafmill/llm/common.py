"""What several operators of this package share: reading, cutting lineage, words and shingles."""

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leafmill.session import use_checkpoints

SHINGLE = 5
#: A task forgets its word hashes beyond this many, so that its memory stays bounded.
WORD_CACHE = 300_000
#: Bytes of a batch that a task works on at once, about.
PART_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, in the shared folder of ``spark.checkpoint.dir``."""
    use_checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Hand at most ``size`` of rows to Python at once in what is computed meanwhile: for rows that are wide."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def in_parts(batches, size: int | None = None):
    """The rows of ``batches`` in order, in parts of about ``size`` bytes: Spark may send 10,000 wide rows in one."""
    for batch in batches:
        rows = max(1, batch.num_rows * (size or PART_BYTES) // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def strings(batch: pa.RecordBatch, name: str) -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def raw(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of a word, computed once per word and task."""

    def __missing__(self, word):
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: bytes | None) -> list[bytes]:
    """Runs outside \\x20 and \\x09-\\x0D with A-Z in lower case; none for null."""
    return text.lower().split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, in place."""
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    values ^= values >> np.uint64(33)
    return values


def shingle_hashes(words: list[bytes], hashes: WordHashes, width: int = SHINGLE) -> np.ndarray:
    """A 64-bit hash per window of ``width`` words, in order.

    Fewer words than ``width`` make one shingle of their whole sequence; no word makes none.
    """
    return _windows_of(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)), width)


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: A random 64-bit number for each byte, and the powers and inverse powers of an odd base, longer as needed.
_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << n.bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            factors = np.full(size, base, np.uint64)
            factors[0] = 1
            _POWERS[name] = np.multiply.accumulate(factors)
    return _POWERS["up"], _POWERS["down"]


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where each word of ``words_of`` starts and ends, in bytes."""
    edges = np.flatnonzero(np.diff(np.concatenate([[True], _BLANK[np.frombuffer(text, np.uint8)], [True]]).view(np.int8)))
    return edges[::2], edges[1::2]


def word_hashes(text: bytes | None) -> np.ndarray:
    """A 64-bit hash of each word of ``words_of``, computed over all bytes at once."""
    if not text:
        return np.empty(0, np.uint64)
    a = np.frombuffer(text.lower(), np.uint8)
    start, end = word_places(text)
    if not len(start):
        return np.empty(0, np.uint64)
    up, down = _powers(len(a))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_BYTES[a] * up[:len(a)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start])


def text_shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Hashes of a text's shingles, in order, as ``shingle_hashes`` forms them but from ``word_hashes``."""
    return _windows_of(word_hashes(text), width)


def _windows_of(ids: np.ndarray, width: int) -> np.ndarray:
    if not len(ids):
        return ids
    span = min(width, len(ids))
    out = np.full(len(ids) - span + 1, span, np.uint64)
    for k in range(span):
        out *= np.uint64(_BASE)
        out += ids[k:len(ids) - span + 1 + k]
        out ^= out >> np.uint64(29)
    return mixed(out)


def appended(df: DataFrame, columns: str, compute, inputs: list[str]) -> DataFrame:
    """Add ``columns`` (a DDL list) to ``df``; columns of those names are replaced.

    ``compute`` gets the columns ``inputs`` of a batch as lists, and returns a list of values for
    each new column.
    """
    new = StructType.fromDDL(columns)
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in new.names])
    schema = StructType([*df.schema, *new])
    arrow = to_arrow_schema(new)

    def run(batches):
        work = compute()
        for batch in in_parts(batches):
            values = work(*[strings(batch, name) for name in inputs])
            for field, column in zip(arrow, values, strict=True):
                batch = batch.append_column(field.name, pa.array(column, field.type))
            yield batch

    return df.mapInArrow(run, schema)


def last_picks(rows: DataFrame, group: str, sample: int) -> dict:
    """For each value of ``group`` the ``sample``-th smallest different value of ``pick``, a 64-bit hash.

    Rows up to it are a sample of at most ``sample`` different rows of the group. The hash is uniform, so rows far beyond the
    expected place of that value are left out before any are ranked: what is ranked does not grow with the input.
    """
    rows = rows.select(F.col(group).alias("group"), "pick")
    sizes = {r["group"]: r["n"] for r in rows.groupBy("group").agg(F.approx_count_distinct("pick").alias("n")).collect()}
    if not sizes:
        return {}
    near = F.lit(False)
    for value, n in sizes.items():
        bound = min((1 << 63) - 1, -(1 << 63) + int((1 << 64) * 2 * sample / max(1, n)))
        # The group may be costly to tell, and is looked at only where the hash is small enough.
        near = near | ((F.col("pick") <= bound) & F.col("group").eqNullSafe(F.lit(value)))
    rank = F.row_number().over(Window.partitionBy("group").orderBy("pick"))
    first = rows.where(near).distinct().withColumn("rank", rank).where(F.col("rank") <= sample)
    return {r["group"]: r["last"] for r in first.groupBy("group").agg(F.max("pick").alias("last")).collect()}


def saved(df: DataFrame) -> DataFrame:
    """Like ``stored``, as compressed columns: for wide rows of which later steps read a part.

    The table lies beside the checkpoints and stays until that folder is cleared.
    """
    spark = df.sparkSession
    use_checkpoints(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/saved-{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
