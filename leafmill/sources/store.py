"""The chunk table: Parquet keyed by ``chunk_id``, replaced bucket by bucket.

Rows are spread over buckets by the document part of their id. A write appends files of its new
rows; only buckets in which it replaces or removes rows are written anew. Then one small commit
names the versions that make up every bucket and the number of buckets, so a reader sees the table
before or after a write and a failed write leaves no trace in it.

    <root>/incoming/version=<n>/   a batch that was not stored yet
    <root>/data/version=<n>/bucket=<b>/
    <root>/commits/version=<n>/    valid once complete; one writer at a time
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill import schema


def last_per_key(df: DataFrame, key: str = "chunk_id", order_by: list[str] = ("processed_at",)) -> DataFrame:
    """The last row of each key. Only keys that occur more than once have their rows compared.

    Rows equal in ``order_by`` are settled by hash, so that repeated runs agree. ``df`` is read
    several times.
    """
    repeated = df.groupBy(key).count().filter("count > 1").select(key)
    if repeated.isEmpty():
        return df
    hashable = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    order = F.struct(*order_by, F.xxhash64(*hashable))
    copies = df.join(repeated, key, "left_semi")
    last = copies.groupBy(key).agg(
        F.max_by(F.struct(*[c for c in df.columns if c != key]), order).alias("row")
    ).select(key, "row.*").select(*df.columns)
    return df.join(repeated, key, "left_anti").select(*df.columns).unionByName(last)


def merge_rows(old: DataFrame, new: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``old`` without the keys of ``new``, and ``new``."""
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def without_documents(chunks: DataFrame, names: DataFrame) -> DataFrame:
    """Chunks of documents other than those in ``names.document_name``."""
    return chunks.join(names.select("document_name"), "document_name", "left_anti").select(
        *chunks.columns)


class ChunkStore:
    """``buckets`` holds for a new table, 64 without it; a stored table keeps its own number."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        kept = self._kept_buckets()
        if kept is not None and buckets not in (None, kept):
            raise ValueError(f"{root} has {kept} buckets, not {buckets}")
        self.buckets = kept or buckets or 64

    # Files

    def _path(self, *parts):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _listed(self, *parts) -> list[str]:
        """Names matching a glob below the root."""
        found = self._fs().globStatus(self._path(*parts))
        return [status.getPath().toString() for status in found or []]

    @staticmethod
    def _number(path: str, label: str) -> int:
        return int(path.split(f"{label}=")[1].split("/")[0])

    def _version(self) -> int | None:
        done = self._listed("commits", "version=*", "_SUCCESS")
        return max((self._number(p, "version") for p in done), default=None)

    def _next_version(self) -> int:
        started = self._listed("*", "version=*")
        return max((self._number(p, "version") for p in started), default=-1) + 1

    def _committed(self) -> list:
        """Rows (bucket, version, buckets) of the last commit; bucket is null in the first one."""
        version = self._version()
        if version is None:
            return []
        return self.spark.read.schema("bucket int, version int, buckets int").json(
            f"{self.root}/commits/version={version}").collect()

    def _kept_buckets(self) -> int | None:
        return next((row.buckets for row in self._committed()), None)

    def _current(self) -> dict[int, list[int]]:
        """Versions of each bucket that holds rows."""
        current: dict[int, list[int]] = {}
        for row in self._committed():
            if row.bucket is not None:
                current.setdefault(row.bucket, []).append(row.version)
        return current

    def _commit(self, version: int, current: dict[int, list[int]]) -> None:
        rows = [(None, None, self.buckets)]
        rows += [(b, v, self.buckets) for b, versions in sorted(current.items()) for v in versions]
        self.spark.createDataFrame(rows, "bucket int, version int, buckets int").coalesce(1).write.mode(
            "errorifexists").json(f"{self.root}/commits/version={version}")

    def _bucket(self) -> Column:
        document = F.regexp_replace("chunk_id", r"_chunk_\d+\z", "")
        return F.pmod(F.xxhash64(document), F.lit(self.buckets)).cast("int")

    # Reading

    def exists(self) -> bool:
        return self._version() is not None

    def read(self, buckets: set[int] | None = None) -> DataFrame:
        return self._read(self._current(), buckets).drop("bucket")

    def _read(self, current: dict[int, list[int]], buckets: set[int] | None = None) -> DataFrame:
        paths = [
            f"{self.root}/data/version={v}/bucket={b}" for b, versions in sorted(current.items())
            if buckets is None or b in buckets for v in versions
        ]
        if paths:
            rows = self.spark.read.schema(schema.CHUNKS).parquet(*paths)
        else:
            rows = self.spark.createDataFrame([], schema.CHUNKS)
        return rows.withColumn("bucket", self._bucket())

    def stats(self) -> DataFrame:
        """One row: name, rows, bytes and buckets in use."""
        current = self._current()
        name, used = F.lit(self.root.rsplit("/", 1)[-1]), F.lit(len(current)).cast("bigint")
        chunks = self._read(current)
        if not current:
            files = chunks.select(F.lit("").alias("file"), F.lit(0).cast("bigint").alias("bytes"))
        else:
            files = chunks.select(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
        per_file = files.groupBy("file").agg(F.max("bytes").alias("bytes"), F.count("*").alias("rows"))
        return per_file.agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("document_count"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("size_in_bytes"),
        ).select(
            name.alias("index_name"), "document_count", "size_in_bytes",
            used.alias("number_of_buckets"))

    # Writing

    def create(self) -> bool:
        """Create the empty table; false if it is there already."""
        if self.exists():
            return False
        self._commit(self._next_version(), {})
        return True

    def drop(self) -> bool:
        """Delete the table; false if there is none."""
        fs, root = self._fs(), self._path()
        return bool(fs.exists(root) and fs.delete(root, True))

    def _put(self, version: int, rows: DataFrame, rewritten: set[int]) -> int:
        """Write rows, in place of what the ``rewritten`` buckets held and beside the others; commit."""
        # The hint lets Spark split a bucket that outgrows one task, and join small ones.
        rows.hint("rebalance", "bucket").sortWithinPartitions(
            "bucket", "document_name", "chunk_index"
        ).write.partitionBy("bucket").parquet(f"{self.root}/data/version={version}")
        written = {self._number(p, "bucket")
                   for p in self._listed("data", f"version={version}", "bucket=*")}
        current = {b: v for b, v in self._current().items() if b not in rewritten}
        for bucket in written:
            current[bucket] = [*current.get(bucket, []), version]
        self._commit(version, current)
        return version

    @staticmethod
    def _buckets_of(rows: DataFrame) -> set[int]:
        return {row.bucket for row in rows.select("bucket").distinct().collect()}

    def _holding(self, current, rows: DataFrame, column: str) -> set[int]:
        """Buckets with rows whose ``column`` is among those of ``rows``: a scan of narrow columns."""
        held = self._read(current).select(column, "bucket")
        return self._buckets_of(held.join(rows.select(column), column, "left_semi"))

    def upsert(
        self, chunks: DataFrame, replace_document: bool = False,
        order_by: list[str] = ("processed_at",), stored: bool = False,
        documents: DataFrame | None = None,
    ) -> int:
        """Insert rows or replace those with the same id; returns the committed version.

        ``replace_document`` also removes every older chunk of the batch's documents: those in
        ``documents.document_name``, so that one which has no chunk any more loses its old
        ones, or without it those of ``chunks``. ``stored`` says that ``chunks`` is read from files; else they are
        written first, since they are used several times and may be costly to compute.
        """
        self.create()
        version = self._next_version()
        chunks = schema.conform(chunks, schema.CHUNKS)
        if not stored:
            path = f"{self.root}/incoming/version={version}"
            chunks.write.parquet(path)
            chunks = self.spark.read.schema(schema.CHUNKS).parquet(path)
        new = last_per_key(chunks.withColumn("bucket", self._bucket()), "chunk_id", order_by)
        current, rewritten, names = self._current(), set(), None
        if current:
            # Buckets without a row to replace or remove are only added to.
            rewritten = self._holding(current, new, "chunk_id")
            if replace_document:
                given = chunks if documents is None else documents
                names = given.select("document_name").distinct()
                rewritten |= self._holding(current, names, "document_name")
        if not rewritten:
            return version if self._put_any(version, new) else self._version()
        old = self._read(current, rewritten)
        if names is not None:
            old = without_documents(old, names)
        return self._put(version, merge_rows(old, new), rewritten)

    def _put_any(self, version: int, rows: DataFrame) -> bool:
        if rows.isEmpty():
            return False
        self._put(version, rows, set())
        return True

    def delete_documents(self, names: DataFrame) -> int:
        """Remove all chunks of the named documents; returns the committed version."""
        current = self._current()
        names = names.select("document_name").distinct()
        touched = self._holding(current, names, "document_name") if current else set()
        if not touched:
            return self._version()
        kept = without_documents(self._read(current, touched), names)
        return self._put(self._next_version(), kept, touched)

    def compact(self, versions: int = 8) -> int:
        """Write buckets of more than ``versions`` versions anew as one."""
        current = self._current()
        many = {b for b, held in current.items() if len(held) > versions}
        return self._put(self._next_version(), self._read(current, many), many) if many else self._version()

    def remove_superseded(self) -> None:
        """Delete files that the current version does not use. No reader may be using them."""
        current, latest = self._current(), self._version()
        wanted = {f"version={v}/bucket={b}" for b, versions in current.items() for v in versions}
        old = [p for p in self._listed("data", "version=*", "bucket=*")
               if "/".join(p.split("/")[-2:]) not in wanted]
        old += self._listed("incoming", "version=*")
        old += [p for p in self._listed("commits", "version=*")
                if self._number(p, "version") != latest]
        fs = self._fs()
        for path in old:
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path), True)


def write_partitions(chunks: DataFrame, write: Callable, batch_size: int = 500) -> None:
    """Hand every partition's rows to ``write(list_of_dicts)`` in batches, on the executors.

    For writing to an outside service. A lost task is run again, so ``write`` must be idempotent.
    """
    def send(rows):
        batch = []
        for row in rows:
            batch.append(row.asDict(recursive=True))
            if len(batch) == batch_size:
                write(batch)
                batch = []
        if batch:
            write(batch)

    chunks.foreachPartition(send)
