"""Readers for binary files and prepared chunk JSON."""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill import schema
from leafmill.functions import text as X


#: Bytes of a block of a file, about.
BLOCK_BYTES = 1 << 20


def read_files(
    spark: SparkSession, root: str, pattern: str | None = None, recursive: bool = True,
    blocks: bool = False,
) -> DataFrame:
    """Binary files under ``root``: name relative to it, type, size, time and content.

    With ``blocks`` a file comes as many rows, so that no task holds it whole: ``content`` is a
    part of it, and ``place`` orders the parts. The parts of a file are its lines, each with a line
    feed, also after the last one, and lack a byte order mark: ``digests`` sets both right by length.
    """
    reader = spark.read
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if not blocks:
        return described(reader.format("binaryFile").load(root), root)
    lines = reader.format("text").option("lineSep", "\n").load(root).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_modification_time").alias("modificationTime"),
        F.col("_metadata.file_size").alias("length"),
        F.struct(F.col("_metadata.file_block_start").alias("split"), F.lit(0).cast("long").alias("part")).alias("place"),
        F.col("value").cast("binary").alias("content"))
    # Like the reader of binary files, that of text leaves out files without a byte.
    return described(lines.mapInArrow(_joined_lines, lines.schema), root, "place")


def _joined_lines(batches):
    """Lines of a split in parts of ``BLOCK_BYTES``, or one line where that is longer."""
    held, key, size, part = [], None, 0, 0

    def block():
        one, lines = held[0], [line for b in held for line in b.column("content").to_pylist()]
        place = [{"split": one.column("place")[0]["split"].as_py(), "part": part}]
        columns = {k: one.column(k).slice(0, 1) for k in ("path", "modificationTime", "length")}
        return pa.RecordBatch.from_arrays(
            [*columns.values(), pa.array(place, one.column("place").type), pa.array([b"\n".join([*lines, b""])], one.column("content").type)],
            schema=one.schema)

    for batch in batches:
        if not batch.num_rows:
            continue
        split = batch.column("place").field("split").to_numpy()
        path = batch.column("path").dictionary_encode().indices.to_numpy()
        sizes = np.cumsum(pa.compute.binary_length(batch.column("content")).to_numpy().astype(np.int64) + 1) // BLOCK_BYTES
        new = (split[1:] != split[:-1]) | (path[1:] != path[:-1])
        cuts = np.flatnonzero(new | (sizes[1:] != sizes[:-1])) + 1
        for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            of = (batch.column("path")[s].as_py(), int(split[s]))
            if held and (of != key or size > BLOCK_BYTES):
                yield block()
                held, size, part = [], 0, part + 1
            if of != key:
                key, part = of, 0
            held.append(batch.slice(s, e - s))
            size += held[-1].nbytes
    if held:
        yield block()


def digests(files: DataFrame) -> DataFrame:
    """document_name, document_type, length and MD5 of files whose ``content`` was read in blocks.

    The parts of a file go to one task in order, which holds one batch of them at a time.
    """
    names = ["path", "document_name", "document_type", "length"]
    rows = files.select(*names, "content", "place").repartition("path").sortWithinPartitions("path", "place")
    return rows.drop("place").mapInArrow(
        _digests, "document_name string, document_type string, length long, digest string")


_MARK = b"\xef\xbb\xbf"


def _digests(batches):
    file = None

    def done():
        """The sum of which the size is the file's: with a mark, without the last line feed, both or neither."""
        sizes = {total + len(mark) - cut: (mark, cut) for mark in (b"", _MARK) for cut in (0, 1)}
        if file["length"] not in sizes:
            raise ValueError(f"read {total} bytes of {file['path']}, which has {file['length']}")
        mark, cut = sizes[file["length"]]
        digest = sums[mark]
        digest.update(last[:len(last) - cut])
        out.append((file["document_name"], file["document_type"], file["length"], digest.hexdigest()))

    def rows():
        return pa.RecordBatch.from_pydict({k: pa.array(v, t) for k, v, t in zip(
            ("document_name", "document_type", "length", "digest"), zip(*out, strict=True),
            (pa.string(), pa.string(), pa.int64(), pa.string()), strict=True)})

    out = []
    for batch in batches:
        for row in batch.to_pylist():
            if file is None or row["path"] != file["path"]:
                if file:
                    done()
                file, total, last = {k: row[k] for k in ("path", "document_name", "document_type", "length")}, 0, b""
                sums = {mark: hashlib.md5(mark, usedforsecurity=False) for mark in (b"", _MARK)}
            for digest in sums.values():
                digest.update(last)
            last = row["content"]
            total += len(last)
        if out:
            yield rows()
            out = []
    if file:
        done()
        yield rows()


def described(files: DataFrame, root: str, *more: str) -> DataFrame:
    """Name files by their path below ``root`` and tell their type; columns ``more`` are kept."""
    return files.select(
        relative_name(F.col("path"), root).alias("document_name"),
        X.document_type(F.col("path")).alias("document_type"),
        "path", "modificationTime", "length", "content", *more,
    )


def relative_name(path: Column, root: str) -> Column:
    """The path below ``root``; unique in a scan, unlike the bare file name."""
    base = root.rstrip("/").split("://")[-1].removeprefix("file:") + "/"
    at = F.instr(path, base)
    return F.when(at > 0, F.substr(path, at + F.lit(len(base)))).otherwise(X.file_name(path))


def require_content(files: DataFrame) -> DataFrame:
    """Fail the job, naming the file, when a file has no content."""
    missing = F.raise_error(F.concat(F.lit("missing content: "), F.col("document_name")))
    return files.withColumn(
        "content",
        F.when(F.col("content").isNull(), missing.cast("binary")).otherwise(F.col("content")),
    )


def split_missing_content(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable files, names of files without content)."""
    bad = files.filter(F.col("content").isNull()).select(
        "document_name", F.lit("missing content").alias("reason"))
    return files.filter(F.col("content").isNotNull()), bad


def read_chunk_json(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Prepared chunks: JSON arrays over several lines, or one chunk per line.

    The schema is fixed, since inference would turn ``entities`` into a struct of whatever keys
    occur. Files with one chunk per line can be split among tasks; the others cannot.
    """
    return (
        spark.read.schema(schema.CHUNKS).option("multiLine", multi_line)
        .option("pathGlobFilter", "*.json").json(path)
    )


def empty_chunks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schema.CHUNKS)
