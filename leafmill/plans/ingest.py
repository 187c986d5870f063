"""Whole ingestion runs: elements or prepared chunks into the chunk store."""

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leafmill import schema
from leafmill.functions import entities as E
from leafmill.operators.chunking import chunk_elements
from leafmill.operators.embedding import (
    embed_chunks, hashing_embedding, require_vectors, valid_vector,
)
from leafmill.operators.normalize import normalize_chunks
from leafmill.operators.stats import counted
from leafmill.sources import elements as elements_of, files as files_of, runs
from leafmill.sources.store import ChunkStore


@dataclass(frozen=True)
class Settings:
    """``on_error`` is ``failfast``, or ``quarantine`` to set broken rows aside and go on."""

    size: int = 512
    overlap: int = 50
    dimension: int = 64
    id_mode: str = "path"
    on_error: str = "failfast"
    embedding: Callable[[Column], Column] | None = None
    replace_document: bool = True
    parsers: dict = field(default_factory=dict)

    def embed(self, text: Column) -> Column:
        return self.embedding(text) if self.embedding else hashing_embedding(text, self.dimension)


@dataclass(frozen=True)
class Result:
    status: str
    chunks: int = 0
    indexed: int = 0
    quarantined: int = 0


def enrich(chunks: DataFrame, settings: Settings, run_ts: datetime) -> DataFrame:
    """Tag, embed and stamp chunks; one lazy chain."""
    tagged = chunks.withColumn("entities", E.extract_entities(F.col("chunk_text")))
    counted_tags = tagged.withColumn("entity_count", E.count_entities(F.col("entities")))
    embedded = embed_chunks(counted_tags, settings.embed)
    return schema.conform(embedded.withColumn("processed_at", F.lit(run_ts)), schema.CHUNKS)


def chunks_from(elements: DataFrame, settings: Settings, run_ts: datetime) -> DataFrame:
    chunks = chunk_elements(
        elements_of.sanitized(elements), settings.size, settings.overlap, id_mode=settings.id_mode)
    return enrich(chunks, settings, run_ts)


def index_chunks(
    chunks: DataFrame, store: ChunkStore, settings: Settings, workspace: str, batch_id: str,
    run_ts: datetime, documents: DataFrame | None = None,
) -> Result:
    """Check, upsert and record chunks. They are computed once, into the workspace.

    ``documents`` names the batch's documents; one without a chunk loses its older chunks and is recorded
    with none. A batch that is run again replaces its own records.
    """
    spark = chunks.sparkSession
    lines = []
    if settings.on_error == "failfast":
        chunks = require_vectors(chunks, settings.dimension)
    seen, counts = counted(chunks, "chunks", valid=valid_vector(settings.dimension))
    path = f"{workspace}/chunks/{batch_id}"
    seen.write.mode("overwrite").parquet(path)
    total, valid = counts.get["rows"], counts.get["valid"]
    lines.append(f"chunks: {total}")
    ready = spark.read.schema(schema.CHUNKS).parquet(path)
    good = F.coalesce(valid_vector(settings.dimension), F.lit(False))
    if valid < total:
        runs.put_batch(ready.filter(~good), f"{workspace}/quarantine", batch_id)
    names = ready if documents is None else documents
    names = names.select("document_name").distinct()
    if valid or settings.replace_document:
        store.upsert(ready.filter(good), settings.replace_document, stored=True, documents=names)
    # A document with broken chunks is partial if it has others, and not recorded if not.
    held = ready.groupBy("document_name").agg(F.count_if(good).alias("n_chunks"), F.count_if(~good).alias("broken"))
    rows = names.join(held, "document_name", "left").fillna(0, ["n_chunks", "broken"])
    rows = rows.filter("n_chunks > 0 or broken = 0").withColumn(
        "status", F.when(F.col("broken") > 0, "partial").otherwise("success"))
    runs.record_documents(rows, f"{workspace}/manifest", batch_id, run_ts)
    if total == 0:
        runs.write_log(spark, f"{workspace}/run_log", "finished", [*lines, "no chunks"], run_ts, batch_id)
        return Result("empty")
    status = "success" if valid == total else "partial"
    lines += [f"indexed: {valid}/{total}", f"status: {status}"]
    runs.write_log(spark, f"{workspace}/run_log", status, lines, run_ts, batch_id)
    return Result(status, total, valid, total - valid)


def ingest_elements(
    elements: DataFrame, store: ChunkStore, workspace: str, batch_id: str, run_ts: datetime,
    settings: Settings = Settings(), resume: bool = False, documents: DataFrame | None = None,
) -> Result:
    """Ordered elements to indexed chunks; ``resume`` skips documents already recorded.

    ``documents`` names the batch's documents if some may have no element.
    """
    if resume:
        manifest = runs.read_manifest(elements.sparkSession, f"{workspace}/manifest")
        elements = runs.pending_documents(elements, manifest)
    store.create()
    chunks = chunks_from(elements, settings, run_ts)
    names = elements if documents is None else documents
    return index_chunks(chunks, store, settings, workspace, batch_id, run_ts, names)


def ingest_files(
    spark: SparkSession, root: str, store: ChunkStore, workspace: str, batch_id: str,
    run_ts: datetime, settings: Settings = Settings(), pattern: str | None = None,
    resume: bool = False,
) -> Result:
    """Files below ``root`` to indexed chunks."""
    files = files_of.read_files(spark, root, pattern)
    if resume:
        files = runs.pending_documents(files, runs.read_manifest(spark, f"{workspace}/manifest"))
    if files.isEmpty():
        runs.write_log(spark, f"{workspace}/run_log", "finished", ["no files"], run_ts, batch_id)
        return Result("empty")
    unsupported = elements_of.unsupported_files(files, settings.parsers).select(
        "document_name", F.concat(F.lit("no parser for "), "document_type").alias("reason"))
    if settings.on_error == "failfast":
        files = files_of.require_content(files)
        first = unsupported.first()
        if first is not None:
            raise ValueError(f"{first.document_name}: {first.reason}")
    else:
        files, missing = files_of.split_missing_content(files)
        files = files.filter(F.col("document_type").isin(*elements_of.BUILT_IN, *settings.parsers))
        rejected = unsupported.unionByName(missing)
        runs.put_batch(rejected, f"{workspace}/rejected_files", batch_id, "json")
    # Stored, so that files are read and parsed once however often chunking looks at them.
    path = f"{workspace}/elements/{batch_id}"
    elements_of.to_elements(files, settings.parsers).write.mode("overwrite").parquet(path)
    elements = spark.read.schema(schema.ELEMENTS).parquet(path)
    return ingest_elements(
        elements, store, workspace, batch_id, run_ts, settings, documents=files.select("document_name"))


def index_chunk_files(
    spark: SparkSession, path: str, store: ChunkStore, workspace: str, batch_id: str,
    run_ts: datetime, settings: Settings = Settings(),
) -> Result:
    """Chunk JSON prepared elsewhere to indexed chunks."""
    given = files_of.read_chunk_json(spark, path)
    if given.isEmpty():
        runs.write_log(spark, f"{workspace}/run_log", "finished", ["no chunks"], run_ts, batch_id)
        return Result("empty")
    store.create()
    return index_chunks(normalize_chunks(given), store, settings, workspace, batch_id, run_ts)
