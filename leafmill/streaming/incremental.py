"""Ingest files as they arrive, with Structured Streaming keeping track of what is done."""

from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from leafmill import schema
from leafmill.plans.ingest import Settings, ingest_elements
from leafmill.sources import elements as elements_of, files as files_of
from leafmill.sources.store import ChunkStore

FILES = "path string, modificationTime timestamp, length bigint, content binary"


def ingest_new_files(
    spark: SparkSession, root: str, store: ChunkStore, workspace: str,
    settings: Settings = Settings(), pattern: str | None = None, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process all files that no earlier call has processed, then stop.

    A batch replayed after a failure writes the same ids again, which the upsert absorbs.
    """
    stream = spark.readStream.format("binaryFile").schema(FILES).option(
        "recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        stream = stream.option("pathGlobFilter", pattern)

    def ingest(batch, number):
        files = files_of.require_content(files_of.described(batch, root))
        path = f"{workspace}/elements/stream-{number}"
        elements_of.to_elements(files, settings.parsers).write.mode("overwrite").parquet(path)
        elements = batch.sparkSession.read.schema(schema.ELEMENTS).parquet(path)
        ingest_elements(
            elements, store, workspace, f"stream-{number}",
            datetime.now(timezone.utc).replace(tzinfo=None), settings)

    return (
        stream.load(root).writeStream.foreachBatch(ingest)
        .option("checkpointLocation", f"{workspace}/stream")
        .trigger(availableNow=True).start()
    )
