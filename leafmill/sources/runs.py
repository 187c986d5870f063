"""Records of runs: which documents are done, and what was logged."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill import schema


def put_batch(rows: DataFrame, path: str, batch_id: str, format: str = "parquet") -> None:
    """Write the rows of a batch below ``path``, in place of what an earlier run of it left there."""
    rows.drop("batch_id").withColumn("batch_id", F.lit(batch_id)).write.partitionBy("batch_id").mode(
        "overwrite").option("partitionOverwriteMode", "dynamic").format(format).save(path)


def record_documents(
    documents: DataFrame, path: str, batch_id: str, run_ts: datetime, status: str = "success"
) -> None:
    """One manifest row per document of the batch: ``document_name``, ``n_chunks`` and, if it differs from
    ``status``, a ``status`` of its own."""
    own = F.col("status") if "status" in documents.columns else F.lit(status)
    rows = documents.select(
        F.lit(batch_id).alias("batch_id"), "document_name", own.alias("status"),
        F.col("n_chunks").cast("int").alias("n_chunks"), F.lit(run_ts).alias("run_ts"))
    put_batch(schema.conform(rows, schema.MANIFEST), path, batch_id)


def read_manifest(spark: SparkSession, path: str, batch_id: str | None = None) -> DataFrame:
    """Manifest rows, of one batch if given; none when nothing was recorded yet."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path):
        return spark.createDataFrame([], schema.MANIFEST)
    rows = spark.read.schema(schema.MANIFEST).parquet(path)
    return rows if batch_id is None else rows.filter(F.col("batch_id") == batch_id)


def pending_documents(documents: DataFrame, manifest: DataFrame) -> DataFrame:
    """Documents the manifest does not list as done."""
    done = manifest.filter(F.col("status") == "success").select("document_name").distinct()
    return documents.join(done, "document_name", "left_anti").select(*documents.columns)


def write_log(
    spark: SparkSession, path: str, label: str, lines: list[str], run_ts: datetime, batch_id: str
) -> None:
    rows = [(run_ts, label, number, line) for number, line in enumerate(lines)]
    put_batch(spark.createDataFrame(rows, schema.RUN_LOG).coalesce(1), path, batch_id, "json")
