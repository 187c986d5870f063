"""Views of the sample tables as elements, notes, queries and indexes."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.operators.embedding import hashing_embedding

DIMENSION = 64


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Share a scan of fewer splits than cores among all cores; others are left as they are.

    Meant for small tables before costly expressions. A large table has splits enough.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def texts(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spread(table(spark, folder, name))


def _title(column: str):
    return F.concat(F.upper(F.substring(column, 1, 1)), F.lower(F.substr(column, F.lit(2))))


def order_notes(spark: SparkSession, folder: str) -> DataFrame:
    """One sentence per order that names an organisation, place, date, amount and percentage."""
    orders, customer, nation, region = (
        table(spark, folder, t) for t in ("orders", "customer", "nation", "region"))
    joined = (
        spread(orders).join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(
            F.lit("Order "), "o_orderkey", F.lit(" placed by "), _title("c_mktsegment"),
            F.lit(" Trading Corp. in "), _title("r_name"), F.lit(" on "),
            F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" for $"),
            F.format_number("o_totalprice", 2), F.lit(", "),
            (F.col("o_orderkey") % 17).cast("string"), F.lit(".5% off."),
        ).alias("text"),
    )


def document_index(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as one searchable row, with its hashed vector."""
    return texts(spark, folder, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("chunk_text"), "lang",
        hashing_embedding(F.col("text"), DIMENSION).alias("chunk_embedding"))


def vector_index(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("chunk_id"), F.col("embedding").alias("chunk_embedding"), "label")


def benchmark_queries(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.col("text").alias("query_text"))


def label_queries(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of each label, as a query."""
    rows = table(spark, folder, "embeddings").select(
        "label", F.posexplode("embedding").alias("at", "x"))
    means = rows.groupBy("label", "at").agg(F.avg(F.col("x").cast("double")).alias("mean"))
    # One entry per label and dimension remains.
    vectors = means.groupBy("label").agg(
        F.sort_array(F.collect_list(F.struct("at", "mean"))).alias("entries"))
    return vectors.select(
        F.col("label").alias("query_id"),
        F.transform("entries", lambda e: e["mean"]).alias("query_vector"))


def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """Page addresses, and one file name per document with suffixes of all kinds."""
    suffixes = [".pdf", ".DOCX", ".doc", ".txt", ".md", ".html", ".HTM", ".tar.gz", ""]
    suffix = F.element_at(F.array(*map(F.lit, suffixes)), (F.col("doc_id") % 9 + 1).cast("int"))
    named = table(spark, folder, "documents").select(
        F.concat_ws("/", "source", "lang", F.concat("doc_id", suffix)).alias("name"))
    return table(spark, folder, "pages").select(F.col("url").alias("name")).unionByName(named)
