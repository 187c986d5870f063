"""Every operator as a query over the sample tables: name -> (spark, folder) -> DataFrame."""

import uuid

import numpy as np
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from leafmill.functions import entities as E, text as X, vectors as V
from leafmill import schema
from leafmill.operators import embedding as M, search as R, stats as A
from leafmill.operators.approximate import search_approximate
from leafmill.operators import ivf
from leafmill.operators.chunking import chunk_elements
from leafmill.operators.normalize import normalize_chunks
from leafmill.operators.ordinals import with_batch, with_ordinal
from leafmill.plans import corpora as C
from leafmill.plans.ingest import Settings, ingest_elements
from leafmill.session import use_checkpoints
from leafmill.sources import elements as L, files as S, runs
from leafmill.sources.store import ChunkStore, last_per_key, merge_rows, without_documents

RUN = datetime(2024, 1, 1)


def shared_folder(spark: SparkSession) -> str:
    """A new folder beside the session's checkpoints, which all executors can reach."""
    use_checkpoints(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/leafmill-{uuid.uuid4().hex}"


def _chunk_columns(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "chunk_id", "document_name", F.col("chunk_index").cast("bigint").alias("chunk_index"),
        F.col("page_number").cast("bigint").alias("page_number"), "section_title", "chunk_text",
        F.col("word_count").cast("bigint").alias("word_count"),
        F.col("char_count").cast("bigint").alias("char_count"),
        "has_table", "has_image", "has_code",
        F.array_join("element_types", ",").alias("element_types"),
    )


def _line_chunks(spark, folder):
    return chunk_elements(L.line_elements(C.texts(spark, folder, "documents")), 64, 8)


def _turn_chunks(spark, folder):
    return chunk_elements(L.turn_elements(C.texts(spark, folder, "conversations")), 40, 5)


def chunk_lines(spark, folder):
    return _chunk_columns(_line_chunks(spark, folder))


def chunk_turns(spark, folder):
    return _chunk_columns(_turn_chunks(spark, folder))


def chunk_pages(spark, folder):
    return _chunk_columns(chunk_elements(L.page_elements(C.texts(spark, folder, "pages")), 30, 0))


def _source_lines(spark, folder):
    """All lines of a source as one long document, with labels after their look."""
    lines = C.texts(spark, folder, "documents").select(
        "source", "doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    ordered = with_ordinal(lines, ["doc_id", "line_no"], ["source"], "pos")
    line, first = F.col("line"), F.col("line_no") == 0
    label = (F.when(first & (F.col("doc_id") % 10 == 0), "section_header")
             .when(line.contains(" | "), "table").when(line.contains("%%%"), "code")
             .when(line.contains("***"), "picture").otherwise("text"))
    return ordered.select(
        F.col("source").alias("document_name"), F.col("pos").cast("int").alias("pos"), label.alias("label"),
        line.alias("text"), (F.floor(F.col("pos") / 10) + 1).cast("int").alias("page_no"))


def chunk_long(spark, folder):
    """Documents of hundreds of elements and more, chunked block by block."""
    return _chunk_columns(chunk_elements(_source_lines(spark, folder), 64, 8))


def _element_columns(elements):
    return elements.select(
        "document_name", F.col("pos").cast("bigint").alias("pos"), "label", "text",
        F.col("page_no").cast("bigint").alias("page_no"))


def page_elements(spark, folder):
    elements = L.page_elements(C.texts(spark, folder, "pages"))
    return _element_columns(elements.filter(X.has_text(F.col("text"))))


def turn_elements(spark, folder):
    return _element_columns(L.turn_elements(C.texts(spark, folder, "conversations")))


def parser_hook(spark, folder):
    """The same elements as ``line_elements``, from a user's parser of binary files."""
    files = C.texts(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("document_name"),
        F.encode("text", "UTF-8").alias("content"))

    def parse(content):
        for at, line in enumerate(content.decode("utf-8").split("\n")):
            yield "text" if at else "title", line, at // 10 + 1

    return _element_columns(L.parsed_elements(files, parse))


def document_types(spark, folder):
    name = F.col("name")
    return C.file_names(spark, folder).select(
        name, X.document_type(name).alias("document_type"), X.file_stem(name).alias("stem"))


def sanitize(spark, folder):
    """Documents with control characters and outer white space worked in, cleaned again."""
    dirty = F.concat(
        F.lit("\x07 \t"), F.replace("text", F.lit("e"), F.lit("\x01e\x1f")), F.lit("\x0c\n\x0b "))
    return C.texts(spark, folder, "documents").select(
        "doc_id", X.sanitize_text(dirty).alias("clean"),
        F.char_length(dirty).cast("bigint").alias("before"))


def file_size(spark, folder):
    steps = F.array(*[F.lit(1024 ** power).cast("bigint") for power in range(4)])
    size = (F.round(F.col("o_totalprice") * 100).cast("bigint")
            * F.element_at(steps, (F.col("o_orderkey") % 4 + 1).cast("int")))
    return C.table(spark, folder, "orders").select(
        "o_orderkey", size.alias("bytes"), X.format_file_size(size).alias("shown"))


def stem_id(spark, folder):
    name = F.concat("source", F.lit("/"), "lang", F.lit("."), "doc_id", F.lit(".txt"))
    page = F.col("doc_id") % 7
    return C.table(spark, folder, "documents").select(
        "doc_id", X.file_stem(name).alias("stem"),
        X.chunk_id(X.file_stem(name), F.col("doc_id")).alias("chunk_id"),
        X.content_id(name, page, F.col("doc_id"), F.col("text")).alias("hash_id"))


def normalize_missing(spark, folder):
    """Chunks without index or id, some without name or page."""
    given = C.table(spark, folder, "documents").select(F.array(F.struct(
        F.col("text").alias("chunk_text"),
        F.nullif(F.col("source"), F.lit("src0")).alias("document_name"),
        F.nullif(F.col("doc_id") % 3, F.lit(0)).cast("int").alias("page_number"),
    )).alias("chunks"))
    return normalize_chunks(given).select(
        "chunk_id", "chunk_text", "document_name",
        F.col("page_number").cast("bigint").alias("page_number"), "section_title",
        F.col("chunk_index").cast("bigint").alias("chunk_index"))


def _tagged(spark, folder):
    return C.order_notes(spark, folder).select(
        "doc_id", E.extract_entities(F.col("text")).alias("entities"))


def entities_long(spark, folder):
    rows = A.entity_rows(_tagged(spark, folder), "doc_id")
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def entity_counts(spark, folder):
    rows = A.entity_rows(_tagged(spark, folder), "doc_id")
    return rows.groupBy("entity_type").agg(
        F.count("*").alias("found"), F.countDistinct("value").alias("different"))


def entity_totals(spark, folder):
    """How many notes have how many entities."""
    count = E.count_entities(F.col("entities")).cast("bigint").alias("entity_count")
    return _tagged(spark, folder).groupBy(count).agg(F.count("*").alias("notes"))


def _rounded(stats):
    return stats.withColumn("avg_length", F.round("avg_length", 4))


def chunk_stats(spark, folder):
    return _rounded(A.chunk_statistics(_line_chunks(spark, folder), ["document_name"]))


def chunk_stats_total(spark, folder):
    return _rounded(A.chunk_statistics(_turn_chunks(spark, folder)))


def hash_embed(spark, folder):
    entries = C.document_index(spark, folder).select(
        F.col("chunk_id").alias("doc_id"), F.posexplode_outer("chunk_embedding").alias("bucket", "weight"))
    return entries.filter("weight != 0").select(
        "doc_id", F.col("bucket").cast("bigint").alias("bucket"),
        F.round(F.col("weight").cast("double"), 4).alias("weight"))


def provider_embed(spark, folder):
    """A stand-in provider: length and number of line breaks of each text."""
    def build():
        return lambda texts: [[float(len(t)), float(t.count("\n"))] for t in texts]

    vector = M.provider_embedding(F.col("text"), "length-and-lines", build)
    return C.texts(spark, folder, "documents").select("doc_id", vector.alias("v")).select(
        "doc_id", F.col("v")[0].cast("bigint").alias("length"),
        F.col("v")[1].cast("bigint").alias("breaks"))


def dim_check(spark, folder):
    vector = F.col("embedding")
    return C.table(spark, folder, "embeddings").groupBy("label").agg(
        V.dimensions_agree(vector, 64).alias("agree"),
        V.dimensions_agree(vector, 65).alias("agree_65"),
        F.count_if(V.is_nonzero(vector)).alias("nonzero"))


def attach_vectors(spark, folder):
    """Every document with the vector whose number its own gives, counted round."""
    vectors = C.table(spark, folder, "embeddings").select(F.col("vec_id").alias("vector_no"), "embedding")
    documents = C.table(spark, folder, "documents").withColumn(
        "vector_no", F.col("doc_id") % F.lit(vectors.count()))
    joined = M.attach_vectors(documents, vectors, ["vector_no"], "embedding")
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return joined.select("doc_id", "lang", F.round(total, 5).alias("total"))


def postings(spark, folder):
    listed = R.postings(C.document_index(spark, folder))
    return listed.groupBy("term").agg(
        F.count("*").alias("documents"), F.sum("frequency").alias("occurrences"))


def _hits(hits):
    return hits.select(
        F.col("query_id").cast("bigint").alias("query_id"), "chunk_id",
        F.round("score", 6).alias("score"), F.col("rank").cast("bigint").alias("rank"))


def bm25_topk(spark, folder):
    return _hits(R.search_text(
        C.document_index(spark, folder), C.benchmark_queries(spark, folder), 10))


def bm25_filtered(spark, folder):
    return _hits(R.search_text(
        C.document_index(spark, folder), C.benchmark_queries(spark, folder), 10, {"lang": "en"}))


def knn_topk(spark, folder):
    return _hits(R.search_vector(C.vector_index(spark, folder), C.label_queries(spark, folder), 10))


def knn_filtered(spark, folder):
    return _hits(R.search_vector(
        C.vector_index(spark, folder), C.label_queries(spark, folder), 10, {"label": 3}))


def knn_min_score(spark, folder):
    return _hits(R.search_vector(
        C.vector_index(spark, folder), C.label_queries(spark, folder), 10, min_score=0.7))


def knn_approximate(spark, folder):
    return _hits(search_approximate(
        C.vector_index(spark, folder), C.label_queries(spark, folder), 64, bits=6, radius=1))


def _ivf_hits(spark, folder):
    index = C.vector_index(spark, folder)
    return ivf.search_ivf(index, C.label_queries(spark, folder), ivf.fit_cells(index), probes=ivf.PROBES, k=10)


def knn_ivf(spark, folder):
    """Ten nearest rows of each label's mean in its 24 nearest of 64 fitted cells."""
    return _hits(_ivf_hits(spark, folder))


def knn_ivf_recall(spark, folder):
    """Per query: the share of the exact ten nearest rows that the cell search finds, and the share of
    usable rows it reads."""
    index = C.vector_index(spark, folder)
    centroids = ivf.fit_cells(index)
    queries = C.label_queries(spark, folder)
    found = ivf.search_ivf(index, queries, centroids, probes=ivf.PROBES, k=10).select("query_id", "chunk_id")
    exact = R.search_vector(index, queries, 10).select("query_id", "chunk_id")
    hit = exact.join(found.withColumn("hit", F.lit(1)), ["query_id", "chunk_id"], "left")
    recall = hit.groupBy("query_id").agg((F.count("hit") / F.count("*")).alias("recall"))
    cells = ivf.with_cells(index, centroids).filter(F.col("cell").isNotNull())
    q = queries.select("query_id", F.col("query_vector").cast("array<double>").alias("v")).collect()
    probed = ivf.probe_order(np.array([r["v"] for r in q], float), centroids, ivf.PROBES) if q else []
    per = spark.createDataFrame([(r["query_id"], int(c)) for r, cs in zip(q, probed) for c in cs],
                                "query_id long, cell int")
    sizes = cells.groupBy("cell").count()
    total = cells.count()
    read = per.join(sizes, "cell").groupBy("query_id").agg((F.sum("count") / F.lit(total)).alias("read_share"))
    return recall.join(read, "query_id").select(
        F.col("query_id").cast("bigint").alias("query_id"), F.round("recall", 6).alias("recall"),
        F.round("read_share", 6).alias("read_share"))


def hybrid_topk(spark, folder):
    queries = M.embed_queries(C.benchmark_queries(spark, folder))
    return _hits(R.search_hybrid(C.document_index(spark, folder), queries, 10, 0.4, 0.6))


def search_with_source(spark, folder):
    """Keyword hits of the chunk table built from the conversations, with their rows."""
    index = _turn_chunks(spark, folder)
    hits = R.search_text(index, C.benchmark_queries(spark, folder), 3)
    return R.with_source(hits, index).select(
        "query_id", "chunk_id", F.round("score", 6).alias("score"),
        F.col("rank").cast("bigint").alias("rank"), "document_name", "section_title")


def upsert_latest(spark, folder):
    """The latest finished or open order of each customer, replaced by open or pending ones."""
    orders = C.table(spark, folder, "orders").select(
        F.col("o_custkey").cast("string").alias("chunk_id"), "o_orderkey", "o_orderdate",
        "o_orderstatus", "o_totalprice")

    def batch(*statuses):
        rows = orders.filter(F.col("o_orderstatus").isin(*statuses))
        return last_per_key(rows, "chunk_id", ["o_orderdate", "o_orderkey"])

    return merge_rows(batch("F", "O"), batch("O", "P"))


def delete_document(spark, folder):
    toxic = C.table(spark, folder, "labels").filter("toxic = 1").select(
        F.col("doc_id").cast("string").alias("document_name"))
    return without_documents(_line_chunks(spark, folder), toxic).groupBy("document_name").agg(
        F.count("*").alias("chunks"))


def resume_skip(spark, folder):
    documents = C.table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("document_name"), "lang", "n_chars")
    manifest = C.table(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("document_name"),
        F.when(F.col("quality") == 1, "success").otherwise("partial").alias("status"))
    return runs.pending_documents(documents, manifest)


def merge_metadata(spark, folder):
    base = F.create_map(
        F.lit("kind"), "event_type", F.lit("user"), F.col("user_id").cast("string"),
        F.lit("props"), "props")
    extra = F.create_map(
        F.lit("kind"), F.nullif(F.upper("event_type"), F.lit("ERROR")),
        F.concat(F.lit("user"), F.when(F.col("user_id") % 2 == 0, "").otherwise("_id")),
        F.lit("changed"))
    return C.table(spark, folder, "events").select(
        "event_id", F.explode(X.merge_metadata(base, extra)).alias("key", "value"))


def batch_ids(spark, folder):
    documents = C.table(spark, folder, "documents").select("doc_id", "source")
    return with_batch(documents, ["doc_id"], 7, ["source"])


def batch_sizes(spark, folder):
    """The whole table in batches of 500."""
    batches = with_batch(C.table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"], 500)
    return batches.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.min("o_orderkey").alias("first"),
        F.max("o_orderkey").alias("last"))


def ingest_conversations(spark, folder):
    """The whole chain into a new store, run twice as after a lost commit, then read back."""
    work = shared_folder(spark)
    store = ChunkStore(spark, f"{work}/index", buckets=8)
    elements = L.turn_elements(C.texts(spark, folder, "conversations"))
    settings = Settings(size=40, overlap=5, id_mode="stem")
    for batch in ("first", "second"):
        ingest_elements(elements, store, work, batch, RUN, settings)
    return _chunk_columns(store.read())


def index_stats(spark, folder):
    """Row count of a store filled from the conversations."""
    work = shared_folder(spark)
    store = ChunkStore(spark, f"{work}/index", buckets=8)
    store.upsert(_turn_chunks(spark, folder))
    return store.stats().select("index_name", "document_count")


def json_roundtrip(spark, folder):
    """Chunks written as JSON and read with the fixed schema."""
    path = f"{shared_folder(spark)}/chunks"
    _turn_chunks(spark, folder).write.json(path)
    given = S.read_chunk_json(spark, path, multi_line=False)
    return _chunk_columns(normalize_chunks(given, number_missing=False))


def _turn_rows(turns):
    """Turns as ready chunks, one each."""
    rows = turns.select(
        F.concat_ws("_chunk_", F.col("conv_id").cast("string"), F.format_string("%04d", "turn")).alias("chunk_id"),
        F.col("conv_id").cast("string").alias("document_name"), F.col("text").alias("chunk_text"),
        F.col("turn").cast("int").alias("chunk_index"), F.lit(RUN).alias("processed_at"))
    return schema.conform(rows, schema.CHUNKS)


def _led(turns):
    """Conversations that a system turn leads."""
    return turns.filter("role = 'system'").select("conv_id").distinct()


def _stored_turns(spark, folder):
    """A store of all turns; the turns."""
    turns = C.table(spark, folder, "conversations")
    store = ChunkStore(spark, f"{shared_folder(spark)}/index", buckets=8)
    store.upsert(_turn_rows(turns), replace_document=True)
    return store, turns


def _store_rows(store):
    return store.read().select("chunk_id", "document_name", "chunk_text", F.col("chunk_index").cast("bigint").alias("chunk_index"))


def store_upsert_replace(spark, folder):
    """All turns; then led conversations again without their user turns, and those of one turn emptied."""
    store, turns = _stored_turns(spark, folder)
    again = turns.join(_led(turns), "conv_id", "left_semi").filter("role != 'user'")
    single = turns.groupBy("conv_id").count().filter("count = 1").select("conv_id")
    names = _led(turns).unionByName(single).distinct().select(F.col("conv_id").cast("string").alias("document_name"))
    changed = _turn_rows(again.withColumn("text", F.concat("text", F.lit(" again"))))
    store.upsert(changed.join(names, "document_name", "left_semi").select(*changed.columns), replace_document=True, documents=names)
    return _store_rows(store)


def store_delete(spark, folder):
    """All turns but those of led conversations."""
    store, turns = _stored_turns(spark, folder)
    store.delete_documents(_led(turns).select(F.col("conv_id").cast("string").alias("document_name")))
    return _store_rows(store)


def store_counts(spark, folder):
    """Rows of the store before, with all turns, and after a deletion."""
    store, turns = _stored_turns(spark, folder)
    counts = [("before", 0), ("filled", store.stats().first().document_count)]
    store.delete_documents(_led(turns).select(F.col("conv_id").cast("string").alias("document_name")))
    counts.append(("deleted", store.stats().first().document_count))
    return spark.createDataFrame(counts, "state string, document_count bigint")


def run_manifest(spark, folder):
    """What a batch that ran twice leaves in the manifest."""
    work = shared_folder(spark)
    store = ChunkStore(spark, f"{work}/index", buckets=8)
    elements = L.turn_elements(C.texts(spark, folder, "conversations"))
    for _ in range(2):
        ingest_elements(elements, store, work, "only", RUN, Settings(size=40, overlap=5, id_mode="stem"))
    return runs.read_manifest(spark, f"{work}/manifest").select(
        "batch_id", "document_name", "status", F.col("n_chunks").cast("bigint").alias("n_chunks"))


def zero_vectors(spark, folder):
    """Embeddings, those of label 3 zeroed: how many are valid, by label."""
    rows = C.table(spark, folder, "embeddings").withColumn("embedding", F.when(
        F.col("label") == 3, F.transform("embedding", lambda x: x * F.lit(0).cast("float"))).otherwise(F.col("embedding")))
    return rows.groupBy("label").agg(
        F.count_if(V.is_nonzero(F.col("embedding"))).alias("nonzero"),
        F.count_if(M.valid_vector(64, "embedding")).alias("valid"), F.count("*").alias("vectors"))


def knn_many(spark, folder):
    """Every embedding as a query, in more blocks than one."""
    index = C.vector_index(spark, folder)
    queries = index.select(F.col("chunk_id").alias("query_id"), F.col("chunk_embedding").alias("query_vector"))
    return _hits(R.search_vector(index, queries, 3, query_cells=1 << 14))


def binary_scan(spark, folder):
    """The table files themselves, read whole, block by block."""
    return S.digests(S.require_content(S.read_files(spark, folder, "*.parquet", blocks=True)))


QUERIES = {
    f.__name__: f for f in (
        chunk_lines, chunk_turns, chunk_pages, page_elements, turn_elements, parser_hook,
        document_types, sanitize, file_size, stem_id, normalize_missing, entities_long,
        entity_counts, entity_totals, chunk_stats, chunk_stats_total, hash_embed, provider_embed,
        dim_check, attach_vectors, postings, bm25_topk, bm25_filtered, knn_topk, knn_filtered,
        knn_min_score, knn_approximate, knn_ivf, knn_ivf_recall, hybrid_topk, search_with_source, upsert_latest,
        delete_document, resume_skip, merge_metadata, batch_ids, batch_sizes,
        ingest_conversations, index_stats, json_roundtrip, binary_scan, chunk_long,
        store_upsert_replace, store_delete, store_counts, run_manifest, zero_vectors, knn_many,
    )
}
