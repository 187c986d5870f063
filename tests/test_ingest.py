import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from chunk_model import chunk
from leafmill.operators.embedding import (
    attach_vectors, embed_chunks, provider_embedding, require_vectors,
)
from leafmill.operators.search import search_hybrid, with_source
from leafmill.operators.embedding import embed_queries
from leafmill.plans.ingest import Settings, index_chunk_files, ingest_elements, ingest_files
from leafmill.sources import elements as L, files as S, runs
from leafmill.sources.store import ChunkStore
from leafmill.streaming.incremental import ingest_new_files

RUN = datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture
def folder(tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.txt").write_text("Title\nAcme Ltd\tmet in Paris\n\n5% on 1/2/2024\n")
    (root / "sub" / "a.txt").write_text("Other\nfox fox fox\x07")
    (root / "b.md").write_text("# Guide\nIntro line\n## Use\n```py\nx = 1\n```\n| a | b |\n- item\n![i](p)\n")
    (root / "c.html").write_text("<title>T</title><nav>no</nav><h1 id=x>H</h1><p>one <b>two</b></p><li>x</li>")
    (root / "empty.txt").write_text("")
    return root


def place(tmp_path, spark):
    return ChunkStore(spark, str(tmp_path / "index"), buckets=4), str(tmp_path / "work")


def test_markdown_and_html(spark, folder):
    files = S.read_files(spark, str(folder))
    rows = L.to_elements(files).orderBy("document_name", "pos").collect()
    found = {}
    for r in rows:
        found.setdefault(r.document_name, []).append((r.label, r.text))
    assert found["b.md"] == [
        ("title", "Guide"), ("text", "Intro line"), ("section_header", "Use"), ("code", "x = 1"),
        ("table", "| a | b |"), ("list_item", "- item"), ("picture", "![i](p)")]
    assert found["c.html"] == [
        ("title", "T"), ("section_header", "H"), ("text", "one two"), ("list_item", "x")]


def test_ingest_files(spark, folder, tmp_path):
    store, work = place(tmp_path, spark)
    settings = Settings(size=6, overlap=2, dimension=16)
    result = ingest_files(spark, str(folder), store, work, "b1", RUN, settings)
    rows = store.read().orderBy("chunk_id").collect()
    assert result.status == "success" and result.chunks == result.indexed == len(rows)
    names = {r.document_name for r in rows}
    assert names == {"a.txt", "sub/a.txt", "b.md", "c.html"}
    assert {r.chunk_id for r in rows if r.chunk_index == 0} == {
        "a_chunk_0000", "sub/a_chunk_0000", "b_chunk_0000", "c_chunk_0000"}
    expected = chunk([("title", "Title", 1), ("text", "Acme Ltd\tmet in Paris", 1),
                      ("text", "5% on 1/2/2024", 1)], 6, 2)
    assert [r.chunk_text for r in rows if r.document_name == "a.txt"] == [c[0] for c in expected]
    first = next(r for r in rows if r.chunk_id == "a_chunk_0000")
    assert first.entities == {"ORGANIZATION": ["Title Acme Ltd"], "LOCATION": ["Paris"]}
    assert first.entity_count == 2 and first.processed_at == RUN and len(first.chunk_embedding) == 16
    assert next(r for r in rows if r.document_name == "sub/a.txt").chunk_text == "Other fox fox fox"
    flags = [(r.has_code, r.has_table, r.has_image) for r in rows if r.document_name == "b.md"]
    assert (True, True, True) == tuple(map(any, zip(*flags)))

    # Again, and with a shorter file.
    (folder / "a.txt").write_text("Short")
    ingest_files(spark, str(folder), store, work, "b2", RUN, settings)
    assert [r.chunk_text for r in store.read().filter("document_name = 'a.txt'").collect()] == ["Short"]
    manifest = runs.read_manifest(spark, f"{work}/manifest", "b1").collect()
    assert {r.document_name for r in manifest} == names

    # Only what is not recorded yet.
    (folder / "new.txt").write_text("New one")
    again = ingest_files(spark, str(folder), store, work, "b3", RUN, settings, resume=True)
    assert again.indexed == 1
    log = spark.read.json(f"{work}/run_log").filter("label = 'success'")
    assert log.filter("line like 'status%'").count() == 3

    queries = embed_queries(
        spark.createDataFrame([(1, "fox")], "query_id int, query_text string"),
        settings.embed)
    hits = with_source(search_hybrid(store.read(), queries, 3), store.read())
    assert hits.orderBy("rank").first().document_name == "sub/a.txt"


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    store, work = place(tmp_path, spark)
    assert ingest_files(spark, str(tmp_path / "in"), store, work, "b", RUN, pattern="*.txt").status == "empty"
    assert spark.read.json(f"{work}/run_log").first().line == "no files"


def test_unknown_types(spark, folder, tmp_path):
    (folder / "x.bin").write_bytes(b"a b;c")
    store, work = place(tmp_path, spark)
    with pytest.raises(ValueError, match="x.bin"):
        ingest_files(spark, str(folder), store, work, "b", RUN)
    ingest_files(spark, str(folder), store, work, "b", RUN, Settings(on_error="quarantine"))
    assert [r.document_name for r in spark.read.json(f"{work}/rejected_files").collect()] == ["x.bin"]

    def parser(content):
        for page, text in enumerate(content.decode().split(";"), 1):
            yield "text", text, page

    settings = Settings(parsers={"unknown": parser}, id_mode="stem")
    assert ingest_files(spark, str(folder), store, work, "c", RUN, settings, pattern="*.bin").indexed == 1
    row = store.read().filter("document_name = 'x.bin'").first()
    assert (row.chunk_text, row.page_number) == ("a b c", 2)

    def broken(content):
        raise KeyError("nope")

    with pytest.raises(Exception, match="cannot parse x.bin"):
        ingest_files(spark, str(folder), store, work, "d", RUN, Settings(parsers={"unknown": broken}),
                     pattern="*.bin")


def test_quarantine(spark, folder, tmp_path):
    store, work = place(tmp_path, spark)

    def embed(text):
        return F.when(text.contains("fox"), F.array(F.lit(0.0), F.lit(0.0))).otherwise(
            F.array(F.lit(1.0), F.lit(0.0))).cast("array<float>")

    bad = Settings(embedding=embed, dimension=2, on_error="quarantine")
    result = ingest_files(spark, str(folder), store, work, "b", RUN, bad)
    assert (result.status, result.quarantined) == ("partial", 1)
    assert spark.read.parquet(f"{work}/quarantine").first().document_name == "sub/a.txt"
    assert "sub/a.txt" not in {r.document_name for r in runs.read_manifest(spark, f"{work}/manifest").collect()}
    with pytest.raises(Exception, match="bad vector: sub/a_chunk_0000"):
        ingest_files(spark, str(folder), store, work, "c", RUN, Settings(embedding=embed, dimension=2))


def test_chunk_json(spark, tmp_path):
    given = [
        {"chunk_text": "five fox", "document_name": "d", "page_number": 2, "chunk_index": 4,
         "chunk_id": "d_chunk_0004", "chunk_embedding": [1.0, 0.0], "entities": {"DATE": ["x"]}},
        {"chunk_text": "no id", "chunk_embedding": [0.0, 1.0]},
    ]
    (tmp_path / "json").mkdir()
    (tmp_path / "json" / "one.json").write_text(json.dumps(given, indent=1))
    (tmp_path / "json" / "skip.txt").write_text("not json")
    store, work = place(tmp_path, spark)
    result = index_chunk_files(spark, str(tmp_path / "json"), store, work, "j", RUN, Settings(dimension=2))
    assert (result.status, result.indexed) == ("success", 2)
    rows = {r.document_name: r for r in store.read().collect()}
    assert rows["d"].entities == {"DATE": ["x"]} and rows["d"].chunk_index == 4
    assert (rows["unknown"].page_number, rows["unknown"].chunk_index) == (1, 0)
    assert len(rows["unknown"].chunk_id) == 32


def test_provider(spark):
    df = spark.range(23).select(F.col("id"), F.concat(F.lit("t"), "id").alias("chunk_text"))
    df = df.coalesce(1)

    def build():
        def provider(texts):
            assert len(texts) <= 10
            return [[float(t[1:]), float(len(texts))] for t in texts]
        return provider

    rows = embed_chunks(df, lambda t: provider_embedding(t, "k1", build)).orderBy("id").collect()
    assert [r.chunk_embedding[0] for r in rows] == [float(i) for i in range(23)]
    assert [r.chunk_embedding[1] for r in rows] == [10.0] * 20 + [3.0] * 3

    with pytest.raises(Exception, match="10 texts gave 9 vectors"):
        embed_chunks(df, lambda t: provider_embedding(t, "k2", lambda: lambda ts: [[1.0]] * 9)).collect()


def test_attach_vectors(spark):
    df = spark.createDataFrame([("d", 0), ("d", 1)], "document_name string, chunk_index int")
    both = df.withColumn("chunk_embedding", F.array(F.col("chunk_index").cast("float")))
    assert attach_vectors(df, both).count() == 2
    with pytest.raises(Exception, match="no vector for d 1"):
        attach_vectors(df, both.filter("chunk_index = 0")).collect()
    with pytest.raises(Exception, match="bad vector: c"):
        require_vectors(both.withColumn("chunk_id", F.lit("c")), 2).collect()


def test_stream(spark, folder, tmp_path):
    store, work = place(tmp_path, spark)
    settings = Settings(size=6, overlap=2, dimension=16)
    ingest_new_files(spark, str(folder), store, work, settings, "*.txt", 1).awaitTermination()
    first = {r.chunk_id for r in store.read().collect()}
    assert {r.document_name for r in store.read().collect()} == {"a.txt", "sub/a.txt"}
    (folder / "later.txt").write_text("Later text")
    ingest_new_files(spark, str(folder), store, work, settings, "*.txt", 5).awaitTermination()
    assert {r.chunk_id for r in store.read().collect()} == first | {"later_chunk_0000"}


def test_emptied_document_and_rerun(spark, tmp_path):
    store, work = place(tmp_path, spark)
    columns = "document_name string, pos int, label string, text string, page_no int"

    def run(rows, batch):
        return ingest_elements(spark.createDataFrame(rows, columns), store, work, batch, RUN, Settings(size=3))

    run([("a", 0, "text", "one two three four", 1), ("b", 0, "text", "five six", 1)], "b1")
    run([("a", 0, "text", "  ", 1)], "b2")
    run([("a", 0, "text", "  ", 1)], "b2")
    assert {r.document_name for r in store.read().collect()} == {"b"}
    rows = runs.read_manifest(spark, f"{work}/manifest").orderBy("batch_id", "document_name").collect()
    assert [(r.batch_id, r.document_name, r.status, r.n_chunks) for r in rows] == [
        ("b1", "a", "success", 2), ("b1", "b", "success", 1), ("b2", "a", "success", 0)]


def test_one_provider_per_worker_process(spark, tmp_path):
    import os
    import uuid

    folder, key = str(tmp_path), str(uuid.uuid4())

    def build():
        with open(f"{folder}/{os.getpid()}-{uuid.uuid4()}", "w"):
            pass
        return lambda texts: [[float(os.getpid())] for _ in texts]

    vector = provider_embedding(F.col("text"), key, build)
    rows = spark.range(0, 1200, 1, 12).select(F.col("id").cast("string").alias("text"))
    pids = {r[0] for r in rows.select(vector.getItem(0)).collect()}
    assert len(os.listdir(folder)) == len(pids)


def test_attach_vectors_wants_one(spark):
    chunks = spark.createDataFrame([("a", 0)], "document_name string, chunk_index int")
    two = spark.createDataFrame([("a", 0, [1.0]), ("a", 0, [2.0])], "document_name string, chunk_index int, chunk_embedding array<float>")
    with pytest.raises(Exception, match="several vectors"):
        attach_vectors(chunks, two).collect()


def test_html_tags(spark):
    html = ("<head><link rel='x'><title>T</title></head><H1 class='a'>Head</H1><h3>Sub</h3><pre>code</pre><p>one</p>"
            "<picture></picture><table><tr><td>1</td></tr></table><img src='x' alt=\"A cat\"><ul><li>item</li></ul>")
    found = L.page_elements(spark.createDataFrame([(1, html)], "page_id long, html string")).orderBy("pos")
    assert [(r.label, r.text) for r in found.collect()] == [
        ("title", "T"), ("section_header", "Head"), ("section_header", "Sub"), ("code", "code"), ("text", "one"),
        ("table", "1"), ("picture", "A cat"), ("list_item", "item")]
