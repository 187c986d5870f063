from datetime import datetime

import pytest
from pyspark.sql import functions as F

from leafmill import schema
from leafmill.operators.ordinals import with_batch, with_ordinal
from leafmill.operators.normalize import normalize_chunks
from leafmill.operators.stats import chunk_statistics, counted, entity_rows
from leafmill.sources.store import ChunkStore, last_per_key, write_partitions


def chunks(spark, rows, minute=0):
    df = spark.createDataFrame(rows, "chunk_id string, document_name string, chunk_text string")
    return schema.conform(
        df.withColumn("processed_at", F.lit(datetime(2024, 1, 1, 0, minute))), schema.CHUNKS)


def contents(store):
    return sorted((r.chunk_id, r.chunk_text) for r in store.read().collect())


def test_store_life_cycle(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "index"), buckets=4)
    assert not store.exists() and not store.drop()
    assert store.create() and not store.create()
    assert store.read().count() == 0 and store.read().schema == schema.CHUNKS
    assert store.stats().first().document_count == 0

    first = [(f"d{d}_chunk_{i:04d}", f"d{d}.txt", f"old {d} {i}") for d in range(6) for i in range(3)]
    store.upsert(chunks(spark, first))
    store.upsert(chunks(spark, first))  # once or twice is the same
    assert contents(store) == sorted((r[0], r[2]) for r in first)

    second = [("d1_chunk_0001", "d1.txt", "new"), ("e_chunk_0000", "e.txt", "new")]
    store.upsert(chunks(spark, second))
    expected = {r[0]: r[2] for r in first} | {r[0]: r[2] for r in second}
    assert contents(store) == sorted(expected.items())
    row = store.stats().first()
    assert row.index_name == "index" and row.document_count == 19 and row.size_in_bytes > 0

    # Fewer chunks for a document, under another kind of id.
    store.upsert(chunks(spark, [("0123abcd", "d2.txt", "only")]), replace_document=True)
    expected = {k: v for k, v in expected.items() if not k.startswith("d2_")} | {"0123abcd": "only"}
    assert contents(store) == sorted(expected.items())

    store.delete_documents(spark.createDataFrame([("d1.txt",), ("e.txt",), ("none",)], "document_name string"))
    expected = {k: v for k, v in expected.items() if not k.startswith(("d1_", "e_"))}
    assert contents(store) == sorted(expected.items())

    # What an unfinished write leaves behind is not read.
    chunks(spark, first).write.parquet(str(tmp_path / "index/data/version=99/bucket=0"))
    assert contents(store) == sorted(expected.items())
    store.remove_superseded()
    assert contents(store) == sorted(expected.items())
    store.delete_documents(spark.createDataFrame([(f"d{d}.txt",) for d in range(6)], "document_name string"))
    assert contents(store) == []
    assert store.drop() and not store.exists()


def test_a_small_batch_rewrites_few_buckets(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "index"), buckets=32)
    store.upsert(chunks(spark, [(f"d{d}_chunk_0000", f"d{d}", "x") for d in range(100)]))
    before = store._current()
    version = store.upsert(chunks(spark, [("d7_chunk_0000", "d7", "y")]))
    after = store._current()
    assert sum(v == [version] for v in after.values()) == 1
    assert sum(before[b] == after[b] for b in before) == len(before) - 1


def test_new_rows_are_appended(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "index"), buckets=8)
    old = spark.range(2000).select(
        F.format_string("d%d_chunk_0000", "id").alias("chunk_id"), F.concat(F.lit("d"), "id").alias("document_name"), F.lit("x").alias("chunk_text"))
    store.upsert(schema.conform(old, schema.CHUNKS), replace_document=True)
    version = store.upsert(chunks(spark, [(f"e{d}_chunk_0000", f"e{d}", "y") for d in range(300)]), replace_document=True)
    assert spark.read.parquet(f"{tmp_path}/index/data/version={version}").count() == 300
    assert store.read().count() == 2300
    assert max(map(len, store._current().values())) == 2
    store.compact(1)
    assert store.read().count() == 2300 and max(map(len, store._current().values())) == 1


def test_the_number_of_buckets_is_kept(spark, tmp_path):
    path = str(tmp_path / "index")
    ChunkStore(spark, path, buckets=4).upsert(chunks(spark, [("a_chunk_0000", "a", "x")]))
    with pytest.raises(ValueError, match="4 buckets"):
        ChunkStore(spark, path, buckets=8)
    assert ChunkStore(spark, path).buckets == 4


def test_documents_without_chunks_lose_theirs(spark, tmp_path):
    store = ChunkStore(spark, str(tmp_path / "index"), buckets=4)
    store.upsert(chunks(spark, [("a_chunk_0000", "a", "x"), ("b_chunk_0000", "b", "x")]))
    names = spark.createDataFrame([("a",)], "document_name string")
    store.upsert(chunks(spark, [("c_chunk_0000", "c", "x")]).limit(0), replace_document=True, documents=names)
    assert contents(store) == [("b_chunk_0000", "x")]


def test_last_row_of_a_key_wins(spark):
    early = chunks(spark, [("a", "a", "1"), ("b", "b", "1")])
    late = chunks(spark, [("a", "a", "2")] * 50, minute=5)
    rows = last_per_key(late.union(early)).select("chunk_id", "chunk_text").collect()
    assert sorted(map(tuple, rows)) == [("a", "2"), ("b", "1")]


def test_outside_writer(spark, tmp_path):
    folder = str(tmp_path)

    def write(batch):
        import uuid
        from pathlib import Path

        assert len(batch) <= 3
        Path(folder, uuid.uuid4().hex).write_text("\n".join(r["chunk_id"] for r in batch))

    write_partitions(chunks(spark, [(str(i), "d", "x") for i in range(20)]), write, 3)
    seen = sorted(int(x) for p in tmp_path.iterdir() for x in p.read_text().split())
    assert seen == list(range(20))


@pytest.mark.parametrize("slices", [1, 5])
def test_ordinals(spark, slices):
    rows = [("hot" if i % 3 else f"k{i % 4}", i * 7 % 50) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, v int")
    expected = {}
    for k, v in sorted(rows):
        expected.setdefault(k, []).append(v)
    found = {}
    for r in with_ordinal(df, ["v"], ["k"], "n", slices).collect():
        found.setdefault(r.k, []).append((r.n, r.v))
    for k, vs in expected.items():
        assert sorted(found[k]) == list(enumerate(vs))
    whole = with_ordinal(df, ["k", "v"], name="n", slices=slices).orderBy("n").collect()
    assert [(r.k, r.v) for r in whole] == sorted(rows)
    assert [r.n for r in whole] == list(range(300))


def test_ordinals_with_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 1)], "k string, v int")
    rows = sorted(with_ordinal(df, ["v"], ["k"], "n").collect(), key=str)
    assert sorted((str(r.k), r.v, r.n) for r in rows) == [("None", 1, 0), ("None", 2, 1), ("a", 1, 0)]


def test_batches(spark):
    df = spark.range(23).withColumnRenamed("id", "v")
    sizes = with_batch(df, ["v"], 10, slices=4).groupBy("batch_id").agg(
        F.count("*"), F.min("v"), F.max("v")).orderBy("batch_id").collect()
    assert [tuple(r) for r in sizes] == [(0, 10, 0, 9), (1, 10, 10, 19), (2, 3, 20, 22)]
    with pytest.raises(ValueError):
        with_batch(df, ["v"], 0)


def test_normalize(spark):
    import hashlib

    inner = "chunk_text string, document_name string, page_number int, chunk_id string"
    df = spark.createDataFrame([
        ([("b", "d", 1, ""), ("a", "d", 1, None), ("c", None, None, "given")],), ([],), (None,)],
        f"chunks array<struct<{inner.replace(' ', ':').replace(',:', ',')}>>")
    rows = normalize_chunks(df).orderBy("chunk_text").collect()
    assert normalize_chunks(df).schema.simpleString() == schema.CHUNKS.simpleString()
    assert [(r.document_name, r.page_number, r.section_title, r.chunk_index) for r in rows] == [
        ("d", 1, "Unknown", 0), ("d", 1, "Unknown", 1), ("unknown", 1, "Unknown", 0)]
    assert [r.chunk_id for r in rows] == [
        hashlib.md5(b"d|1|0|a").hexdigest(), hashlib.md5(b"d|1|1|b").hexdigest(), "given"]


def test_statistics(spark):
    df = spark.createDataFrame([("ab", "x"), ("abcd", "x")], "chunk_text string, d string")
    assert tuple(chunk_statistics(df).first()) == (2, 3.0, 2, 4, 6)
    assert tuple(chunk_statistics(df.filter("false")).first()) == (0, 0.0, 0, 0, 0)
    assert tuple(chunk_statistics(df, ["d"]).first()) == ("x", 2, 3.0, 2, 4, 6)


def test_counted(spark):
    df, seen = counted(spark.range(10), "n", even=F.col("id") % 2 == 0)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 10, "even": 5}


def test_entity_rows(spark):
    df = spark.createDataFrame([("c", {"DATE": ["x", "y"]})], "chunk_id string, entities map<string,array<string>>")
    assert [tuple(r) for r in entity_rows(df).collect()] == [("c", "DATE", 0, "x"), ("c", "DATE", 1, "y")]
