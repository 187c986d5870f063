import random

import pytest
from chunk_model import chunk

from leafmill.operators.chunking import chunk_elements
from leafmill.schema import ELEMENTS

GOLDEN = {
    "A": (5, 2, [("title", "Intro", 1), ("text", "a b c", 1), ("text", "d e f g", 2),
                 ("section_header", "Methods", 2), ("text", "h", 3)],
          [(0, "Intro a b c d e f g", 2, "Intro", 8), (1, "f g", 2, "Intro", 2),
           (2, "Methods h", 3, "Methods", 2)]),
    "B": (3, 50, [("text", "a b", None), ("text", "c d", None), ("text", "e f", None)],
          [(0, "a b c d", 1, "Unknown", 4), (1, "c d e f", 1, "Unknown", 4),
           (2, "e f", 1, "Unknown", 2)]),
    "C": (3, 0, [("text", "a b c d e f", 4), ("text", "   ", 9), ("text", "g", None)],
          [(0, "a b c d e f", 4, "Unknown", 6), (1, "g", 4, "Unknown", 1)]),
    "D": (10, 2, [("section_header", "H1", 1), ("title", "H2", 2), ("text", "x  y", 2)],
          [(0, "H1", 1, "H1", 1), (1, "H2 x  y", 2, "H2", 3)]),
    "F": (4, 1, [("text", "p q r s", 1), ("section_header", "S", 2)],
          [(0, "p q r s", 1, "Unknown", 4), (1, "s", 1, "Unknown", 1), (2, "S", 2, "S", 1)]),
}


def frame(spark, documents):
    rows = [(name, pos, *e) for name, es in documents.items() for pos, e in enumerate(es)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, ELEMENTS)


def chunks_of(df):
    rows = df.select("document_name", "chunk_index", "chunk_text", "page_number", "section_title",
                     "element_types").collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r[0], r[1])):
        found.setdefault(r[0], []).append((r[1], *r[2:]))
    return found


@pytest.mark.parametrize("case", GOLDEN)
@pytest.mark.parametrize("span", [1, 256])
def test_golden(spark, case, span):
    size, overlap, elements, expected = GOLDEN[case]
    df = chunk_elements(frame(spark, {"x.pdf": elements}), size, overlap, span=span)
    rows = df.orderBy("chunk_index").select(
        "chunk_index", "chunk_text", "page_number", "section_title", "word_count")
    assert [tuple(r) for r in rows.collect()] == expected


def test_empty_document(spark):
    assert chunk_elements(spark.createDataFrame([], ELEMENTS), 5, 1).count() == 0


def random_documents(seed, n=40, length=40):
    rng = random.Random(seed)
    labels = ["text"] * 6 + ["section_header", "title", "table", "code", "figure"]
    documents = {}
    for d in range(n):
        elements = []
        for _ in range(rng.randint(1, length)):
            text = rng.choice([" ", "\t", "  "]).join(
                rng.choice(["a", "bb", "é", " x", "-"]) for _ in range(rng.randint(0, 9)))
            elements.append((rng.choice(labels), rng.choice(["", " "]) + text,
                             rng.choice([None, rng.randint(1, 9)])))
        documents[f"d{d}.txt"] = elements
    return documents


@pytest.mark.parametrize("size,overlap,span", [
    (1, 0, 3), (1, 3, 7), (5, 0, 4), (5, 2, 256), (7, 7, 5), (4, 25, 6), (20, 3, 5), (20, 0, 1),
    (12, -1, 9),
])
def test_matches_model(spark, size, overlap, span):
    documents = random_documents(size * 100 + span)
    found = chunks_of(chunk_elements(frame(spark, documents), size, overlap, span=span))
    for name, elements in documents.items():
        expected = [(i, *c) for i, c in enumerate(chunk(elements, size, overlap))]
        assert [(*c[:4], list(c[4])) for c in found.get(name, [])] == expected


def test_runs_chain_across_a_long_document(spark, monkeypatch):
    """One document over many runs of blocks, with and without headers."""
    from leafmill.operators import carry

    rng = random.Random(5)
    plain = [("text", "w " * rng.randint(1, 6), None) for _ in range(700)]
    mixed = [("title" if rng.random() < .02 else "text", "w " * rng.randint(1, 6), i // 50)
             for i in range(700)]
    monkeypatch.setattr(carry.entry_states, "__defaults__", (3,))
    documents = {"plain": plain, "mixed": mixed}
    found = chunks_of(chunk_elements(frame(spark, documents), 16, 3, span=8))
    for name, elements in documents.items():
        assert [(*c[:4], list(c[4])) for c in found[name]] == [
            (i, *c) for i, c in enumerate(chunk(elements, 16, 3))]


def test_partitioning_does_not_matter(spark):
    documents = random_documents(3)
    elements = frame(spark, documents)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    for n in ("1", "4", "17"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(chunks_of(chunk_elements(elements.repartition(int(n)), 9, 2, span=6)))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert seen[0] == seen[1] == seen[2]


def test_short_documents_take_the_short_path(spark, tmp_path):
    """Without long documents the run neither calls Python nor shuffles texts a second time."""
    path = str(tmp_path / "elements")
    frame(spark, random_documents(4)).write.parquet(path)
    df = chunk_elements(spark.read.schema(ELEMENTS).parquet(path), 9, 2)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final and "FlatMapGroupsInPandas" not in final
    assert final.count("Exchange hashpartitioning") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_a_long_document_shuffles_texts_once(spark, tmp_path):
    path = str(tmp_path / "elements")
    rows = random_documents(4) | {"long": [("text", f"w{i} x", 1) for i in range(700)]}
    frame(spark, rows).write.parquet(path)
    df = chunk_elements(spark.read.schema(ELEMENTS).parquet(path), 9, 2)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    wide = [line for line in final.splitlines() if "FileScan" in line and "text" in line.split("Batched")[0]]
    assert len(wide) == 1


@pytest.mark.parametrize("mode,expected", [
    ("stem", "r.v2_chunk_0000"), ("path", "in/r.v2_chunk_0000")])
def test_ids(spark, mode, expected):
    df = frame(spark, {"in/r.v2.pdf": [("text", "a", 1)]})
    assert chunk_elements(df, 5, 1, id_mode=mode).first().chunk_id == expected


def test_md5_id(spark):
    import hashlib

    df = frame(spark, {"r.pdf": [("text", "é" * 100, 3)]})
    expected = hashlib.md5(f"r.pdf|3|0|{'é' * 80}".encode()).hexdigest()
    assert chunk_elements(df, 5, 1, id_mode="md5").first().chunk_id == expected
