import random
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from leafmill.functions import entities as E, text as X, vectors as V

TEXT_1 = (
    "Acme Widgets Inc. and Foo & Bar LLC met in New York at 12/31/2024 for $1,200.50, 5% or "
    "7 percent; Jan 5, 2024; 300 USD; from Überall to Spark; éin Paris near London near London; "
    "JANUARY 12 2023; 2024-1-2"
)
TEXT_2 = "Big Corp. at The end in It 100 dollars $ 5 12.5% 1,234 euros nearby In Paris"


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_entities_golden(spark):
    first, second, none, many = values(spark, E.extract_entities, [
        TEXT_1, TEXT_2, "nothing here", " ".join(f"{i}%" for i in range(25)) + " 3%"])
    assert first == {
        "ORGANIZATION": ["Acme Widgets Inc", "Bar LLC"],
        "LOCATION": ["New York", "London"],
        "DATE": ["12/31/2024", "Jan 5, 2024", "JANUARY 12 2023", "2024-1-2"],
        "MONEY": ["$1,200.50", "300 USD"],
        "PERCENT": ["5%", "7 percent"],
    }
    assert second == {
        "ORGANIZATION": ["Big Corp"],
        "MONEY": ["100 dollars", "$ 5", "1,234 eur"],
        "PERCENT": ["12.5%"],
    }
    assert none == {}
    assert many == {"PERCENT": [f"{i}%" for i in range(20)]}
    counts = values(spark, lambda v: E.count_entities(E.extract_entities(v)), [TEXT_1, TEXT_2, "x"])
    assert counts == [12, 5, 0]


# The organisation rule as one plain expression.
ORGANIZATION = (
    r"\b([A-Z][A-Za-z&]*(?:\s+[A-Z][A-Za-z&]*)*\s+"
    r"(?:Inc|Corp|Corporation|Ltd|LLC|GmbH|PLC)\.?)\b"
)


def test_entities_match_python(spark):
    rng = random.Random(7)
    pieces = ["Acme", "Inc", "Inc.", "inc", "A&B", "Foo-Bar", "Corporation", "Corp.x", "é", "Émile",
              "PLC", "of", "&", "\n", "  ", "Inc&Co", "GmbH.", "Incorporated", "in", "New", "York",
              "near", "It", "5%", "1,000,000.50", "$", "USD", "May 3 2020", "12/3/99", "\x00", "9"]
    texts = ["".join(rng.choice(pieces) + rng.choice([" ", " ", "", "\t"])
                     for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    found = values(spark, E.extract_entities, texts)
    plain = {
        "ORGANIZATION": (ORGANIZATION, 0), "DATE": (E.DATE, re.I), "MONEY": (E.MONEY, re.I),
        "PERCENT": (E.PERCENT, re.I),
    }
    for text, tags in zip(texts, found):
        for kind, (pattern, flags) in plain.items():
            expected = list(dict.fromkeys(re.findall(pattern, text, flags)))[:20]
            assert tags.get(kind, []) == expected, (kind, text)
        places = [p for p in dict.fromkeys(re.findall(E.LOCATION, text))
                  if p not in E.NOT_LOCATIONS and len(p) > 2]
        assert tags.get("LOCATION", []) == places[:20]


def test_entities_of_long_runs(spark):
    long_run = "Aa " * 8000 + "Inc and " + "1" + ",000" * 8000 + " USD"
    (tags,) = values(spark, E.extract_entities, [long_run])
    assert tags["ORGANIZATION"] == ["Aa " * 8000 + "Inc"]
    assert tags["MONEY"] == ["1" + ",000" * 8000 + " USD"]


def test_document_types(spark):
    names = ["d/x.HTM", "a.docx", ".pdf", "noext", "x.tar.gz", "a/b.PDF", "r.md", "n.txt", "d.doc"]
    assert values(spark, X.document_type, names) == [
        "html", "word", "unknown", "unknown", "unknown", "pdf", "markdown", "text", "word"]


def test_stems(spark):
    from pathlib import PurePosixPath

    names = ["d/x.tar.GZ", ".pdf", "a.b", "noext", "..pdf", "a/b/c.md", "x/", "a b.txt", "é.ü.pdf"]
    assert values(spark, X.file_stem, names) == [PurePosixPath(n).stem for n in names]


def test_chunk_ids(spark):
    df = spark.createDataFrame([("report", 7), ("report", 12345)], "s string, i int")
    ids = [r[0] for r in df.select(X.chunk_id(F.col("s"), F.col("i"))).collect()]
    assert ids == ["report_chunk_0007", "report_chunk_12345"]


def sanitize(text, limit):
    text = "".join(c for c in text if ord(c) >= 32 or c in "\n\r\t")
    return (text[:limit] if limit and len(text) > limit else text).strip()


@pytest.mark.parametrize("limit", [None, 0, 1, 4])
def test_sanitize(spark, limit):
    texts = ["  a\x00b\x07 c\n", "", "\x1f\x7fx\x85", " wide　", "a\nb\n", "𝒳𝒴𝒵 𝒲 v",
             "\r\n", "x \x1c y"]
    assert values(spark, lambda v: X.sanitize_text(v, limit), texts) == [
        sanitize(t, limit) for t in texts]


def size_text(n):
    for unit in ["B", "KB", "MB", "GB", "TB"]:
        if n < 1024.0:
            return f"{n:.2f} {unit}"
        n /= 1024.0
    return f"{n:.2f} PB"


def test_file_sizes(spark):
    rng = random.Random(2)
    sizes = [0, 1023, 1024, 1152, 1536, 1408, 2**50, 2**20 - 1, 2**20, 2**30 + 2**27, 2**62, -5]
    sizes += [rng.randrange(2 ** rng.randint(1, 62)) for _ in range(3000)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "i int, n bigint")
    found = [r[0] for r in df.orderBy("i").select(X.format_file_size(F.col("n"))).collect()]
    assert found == [size_text(n) for n in sizes]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=50, max_size=200))
def test_words_match_python(spark, texts):
    # Lone surrogates cannot be stored as UTF-8.
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    rows = values(spark, lambda v: F.struct(
        X.word_count(v), X.words(v), X.has_text(v), F.char_length(v), X.last_words(v, 2)), texts)
    for text, row in zip(texts, rows):
        parts = text.split()
        last = " ".join(parts[-2:]) if len(parts) > 2 else text
        assert tuple(row) == (len(parts), parts, bool(text.strip()), len(text), last)


def test_merge_metadata(spark):
    df = spark.createDataFrame(
        [({"a": "1", "b": "2"}, {"b": "9"}), ({"a": "1"}, {"a": None}), ({}, {"c": "3"})],
        "base map<string,string>, extra map<string,string>")
    merged = [r[0] for r in df.select(X.merge_metadata(F.col("base"), F.col("extra"))).collect()]
    assert merged == [{"a": "1", "b": "9"}, {"a": None}, {"c": "3"}]


def test_dimensions(spark):
    df = spark.createDataFrame([([1.0] * 64,), ([1.0] * 63,)], "v array<float>")
    check = V.dimensions_agree(F.col("v"), 64)
    assert df.select(check).first()[0] is False
    assert df.filter("size(v) = 64").select(check).first()[0] is True
    assert df.filter("false").select(check).first()[0] is True
    zero = spark.createDataFrame([([0.0, 0.0],), ([0.0, 1.0],), (None,)], "v array<float>")
    assert [r[0] for r in zero.select(V.is_nonzero(F.col("v"))).collect()] == [False, True, False]
