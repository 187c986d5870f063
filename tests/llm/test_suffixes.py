"""Substring removal against brute force over all 50-byte windows; the suffix sort against plain sorting."""

import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from leafmill.llm import suffixes


def brute(rows):
    windows = {}
    for d, text in rows:
        data = (text or "").encode()
        key = (1 << 63) - 1 if d is None else d
        for i in range(len(data) - 49):
            w = data[i:i + 50]
            windows[w] = min(windows.get(w, key), key)
    out = []
    for d, text in rows:
        data = (text or "").encode()
        key = (1 << 63) - 1 if d is None else d
        gone = [False] * len(data)
        for i in range(len(data) - 49):
            if windows[data[i:i + 50]] < key:
                gone[i:i + 50] = [True] * 50
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((d, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_array_and_lcp():
    rnd = random.Random(2)
    for _ in range(300):
        t = [rnd.randint(1, rnd.choice([2, 4, 200])) for _ in range(rnd.randint(0, 60))] + [0]
        sa = suffixes.gsaca(t)
        assert sa == sorted(range(len(t)), key=lambda i: t[i:])
        common = suffixes.lcp(t, sa)
        for r in range(1, len(sa)):
            a, b = t[sa[r - 1]:], t[sa[r]:]
            assert common[r] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def test_removal_equals_brute_force(spark):
    rnd = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "épsilon", "zeta", "eta"]
    passage = " ".join(rnd.choice(words) for _ in range(30))
    rows = []
    for d in range(60):
        parts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))]
        if d % 3 == 0:
            parts.append(passage)
        if d % 7 == 0:
            parts.append(parts[0][::-1])
        rows.append((rnd.randint(0, 40), " ".join(parts)))
    rows += [(5, rows[3][1]), (5, rows[3][1]), (None, passage), (None, None), (61, ""), (62, "x" * 49),
             (63, "y" * 300), (64, "y" * 120), (65, "ab" * 400), (66, passage[:60] + "Z" + passage[60:])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"anchor": F.lit(1), "first": F.lit("x"), "spans": F.lit(2)})
    got = sorted((tuple(r) for r in suffixes.deduplicated(df).collect()), key=repr)
    assert got == brute(rows)
    assert any(r[2] for r in got)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffixes.deduplicated(empty).count() == 0


def test_only_pieces_that_meet_move_on():
    """Of each anchor's pieces: copies in larger ids, and the first holders where several pieces and ids meet, however rows are batched."""
    rnd = random.Random(5)
    rows = sorted({(rnd.randint(0, 12), rnd.randint(0, 3), rnd.choice([1, 1, 2, 5]), rnd.randint(0, 1)) for _ in range(60)} | {(20, 9, 1, 0), (21, 1, 7, 0), (21, 2, 7, 0)})
    expected = []
    for a, p, d, q in rows:
        group = [r for r in rows if r[0] == a]
        least = min(r[2] for r in group if r[1] == p)
        if d > least:
            expected.append((d, q, p, 0))
        elif len({r[1] for r in group}) > 1 and len({r[2] for r in group}) > 1:
            expected.append((d, q, p, 1))
    assert not any(p == 9 or d == 7 for d, _, p, _ in expected)
    for size in (1, 2, 3, 7, 1000):
        batches = [pa.RecordBatch.from_pydict(dict(zip(("anchor", "pkey", "docn", "part"), np.array(rows[k:k + size], np.int64).T, strict=True)))
                   for k in range(0, len(rows), size)]
        got = [tuple(r.values()) for b in suffixes._met(iter(batches)) for r in b.to_pylist()]
        assert sorted(got) == sorted(expected)


def test_pieces_move_without_their_bytes():
    text = bytes(random.Random(1).choices(range(97, 123), k=5000)).decode()
    batch = pa.RecordBatch.from_pydict({"docn": [1], "part": [0], "text": [text]})
    rows = pa.Table.from_batches(suffixes._named(iter([batch])))
    assert rows.num_rows > 100 and rows.nbytes == 32 * rows.num_rows


def test_windows_in_many_contexts(spark):
    """A line in texts of which each has other words around it, and rows that repeat or have no id."""
    rnd = random.Random(11)
    line = "this line stands in every one of the texts and is longer than fifty bytes, much longer"
    rows = [(rnd.choice([None, rnd.randint(0, 50)]), "".join(rnd.choices("abcdefgh ", k=rnd.randint(0, 90))) + line + "".join(rnd.choices("xyz ", k=rnd.randint(0, 90))))
            for _ in range(80)]
    rows += rows[:10]
    got = suffixes.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(rows)
