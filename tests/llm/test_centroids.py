"""Centroid clustering against plain integer k-means."""

import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from leafmill.llm import centroids


def plain(rows, k=40, rounds=5, dim=64):
    kept = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    firsts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), str(c), c) for i, c in kept if i is not None)[:k]
    cents = [c for _, _, c in firsts]

    def near(v):
        d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        m = min(d)
        return d.index(m), m

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[0], []).append(v)
        for c, vs in groups.items():
            cents[c] = [sum(col) // len(vs) for col in zip(*vs)]
    out = {}
    for i, v in kept:
        c, d = near(v)
        out.setdefault(i, []).append((c, d))
    per = {}
    for vals in out.values():
        for c, d in vals:
            per[c] = per.get(c, 0) + d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return out, per, digests


def test_matches_plain_kmeans(spark):
    rnd = np.random.default_rng(3)
    centres = rnd.normal(0, 0.5, (6, 64))
    rows = [(i, [float(x) for x in np.float32(centres[i % 6] + rnd.normal(0, 0.05, 64))]) for i in range(300)]
    rows += [(300, [0.5] * 64), (301, [0.5] * 64), (302, [0.5] * 64)]  # repeated vectors, ties
    rows += [(303, [1.0] * 63), (304, None), (305, [float("nan")] + [0.0] * 63), (306, [None] + [0.0] * 63),
             (307, [float("inf")] * 64), (None, [0.1] * 64), (5, rows[5][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x"))
    got = centroids.cluster(df, clusters=7, rounds=5).collect()
    want, per, digests = plain(rows, k=7)
    assert len(got) == sum(len(v) for v in want.values())
    assert {r["vec_id"] for r in got} == set(want)
    total = sum(per.values())
    for r in got:
        assert (r["cluster"], r["distance"]) in want[r["vec_id"]]
        assert r["cluster_inertia"] == per[r["cluster"]]
        assert r["inertia"] == total
        assert r["centroid_sha256"] == digests[r["cluster"]]


def test_fewer_vectors_than_clusters_and_empty(spark):
    rows = [(1, [0.25] * 64), (2, [0.5] * 64), (3, [0.25] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r["vec_id"], r["cluster"], r["distance"]) for r in centroids.cluster(df).collect())
    want, _, _ = plain(rows)
    assert got == sorted((i, *v[0]) for i, v in want.items())
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert centroids.cluster(empty).count() == 0
