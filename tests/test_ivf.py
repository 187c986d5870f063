"""Cell search: exact within the probed cells, recall on clustered vectors, and pruned files when cells are stored."""

import re

import numpy as np
from pyspark.sql import functions as F

from leafmill.operators import ivf
from leafmill.operators.search import search_vector


def clustered(spark, n=3000, dim=16, groups=40, seed=4):
    rnd = np.random.default_rng(seed)
    centres = rnd.normal(0, 1, (groups, dim))
    x = centres[np.arange(n) % groups] + rnd.normal(0, 0.15, (n, dim))
    rows = [(i, [float(v) for v in x[i]], int(i % groups)) for i in range(n)]
    rows += [(n, [0.0] * dim, 0), (n + 1, None, 0), (n + 2, [1.0] * (dim - 1), 0)]
    index = spark.createDataFrame(rows, "chunk_id long, chunk_embedding array<double>, label int")
    queries = spark.createDataFrame([(q, [float(v) for v in centres[q] + rnd.normal(0, 0.1, dim)]) for q in range(groups)],
                                    "query_id long, query_vector array<double>")
    return index, queries


def pairs(df):
    return {(r["query_id"], r["chunk_id"]) for r in df.collect()}


def test_recall_and_exact_inside_cells(spark):
    index, queries = clustered(spark)
    centroids = ivf.fit_cells(index, cells=32)
    got = ivf.search_ivf(index, queries, centroids, probes=4, k=10)
    exact = search_vector(index, queries, 10, skip_bad=True)
    assert len(pairs(got) & pairs(exact)) / len(pairs(exact)) >= 0.9
    cells = ivf.with_cells(index, centroids).filter("cell is not null")
    # every probe set reads under half of the rows
    q = np.array([r["query_vector"] for r in queries.orderBy("query_id").collect()])
    sizes = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}
    total = sum(sizes.values())
    for probes in ivf.probe_order(q, centroids, 4):
        assert sum(sizes.get(int(c), 0) for c in probes) < total / 2
    # inside its cells, each query gets the exact best rows
    qrows = queries.collect()
    for r, probes in zip(qrows, ivf.probe_order(np.array([x["query_vector"] for x in qrows]), centroids, 4)):
        mine = cells.filter(F.col("cell").isin([int(c) for c in probes]))
        one = spark.createDataFrame([r])
        assert pairs(ivf.search_ivf(mine, one, centroids, probes=4, k=10)) == pairs(search_vector(mine, one, 10))


def test_stored_cells_prune_files(spark, tmp_path):
    index, queries = clustered(spark)
    centroids = ivf.fit_cells(index, cells=16)
    stored = ivf.write_cells(index, centroids, str(tmp_path / "cells"))
    queries = queries.filter("query_id < 3")
    got = ivf.search_ivf(stored, queries, centroids, probes=2, k=5, cell_column="cell")
    assert pairs(got) == pairs(ivf.search_ivf(index, queries, centroids, probes=2, k=5))
    plan = got._jdf.queryExecution().executedPlan().toString()
    cells = re.search(r"PartitionFilters: \[cell#\d+ (?:IN|INSET) ([^\]]*)\]", plan).group(1)
    assert len(cells.split(",")) <= 6


def test_empty_and_odd(spark):
    index, queries = clustered(spark, n=50, groups=5)
    none = spark.createDataFrame([], index.schema)
    assert len(ivf.fit_cells(none)) == 0
    assert ivf.search_ivf(none, queries, ivf.fit_cells(none)).count() == 0
    few = ivf.fit_cells(index.limit(3), cells=64)
    assert len(few) <= 3
    assert ivf.search_ivf(index, queries.limit(0), few).count() == 0
