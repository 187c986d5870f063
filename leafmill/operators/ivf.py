"""Approximate vector search by an inverted file of data-fitted cells.

Cells are the centroids of a spherical k-means fitted on a bounded sample (the ``sample`` rows of
smallest id hash; fitting only places the cells, every row is assigned and searched). A row's
cell is its most similar centroid; stored as a partition column, it lets a search read only the
files of the cells it probes. A query probes its ``probes`` most similar cells, nearest first, and
ranks their rows exactly by cosine; each task keeps ``k`` rows per query, so only those move.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from leafmill.operators.search import QUERY_CELLS, top_k

CELLS = 64
PROBES = 24
SAMPLE = 20_000
ROUNDS = 12


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norms == 0, 1, norms)


def fit_cells(index: DataFrame, cells: int = CELLS, vector: str = "chunk_embedding", key: str = "chunk_id",
              sample: int = SAMPLE, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of a spherical k-means on at most ``sample`` non-zero vectors of the most common
    dimension (rows picked by a hash of their id, so the same rows at every run). Fewer distinct
    vectors than ``cells`` give fewer cells; none give an empty array."""
    v = F.col(vector)
    usable = index.filter(v.isNotNull() & F.exists(v, lambda x: x != 0))
    sizes = usable.groupBy(F.size(v).alias("n")).count().orderBy(F.desc("count"), "n").first()
    if sizes is None:
        return np.zeros((0, 0))
    rows = usable.filter(F.size(v) == sizes["n"]).orderBy(F.xxhash64(key), key).limit(sample).select(
        v.cast("array<double>").alias("v")).collect()
    x = _unit(np.array([r["v"] for r in rows], np.float64))
    x = np.unique(x, axis=0)
    # start from rows spread by hash order, then refine
    centroids = x[np.linspace(0, len(x) - 1, min(cells, len(x))).astype(int)]
    for _ in range(rounds):
        owner = (x @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, x)
        filled = np.bincount(owner, minlength=len(centroids)) > 0
        centroids[filled] = _unit(sums[filled])
    return centroids


def cell_of(vector: Column, centroids: np.ndarray) -> Column:
    """Number of the most similar centroid (the smaller on ties); null for a vector of another
    dimension, a zero vector or null."""
    cents = centroids.tolist()
    dimension = len(cents[0]) if cents else 0

    @F.arrow_udf("int")
    def locate(vectors: pa.Array) -> pa.Array:
        c = np.array(cents, np.float64).reshape(len(cents), dimension)
        fits = np.array(pc.equal(pc.list_value_length(vectors), dimension).fill_null(False))
        out = np.zeros(len(vectors), np.int32)
        if fits.any() and len(c):
            flat = vectors.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False)
            x = flat.astype(np.float64).reshape(-1, dimension)
            nonzero = np.abs(x).sum(axis=1) > 0
            out[np.flatnonzero(fits)] = (x @ c.T).argmax(axis=1)
            fits[np.flatnonzero(fits)[~nonzero]] = False
        return pa.array(out, mask=~fits)

    return locate(vector)


def with_cells(index: DataFrame, centroids: np.ndarray, vector: str = "chunk_embedding",
               column: str = "cell") -> DataFrame:
    return index.withColumn(column, cell_of(F.col(vector), centroids))


def write_cells(index: DataFrame, centroids: np.ndarray, path: str, vector: str = "chunk_embedding",
                column: str = "cell") -> DataFrame:
    """Write the index partitioned by cell, so that a search prunes files; returns it read back."""
    with_cells(index, centroids, vector, column).repartition(column).write.partitionBy(column).parquet(path)
    return index.sparkSession.read.parquet(path)


def probe_order(queries: np.ndarray, centroids: np.ndarray, probes: int) -> np.ndarray:
    """For each query the ``probes`` most similar cells, most similar first (smaller number on ties)."""
    sims = _unit(queries) @ centroids.T
    order = np.lexsort((np.broadcast_to(np.arange(len(centroids)), sims.shape), -sims), axis=1)
    return order[:, :probes]


def search_ivf(index: DataFrame, queries: DataFrame, centroids: np.ndarray, probes: int = PROBES, k: int = 10,
               key: str = "chunk_id", vector: str = "chunk_embedding", cell_column: str | None = None) -> DataFrame:
    """query_id, ``key``, score ((1 + cosine) / 2) and rank of the ``k`` best rows in each query's cells.

    Rows without a usable vector (null, zero, another dimension) are never hits. Queries travel with
    the tasks, up to QUERY_CELLS numbers; more raise, search them in blocks. ``cell_column`` names a
    stored cell (a partition column prunes files); without it cells are computed.
    """
    asked = queries.select("query_id", F.col("query_vector").cast("array<double>").alias("v"))
    dimension = centroids.shape[1] if len(centroids) else 0
    most = max(1, QUERY_CELLS // max(1, dimension))
    held = asked.filter(F.size("v") == dimension).limit(most + 1).collect()
    if len(held) > most:
        raise ValueError(f"more than {most} queries: search them in blocks")
    held = [r for r in held if any(r["v"])]
    spark = index.sparkSession
    schema = T.StructType([T.StructField("query_id", asked.schema["query_id"].dataType),
                           T.StructField(key, index.schema[key].dataType), T.StructField("score", T.DoubleType())])
    if not held or not len(centroids):
        return top_k(spark.createDataFrame([], schema), k, key)
    qids = [r["query_id"] for r in held]
    qv = _unit(np.array([r["v"] for r in held], np.float64))
    probed = probe_order(qv, centroids, probes)
    if cell_column is None:
        cell_column = "_cell"
        index = with_cells(index, centroids, vector, cell_column)
    wanted = sorted({int(c) for c in probed.ravel()})
    rows = index.filter(F.col(cell_column).isin(wanted)).select(key, vector, F.col(cell_column).alias("_c"))
    member = np.zeros((len(qids), len(centroids)), bool)
    member[np.arange(len(qids))[:, None], probed] = True
    qlist, mlist = qv.tolist(), member.tolist()
    out_schema = T.StructType([T.StructField("query_id", schema["query_id"].dataType), schema[key], schema["score"]])

    def run(batches):
        q = np.array(qlist, np.float64)
        m = np.array(mlist, bool)
        best_s, best_i = [], []
        for batch in batches:
            vec = batch.column(vector)
            fits = np.array(pc.equal(pc.list_value_length(vec), dimension).fill_null(False))
            if not fits.any():
                continue
            ids = batch.column(key).filter(pa.array(fits)).to_pylist()
            x = vec.filter(pa.array(fits)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = x.reshape(-1, dimension)
            cells = batch.column("_c").filter(pa.array(fits)).to_numpy(zero_copy_only=False)
            norms = np.linalg.norm(x, axis=1)
            ok = norms > 0
            s = (1 + (x @ q.T) / np.where(ok, norms, 1)[:, None]) / 2
            s[~(m[:, cells].T & ok[:, None])] = -np.inf
            best_s.append(s)
            best_i.extend(ids)
            if len(best_i) > 8 * k + 4096:
                best_s, best_i = _trim(best_s, best_i, k)
        if best_i:
            best_s, best_i = _trim(best_s, best_i, k)
            s = best_s[0]
            for j, qid in enumerate(qids):
                good = np.flatnonzero(np.isfinite(s[:, j]))
                if len(good):
                    yield pa.RecordBatch.from_pydict({"query_id": [qid] * len(good), key: [best_i[i] for i in good],
                                                      "score": s[good, j]}, schema=_arrow(out_schema))

    hits = rows.mapInArrow(run, out_schema)
    return top_k(hits, k, key)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _trim(scores: list, ids: list, k: int) -> tuple[list, list]:
    """Rows that are among the ``k`` best of some query (all ties at the k-th score kept)."""
    s = np.vstack(scores)
    if len(s) <= k:
        return [s], ids
    kth = -np.partition(-s, k - 1, axis=0)[k - 1]
    keep = np.flatnonzero((s >= kth[None, :]).any(axis=1) & np.isfinite(s).any(axis=1))
    return [s[keep]], [ids[i] for i in keep]
