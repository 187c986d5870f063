"""Centroid clustering of integer vectors, pruned by a LAESA pivot table.

Vectors are stored once with their distances to a few fixed pivots. In each round the centroids'
distances to the same pivots are computed on the driver (centroids x pivots, bounded by
parameters); by the triangle inequality ``max_p |d(x, p) - d(c, p)|`` is a lower bound of
``d(x, c)``, so a task computes exact integer distances only to the centroids whose bound does not
exceed the best distance found so far. New centroids come from sums that every task adds up over
its own rows first: what moves are ``tasks x centroids`` partial sums, never the vectors, so a
cluster holding a third of all rows costs no more than any other.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import saved

DIMENSION = 64
SCALE = 256
CLUSTERS = 40
ROUNDS = 5
#: Pivots are picked farthest-first among the vectors of smallest pivot hash; they only speed
#: up the search, results do not depend on them.
PIVOTS = 8
PIVOT_SAMPLE = 512
#: A bound is compared with this much slack, so that rounding of square roots never prunes a tie.
SLACK = 1e-7


def kept_vectors(embeddings: DataFrame, dimension: int = DIMENSION) -> DataFrame:
    """vec_id and ``comps`` (array of long, floor(SCALE * x) with x as double) of every row whose
    vector has exactly ``dimension`` components, none null, NaN or infinite. Other rows are left out;
    repeated rows are kept as they are (each is a vector of its own)."""
    vec = F.col("embedding")
    ok = (F.size(vec) == dimension) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    return embeddings.where(vec.isNotNull() & ok).select(
        "vec_id", F.transform(vec, lambda x: F.floor(x.cast("double") * SCALE).cast("long")).alias("comps"))


def _matrix(values: list) -> np.ndarray:
    return np.array(values, dtype=np.int64).reshape(len(values), -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of ``a`` and of ``b``, in int64: exact while
    components stay below 2^28 in magnitude (|x| < 2^20), as embeddings do."""
    d = a[:, None, :] - b[None, :, :]
    return np.einsum("ijk,ijk->ij", d, d)


def _pivots(vectors: DataFrame, n: int) -> np.ndarray:
    """``n`` pivots, farthest-first among the PIVOT_SAMPLE vectors of smallest hash of their id."""
    order = F.xxhash64(F.lit("pivot"), "vec_id", F.col("comps").cast("string"))
    sample = [r["comps"] for r in vectors.orderBy(order, "vec_id").limit(PIVOT_SAMPLE).collect()]
    if not sample:
        return np.zeros((0, DIMENSION), np.int64)
    pool = _matrix(sample)
    chosen = [0]
    near = _squared(pool, pool[:1])[:, 0]
    while len(chosen) < min(n, len(pool)) and near.max() > 0:
        k = int(near.argmax())
        chosen.append(k)
        near = np.minimum(near, _squared(pool, pool[k:k + 1])[:, 0])
    return pool[chosen]


def with_pivot_distances(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The pivot table: each vector with its Euclidean distances to the pivots, stored once."""
    schema = "vec_id long, comps array<long>, pivot_dist array<double>"
    pivot_rows = pivots.tolist()

    def run(batches):
        p = np.array(pivot_rows, np.int64).reshape(len(pivot_rows), -1)
        for batch in batches:
            comps = batch.column("comps")
            x = comps.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), -1) \
                if len(batch) else np.zeros((0, p.shape[1] if len(p) else DIMENSION), np.int64)
            dist = np.sqrt(_squared(x, p).astype(np.float64)) if len(p) else np.zeros((len(batch), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), comps, pa.array(list(dist), pa.list_(pa.float64()))],
                names=["vec_id", "comps", "pivot_dist"])

    return vectors.select("vec_id", "comps").mapInArrow(run, schema)


def _assign(x: np.ndarray, px: np.ndarray, centroids: np.ndarray, pc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (smaller number on ties) and the squared distance, for each row of ``x``.

    Exact distances are computed only where the pivot bound can still reach the best one.
    """
    n, k = len(x), len(centroids)
    if px.shape[1]:
        bound = np.abs(px[:, None, :] - pc[None, :, :]).max(axis=2)
    else:
        bound = np.zeros((n, k))
    first = bound.argmin(axis=1)
    diff = x - centroids[first]
    best = np.einsum("ij,ij->i", diff, diff)
    reach = np.sqrt(best.astype(np.float64)) * (1 + SLACK) + SLACK
    rows, cols = np.nonzero(bound <= reach[:, None])
    diff = x[rows] - centroids[cols]
    exact = np.einsum("ij,ij->i", diff, diff)
    # smallest distance first, then smallest centroid number
    order = np.lexsort((cols, exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    head = np.ones(len(rows), bool)
    head[1:] = rows[1:] != rows[:-1]
    cluster = np.empty(n, np.int64)
    distance = np.empty(n, np.int64)
    cluster[rows[head]] = cols[head]
    distance[rows[head]] = exact[head]
    return cluster, distance


def _arrays(batch: pa.RecordBatch, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column("comps").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(batch), dimension)
    pd_col = batch.column("pivot_dist")
    width = len(pd_col[0]) if len(batch) else 0
    px = pd_col.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
    return x, px


def _round(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dimension: int) -> dict:
    """Sums and counts of the vectors nearest to each centroid, added up per task before they move."""
    cents = centroids.tolist()
    pc = np.sqrt(_squared(centroids, pivots).astype(np.float64)) if len(pivots) else np.zeros((len(cents), 0))
    pcl = pc.tolist()

    def run(batches):
        c = np.array(cents, np.int64).reshape(len(cents), dimension)
        p = np.array(pcl, np.float64).reshape(len(cents), -1)
        sums = np.zeros((len(c), dimension), np.int64)
        counts = np.zeros(len(c), np.int64)
        for batch in batches:
            if not len(batch):
                continue
            x, px = _arrays(batch, dimension)
            cluster, _ = _assign(x, px, c, p)
            np.add.at(sums, cluster, x)
            counts += np.bincount(cluster, minlength=len(c))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"])

    partial = table.mapInArrow(run, "cluster int, n long, sums array<long>")
    # Componentwise totals per cluster: at most tasks x clusters rows reach this grouping.
    exploded = partial.select("cluster", "n", F.posexplode("sums").alias("pos", "s"))
    totals = exploded.groupBy("cluster", "pos").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out: dict = {}
    for r in totals.collect():
        entry = out.setdefault(r["cluster"], [r["n"], {}])
        entry[1][r["pos"]] = r["s"]
    return out


def cluster(embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, pivots: int = PIVOTS,
            dimension: int = DIMENSION) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every kept vector.

    Initial centroids are the ``clusters`` kept vectors of smallest lowercase hex sha256 of
    ``2:<vec_id>``, in that order (rows of equal hash by their components; rows with a null vec_id
    are never initial centroids but are clustered). With fewer kept vectors, there are as many
    centroids as vectors; with none, the result is empty. Each round assigns every vector to its
    nearest centroid (squared Euclidean distance, ties to the smaller number) and replaces each
    non-empty centroid by the exact floor of the mean of its vectors; empty ones stay. After the
    rounds vectors are assigned once more. ``centroid_sha256`` is the sha256 of the final
    centroid's components as decimal integers joined by ``,``.
    """
    spark = embeddings.sparkSession
    vectors = kept_vectors(embeddings, dimension)
    key = F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)
    first = vectors.where(F.col("vec_id").isNotNull()).orderBy(key, F.col("comps").cast("string")).limit(clusters)
    cents = [r["comps"] for r in first.collect()]
    schema = ("vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
              "centroid_sha256 string")
    if not cents:
        return spark.createDataFrame([], schema)
    centroids = _matrix(cents)
    pivot_rows = _pivots(vectors, pivots)
    table = saved(with_pivot_distances(vectors, pivot_rows))
    for _ in range(rounds):
        totals = _round(table, centroids, pivot_rows, dimension)
        for c, (n, sums) in totals.items():
            # exact floor of sum / count in Python integers
            centroids[c] = [sums[p] // n for p in range(dimension)]

    cents_final = centroids.tolist()
    pc = np.sqrt(_squared(centroids, pivot_rows).astype(np.float64)) if len(pivot_rows) else np.zeros((len(cents_final), 0))
    pcl = pc.tolist()

    def final(batches):
        c = np.array(cents_final, np.int64).reshape(len(cents_final), dimension)
        p = np.array(pcl, np.float64).reshape(len(cents_final), -1)
        for batch in batches:
            if not len(batch):
                continue
            x, px = _arrays(batch, dimension)
            cl, dist = _assign(x, px, c, p)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cl, pa.int32()), pa.array(dist, pa.int64())],
                names=["vec_id", "cluster", "distance"])

    assigned = table.mapInArrow(final, "vec_id long, cluster int, distance long")
    assigned = saved(assigned)
    per = {r["cluster"]: r["ci"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("ci")).collect()}
    total = sum(per.values())
    info = [(c, int(per.get(c, 0)), int(total),
             hashlib.sha256(",".join(str(v) for v in comps).encode()).hexdigest())
            for c, comps in enumerate(cents_final)]
    # one row per centroid: a bounded table
    small = spark.createDataFrame(info, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
