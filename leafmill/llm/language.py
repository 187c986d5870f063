"""Language identification by nearest centroid.

A text becomes a vector of hashed three-byte windows of its lower-cased letters, weighted by
log(1 + count) x inverse document frequency and scaled to length 1. Each language has several
centroids, found by spherical k-means; a text gets the language of the centroid with the largest
cosine, and is rejected when it is farther from that centroid than its members ever were, by a
margin.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import appended, last_picks, strings
from leafmill.llm.grams import Grams

GRAMS = Grams(bins=4096, letters=True)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts).astype(np.float32) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _frequencies(batches):
    total, rows = np.zeros(GRAMS.bins, np.int64), 0
    for batch in batches:
        for _, counts in GRAMS.counts(strings(batch, "text")):
            total += (counts > 0).sum(axis=0)
            rows += len(counts)
    if rows:
        yield pa.RecordBatch.from_pydict({"bin": np.arange(-1, GRAMS.bins, dtype=np.int32),
                                          "n": np.concatenate([[rows], total])})


def _clusterer(idf: np.ndarray, clusters: int, rounds: int, low: float):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["pick", "text"])
        x = np.concatenate([_vectors(c, idf) for _, c in GRAMS.counts(group["text"].tolist())])
        k = min(clusters, len(x))
        centers = x[np.linspace(0, len(x) - 1, k).astype(int)]
        for _ in range(rounds):
            near = (x @ centers.T).argmax(axis=1)
            sums = np.stack([x[near == j].sum(axis=0) if (near == j).any() else centers[j] for j in range(k)])
            centers = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        cosines = x @ centers.T
        near, best = cosines.argmax(axis=1), cosines.max(axis=1)
        return pd.DataFrame({
            "lang": group["lang"].iloc[0], "cluster": range(k), "centroid": [c.tolist() for c in centers],
            "radius": [float(np.quantile(best[near == j], low)) if (near == j).any() else 1.0 for j in range(k)],
        })

    return fit


class LanguageModel:
    """Centroids by language; small enough to travel with the tasks."""

    def __init__(self, idf, langs, centroids, radius):
        self.idf, self.langs, self.centroids, self.radius = idf, langs, centroids, radius

    @classmethod
    def fit(cls, rows: DataFrame, sample: int = 1500, clusters: int = 4, rounds: int = 8,
            low: float = 0.0, max_langs: int = 1000) -> "LanguageModel":
        """``rows``: text, lang. Rows without a language or a letter teach nothing.

        Document frequencies cover all rows; centroids are fitted on at most ``sample`` rows of
        each language, picked by a hash of the text. At most ``max_langs`` languages are learned;
        more is an error, since the centroids go to every task.
        """
        rows = rows.select("text", "lang").where(
            F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
        counts = rows.select("text").mapInArrow(_frequencies, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n"))
        found = {r.bin: r.n for r in counts.collect()}  # GRAMS.bins + 1 rows
        if not found:
            return cls(None, [], None, None)
        df = np.array([found.get(b, 0) for b in range(GRAMS.bins)])
        idf = np.log((1 + found[-1]) / (1 + df)).astype(np.float32) + 1

        picks = rows.select("lang", F.xxhash64("text").alias("pick"))
        limits = last_picks(picks, "lang", sample)  # one row per language
        if len(limits) > max_langs:
            raise ValueError(f"{len(limits)} languages, more than {max_langs}")
        last = F.create_map(*[x for k, v in limits.items() for x in (F.lit(k), F.lit(v))])
        chosen = (rows.withColumn("pick", F.xxhash64("text")).where(F.col("pick") <= last[F.col("lang")])
                  .dropDuplicates(["lang", "pick"]))
        fitted = chosen.groupBy("lang").applyInPandas(
            _clusterer(idf, clusters, rounds, low), "lang string, cluster int, centroid array<float>, radius double")
        models = sorted(fitted.collect(), key=lambda r: (r["lang"], r["cluster"]))
        return cls(idf, [m["lang"] for m in models], np.array([m["centroid"] for m in models], np.float32),
                   np.array([m["radius"] for m in models]))

    def predict(self, docs: DataFrame, margin: float = 0.25) -> DataFrame:
        """Add ``lang_pred``, ``score`` (the cosine) and ``rejected`` to ``docs``, columns of those names replaced.

        Null texts and texts without a letter, and all texts when nothing was learned, are ``und``
        with score 0 and rejected. A text is rejected when its cosine is below ``margin`` times
        the lowest cosine among the members of its centroid. Any length of text is read whole.
        """
        idf, langs, centroids, radius = self.idf, self.langs, self.centroids, self.radius

        def start():
            def work(texts):
                names, scores, far = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
                for first, counts in GRAMS.counts(texts) if langs else ():
                    cosines = _vectors(counts, idf) @ centroids.T
                    for i, b in enumerate(cosines.argmax(axis=1)):
                        if has_letter(texts[first + i]):
                            c = float(cosines[i, b])
                            names[first + i] = langs[b]
                            scores[first + i] = min(1.0, max(0.0, c))
                            far[first + i] = bool(c < margin * radius[b])
                return names, scores, far

            return work

        return appended(docs, "lang_pred string, score double, rejected boolean", start, ["text"])


def held_out(doc_id, folds: int, fold: int):
    """True for rows no model may learn from; a null id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(True))


def fit_on_documents(docs: DataFrame) -> LanguageModel:
    """The model learned from the documents outside the held-out fold (crc32 of the id mod 5 is 0)."""
    return LanguageModel.fit(docs.where(~held_out(F.col("doc_id"), 5, 0)))


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, rejected of all ``docs`` (doc_id, text, lang)."""
    model = fit_on_documents(docs)
    return model.predict(docs.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "text")).drop("text")
