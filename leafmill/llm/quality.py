"""Quality classifier: naive Bayes log-count ratios as features of a linear support vector machine.

A text is the set of hashed three-byte windows it holds. Each window is scaled by the log ratio of
its share in good and in bad texts, the vector is scaled to length 1, and a linear model of the
hinge loss is fitted by dual coordinate descent. A sigmoid, fitted on a part of the sample
that the linear model has not seen, turns its margin into a probability.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.llm.common import appended, last_picks
from leafmill.llm.grams import Grams
from leafmill.llm.language import held_out

GRAMS = Grams(bins=1 << 14, letters=False)


def log_count_ratio(sets: list[np.ndarray], labels: np.ndarray, smooth: float = 1.0) -> np.ndarray:
    good = np.full(GRAMS.bins, smooth)
    bad = np.full(GRAMS.bins, smooth)
    for bins, label in zip(sets, labels, strict=True):
        (good if label > 0 else bad)[bins] += 1
    return np.log((good / good.sum()) / (bad / bad.sum()))


def dual_coordinate_descent(sets, values, labels, cost: float, rounds: int, tolerance: float = 1e-3):
    """Weights and bias of the hinge loss with box constraint ``cost``; one dual variable per text."""
    weights, bias = np.zeros(GRAMS.bins), 0.0
    alpha = np.zeros(len(sets))
    square = np.array([v @ v + 1.0 for v in values])
    order = np.random.default_rng(0)
    for _ in range(rounds):
        worst = 0.0
        for i in order.permutation(len(sets)):
            y = labels[i]
            gradient = y * (weights[sets[i]] @ values[i] + bias) - 1
            old = alpha[i]
            new = min(max(old - gradient / square[i], 0.0), cost)
            if new != old:
                alpha[i] = new
                weights[sets[i]] += (new - old) * y * values[i]
                bias += (new - old) * y
                worst = max(worst, abs(new - old))
        if worst < tolerance * cost:
            break
    return weights, bias


def sigmoid_fit(margins: np.ndarray, labels: np.ndarray, rounds: int = 100) -> tuple[float, float]:
    """Slope and offset of a logistic curve through (margin, label), by Newton's method."""
    a, b = 1.0, 0.0
    n_good, n_bad = (labels > 0).sum(), (labels <= 0).sum()
    target = np.where(labels > 0, (n_good + 1) / (n_good + 2), 1 / (n_bad + 2))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        d, h = p - target, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(d * margins).sum() + 1e-3 * a, d.sum()])
        hess = np.array([[(h * margins * margins).sum() + 1e-3, (h * margins).sum()], [(h * margins).sum(), h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def _fitter(cost: float, rounds: int):
    def fit(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["pick", "text", "label"])
        sets = [np.flatnonzero(row) for _, counts in GRAMS.counts(group["text"].tolist()) for row in counts]
        labels = np.where(group["label"].to_numpy() > 0, 1, -1)
        test = np.arange(len(sets)) % 5 == 0 if len(sets) >= 50 else np.zeros(len(sets), bool)
        train = [s for s, t in zip(sets, test, strict=True) if not t]
        ratio = log_count_ratio(train, labels[~test])
        scaled = [ratio[s] / max(np.linalg.norm(ratio[s]), 1e-9) for s in sets]
        weights, bias = dual_coordinate_descent(
            train, [v for v, t in zip(scaled, test, strict=True) if not t], labels[~test], cost, rounds)
        margins = np.array([weights[s] @ v + bias for s, v in zip(sets, scaled, strict=True)])
        seen = test if test.any() else ~test
        slope, offset = sigmoid_fit(margins[seen], labels[seen])
        return pd.DataFrame({"ratio": [ratio.tolist()], "weights": [weights.tolist()], "bias": bias, "slope": slope, "offset": offset})

    return fit


class QualityModel:
    def __init__(self, ratio=None, weights=None, bias=0.0, slope=0.0, offset=0.0):
        self.ratio, self.weights, self.bias, self.slope, self.offset = ratio, weights, bias, slope, offset

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, sample: int = 6000, cost: float = 1.0, rounds: int = 30) -> "QualityModel":
        """``docs``: doc_id, text; ``labels``: doc_id, label (0 or 1, others and nulls ignored).

        Fitted on at most ``sample`` rows of each label, the first by a hash of the id; only their
        texts are read. A null text counts as empty. An id that has both labels has neither. With rows of
        one label only, every score is that label's share after smoothing; with none, 0.5.
        """
        narrow = (labels.select("doc_id", F.col("label").cast("int").alias("label"))
                  .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
                  .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
                  .where("label = other").select("doc_id", "label", F.xxhash64("doc_id").alias("pick")))
        limits = last_picks(narrow, "label", sample)
        inside = [(F.col("label") == v) & (F.col("pick") <= last) for v, last in limits.items()]
        picked = narrow.where(inside[0] | inside[-1] if inside else F.lit(False))
        texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        chosen = texts.join(F.broadcast(picked), "doc_id")  # at most 2 x sample rows
        shares = {r["label"]: r["count"] for r in picked.groupBy("label").count().collect()}
        if len(shares) < 2:
            good, all_ = shares.get(1, 0), sum(shares.values())
            return cls(offset=float(np.log((good + 1) / (all_ - good + 1))))
        found = chosen.groupBy(F.lit(0).alias("model")).applyInPandas(
            _fitter(cost, rounds), "ratio array<double>, weights array<double>, bias double, slope double, offset double")
        rows = found.collect()  # one row
        if not rows:
            return cls()
        m = rows[0]
        return cls(np.array(m["ratio"]), np.array(m["weights"]), m["bias"], m["slope"], m["offset"])

    def predict(self, docs: DataFrame) -> DataFrame:
        """Add ``score``, the probability of label 1, to ``docs``; null counts as empty, texts are read whole."""
        bias, slope, offset = self.bias, self.slope, self.offset
        if self.ratio is not None:
            squares, products = self.ratio ** 2, self.ratio * self.weights

        def start():
            def work(texts):
                margins = np.full(len(texts), bias)
                if slope or bias:
                    for first, counts in GRAMS.counts(texts):
                        held = counts > 0
                        norm = np.sqrt(np.maximum(held @ squares, 1e-18))
                        margins[first:first + len(counts)] += held @ products / norm
                return [(1 / (1 + np.exp(-np.clip(slope * margins + offset, -30, 30)))).tolist()]

            return work

        return appended(docs, "score double", start, ["text"])


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of all ``docs``, learned from ``labels`` (doc_id, quality) outside the
    held-out fold (crc32 of the id mod 4 is 2)."""
    known = labels.where(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", F.col("quality").alias("label"))
    model = QualityModel.fit(docs.where(~held_out(F.col("doc_id"), 4, 2)), known)
    found = model.predict(docs.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "text")).drop("text")
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
