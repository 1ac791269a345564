"""Quality classifier: a generalised additive model with pairwise interactions.

Cyclic boosting fits shallow trees on one binned feature at a time, then on pairs of them; their sums are lookup tables.
A score is the logistic of the sum of the table entries that a text's bins select.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, table

#: At most so many labelled rows are fitted on, those with the smallest hash of their id.
MAX_ROWS = 20_000
THRESHOLD = 0.7
FEATURES = ("log_length", "word_length", "upper", "digits", "symbols", "marks", "bars", "wide", "spaces", "distinct", "repeats", "short_words", "long_words", "line_repeats", "stops", "glued")

_CLASS = np.zeros(256, np.uint8)
for _k, _of in enumerate((range(65, 91), range(48, 58), b"#$%&*@^~<>{}[]\\_=+", b"!?", b"|", range(128, 256), b" \t\n\r\x0b\x0c", b".;:,"), 1):
    _CLASS[list(_of)] = _k
_GLUED = re.compile(r"\w[^\w\s.,;:'’\-]{1,4}(?:\s|$)")


def features(text: str | None) -> list[float]:
    """Shape of a text as numbers, in the order of FEATURES; all 0 for a null or empty text."""
    if not text:
        return [0.0] * len(FEATURES)
    data = np.frombuffer(text.encode(errors="replace"), np.uint8)
    shares = np.bincount(_CLASS[data], minlength=9) / len(data)
    words = text.split()
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [x for x in text.split("\n") if x]
    return [
        float(np.log1p(len(text))), float(lengths.mean()), *(float(shares[i]) for i in range(1, 8)),
        len(set(words)) / n, sum(map(str.__eq__, words, words[1:])) / n, float((lengths <= 3).mean()), float((lengths >= 12).mean()),
        1 - len(set(lines)) / max(1, len(lines)), float(shares[8]) * len(data) / n, sum(1 for _ in _GLUED.finditer(text)) / n,
    ]


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(c, x[:, j], "right") for j, c in enumerate(cuts)], 1) if len(x) else np.zeros((0, len(cuts)), int)


def quantile_cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]


def _leaf(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g / (h + 1.0)


def _best_cut(g: np.ndarray, h: np.ndarray) -> int:
    """Where to cut a histogram of gradients in two; 0 for no cut."""
    if len(g) < 2:
        return 0
    a, b = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gain = a**2 / (b + 1.0) + (g.sum() - a) ** 2 / (h.sum() - b + 1.0)
    return int(gain.argmax()) + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int) -> np.ndarray:
    """Values of the bins of one feature by a tree of the given depth."""
    cut = _best_cut(g, h) if depth else 0
    if not cut:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.concatenate([_shallow_tree(g[:cut], h[:cut], depth - 1), _shallow_tree(g[cut:], h[cut:], depth - 1)])


def _pair_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values of a grid of two features' bins by a cut of the first and one of the second on either side."""
    cut = _best_cut(g.sum(1), h.sum(1))
    parts = [slice(0, cut), slice(cut, None)] if cut else [slice(None)]
    return np.concatenate([np.tile(_shallow_tree(g[p].sum(0), h[p].sum(0), 1), (len(g[p]), 1)) for p in parts])


@dataclass
class AdditiveModel:
    """Lookup tables: one for each feature, one for each chosen pair of features."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of features."""
        if not len(x):
            return np.zeros(0)
        fine, coarse = binned(x, self.cuts), binned(x, self.coarse)
        total = self.intercept + sum(t[fine[:, j]] for j, t in enumerate(self.tables)) + sum(t[coarse[:, i], coarse[:, j]] for i, j, t in self.pairs)
        return 1 / (1 + np.exp(-total))


def fit_additive(x: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.15, n_pairs: int = 6) -> AdditiveModel:
    """Fits main effects, then the pairs of features that explain most of what they leave. With no rows, or one label
    only, the model is a constant."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    n_features = x.shape[1]
    if not len(y) or y.min() == y.max():
        return AdditiveModel(float(np.log(share / (1 - share))), [np.zeros(0)] * n_features, [np.zeros(1)] * n_features, [np.zeros(0)] * n_features)
    model = AdditiveModel(float(np.log(share / (1 - share))), quantile_cuts(x, 48), [], quantile_cuts(x, 8))
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    fine, coarse = binned(x, model.cuts), binned(x, model.coarse)
    total = np.full(len(y), model.intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for j, t in enumerate(model.tables):
            g, h = gradients()
            step = rate * _shallow_tree(np.bincount(fine[:, j], g, len(t)), np.bincount(fine[:, j], h, len(t)), 2)
            t += step
            total += step[fine[:, j]]

    def grid(i: int, j: int, values: np.ndarray) -> np.ndarray:
        shape = len(model.coarse[i]) + 1, len(model.coarse[j]) + 1
        return np.bincount(coarse[:, i] * shape[1] + coarse[:, j], values, shape[0] * shape[1]).reshape(shape)

    g, h = gradients()
    gain = {(i, j): float((grid(i, j, g) ** 2 / (grid(i, j, h) + 1.0)).sum()) for i in range(n_features) for j in range(i)}
    model.pairs = [(i, j, np.zeros_like(grid(i, j, g))) for i, j in sorted(gain, key=lambda k: (-gain[k], k))[:n_pairs]]
    for _ in range(rounds // 3):
        for i, j, t in model.pairs:
            g, h = gradients()
            step = rate * _pair_tree(grid(i, j, g), grid(i, j, h))
            t += step
            total += step[coarse[:, i], coarse[:, j]]
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> AdditiveModel:
    """A model of ``labels.quality`` (0 or 1; others are left out) from the texts of ``docs``, without held-out rows.

    At most ``max_rows`` labels and rows are used. A document that has no label, or a label without a document, is left
    out; of repeated rows each counts.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = usable.select(F.col("doc_id").alias("labelled"), "quality").orderBy(F.xxhash64("labelled"), "labelled", "quality").limit(max_rows)
    # At most max_rows ids and labels are sent to the tasks. Rows of one id multiply them, so as many rows are chosen again, by
    # a hash of id and text, before features are measured and sent to the driver.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
    rows = rows.withColumn("h", F.xxhash64("doc_id", "text", "quality"))
    kept = rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")).orderBy("h").limit(max_rows)
    upto = Window.orderBy("h").rowsBetween(Window.unboundedPreceding, -1)  # of at most max_rows rows
    kept = kept.withColumn("room", F.lit(max_rows) - F.coalesce(F.sum("n").over(upto), F.lit(0))).where("room > 0").select("h", F.least("n", "room").alias("times"))
    rows = rows.join(F.broadcast(kept), "h").groupBy("h").agg(F.first("text").alias("text"), F.first("quality").alias("quality"), F.first("times").alias("times"))

    def measured(batches):
        import pyarrow as pa

        for batch in batches:
            found = [features(x.as_py()) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("quality").cast(pa.int32()), batch.column("times").cast(pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["y", "times", "x"])

    sample = rows.select("quality", "times", "text").mapInArrow(measured, "y int, times long, x array<double>").toArrow()
    times = sample.column("times").to_numpy()
    x = np.repeat(np.array(sample.column("x").to_pylist(), float).reshape(-1, len(FEATURES)), times, axis=0)
    y = np.repeat(sample.column("y").to_numpy().astype(float), times)
    order = np.lexsort((*x.T, y))  # rows come in any order; sums of floats shall not
    return fit_additive(x[order], y[order])


def scorer(model: AdditiveModel):
    """A column function: score of a text column."""
    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(x) for x in text], float).reshape(-1, len(FEATURES))))

    return score


def score_quality(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text), by the text alone.

    Null and empty texts have the score of a text without words. Null ids are not held out; repeated rows are kept;
    further columns are ignored; an empty table gives an empty result.
    """
    out = F.coalesce(held_out(F.col("doc_id")), F.lit(False))
    scored = docs.select("doc_id", out.alias("held_out"), scorer(model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_quality(docs: DataFrame, model: AdditiveModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model accepts, with all their columns."""
    return docs.where(scorer(model)(F.col("text")) >= threshold)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
