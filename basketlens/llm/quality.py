"""Quality classifier: gradient-boosted trees over document statistics (operator 2).

Tasks compute some two dozen statistics of every whole text. The trees are grown level by
level from histograms of binned statistics of a bounded sample of labelled documents, and
flattened into arrays of split features, thresholds and leaf values; all documents of a
batch walk through all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.common import materialise, remainder
from basketlens.llm.wordhash import IS_SPACE, batches, words

#: The model is fitted on so many labelled documents at most, those with the smallest
#: hash of their id.
MAX_LABELLED = 50_000
TREES, DEPTH, BINS, RATE, MIN_WEIGHT, SHRINK = 60, 4, 64, 0.2, 2.0, 1.0

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "line_ends", "non_ascii",
    "stops", "commas", "exclamations", "bars", "symbols", "brackets", "quotes", "controls",
    "entropy", "distinct_words", "top_word", "ends_in_mark", "starts_upper", "ends_in_symbol",
    "line_bytes", "repeated_pairs",
)


def _classes() -> np.ndarray:
    """For each byte the share it counts for, one row per share."""
    groups = (
        range(65, 91), range(48, 58), b" ", b"\n", range(128, 256), b".?:;", b",", b"!", b"|",
        b"#$%&*@^~_=+\\/`", b"<>{}[]()", b"\"'", (*range(9), *range(14, 32), 127),
    )
    table = np.zeros((256, len(groups)))
    for column, group in enumerate(groups):
        table[list(group), column] = 1
    return table


CLASSES = _classes()
IS_UPPER, IS_STOP, IS_SYMBOL = (CLASSES[:, i] > 0 for i in (0, 5, 9))
IS_MARK = IS_STOP | (CLASSES[:, 6] > 0) | (CLASSES[:, 7] > 0)
IS_ODD = IS_SYMBOL | (CLASSES[:, 7] > 0) | (CLASSES[:, 8] > 0)


def statistics(column: pa.Array) -> np.ndarray:
    """One row of FEATURES per text; an empty text has zeros."""
    hashes, starts, ends, first, data = words(column)
    out = np.zeros((len(column), len(FEATURES)))
    sizes = np.array([0 if v is None else v for v in pa.compute.binary_length(column).to_pylist()])
    stops = np.cumsum(sizes)
    for i, (stop, size) in enumerate(zip(stops, sizes)):
        if size == 0:
            continue
        counts = np.bincount(data[stop - size : stop], minlength=256)
        share = counts[counts > 0] / size
        n = first[i + 1] - first[i]
        row = out[i]
        row[0], row[1] = np.log1p(size), np.log1p(n)
        row[3:16] = counts @ CLASSES / size
        row[16] = -(share * np.log(share)).sum()
        row[22] = size / (counts[10] + 1)
        if n:
            own = slice(first[i], first[i + 1])
            h, last, begin = hashes[own], data[ends[own] - 1], data[starts[own]]
            _, often = np.unique(h, return_counts=True)
            row[2] = (size - counts[IS_SPACE].sum()) / n
            row[17], row[18] = len(often) / n, often.max() / n
            row[19], row[20], row[21] = IS_MARK[last].mean(), IS_UPPER[begin].mean(), IS_ODD[last].mean()
            row[23] = (h[1:] == h[:-1]).mean() if n > 1 else 0.0
    return out


@dataclass
class Forest:
    """Complete trees, flattened: a node's children are 2 i + 1 and 2 i + 2."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        node = np.zeros((len(x), trees), dtype=np.int64)
        rows, each = np.arange(len(x))[:, None], np.arange(trees)[None, :]
        for _ in range((inner + 1).bit_length() - 1):
            right = x[rows, self.feature[each, node]] > self.threshold[each, node]
            node = 2 * node + 1 + right
        return 1 / (1 + np.exp(-self.base - self.leaf[each, node - inner].sum(axis=1)))


def fit_forest(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost logistic loss; without rows of both classes the forest is constant."""
    inner = 2**DEPTH - 1
    prior = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    base = float(np.log(prior / (1 - prior)))
    if len(np.unique(y)) < 2:
        return Forest(base, np.zeros((1, inner), int), np.full((1, inner), np.inf), np.zeros((1, inner + 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(cut, c, side="left") for cut, c in zip(cuts, x.T)], axis=1)
    total = np.full(len(y), base)
    shape = (TREES, inner)
    feature, threshold, leaf = np.zeros(shape, int), np.full(shape, np.inf), np.zeros((TREES, inner + 1))
    for tree in range(TREES):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = y - p, p * (1 - p)
        node, split_bin = np.zeros(len(y), int), np.full(inner, BINS)
        for depth in range(DEPTH):
            level, at = 2**depth, 2**depth - 1
            best = np.full(level, 1e-6)
            for f, column in enumerate(binned.T):
                key = (node - at) * BINS + column
                g, w = (np.bincount(key, v, level * BINS).reshape(level, BINS).cumsum(axis=1) for v in (gradient, weight))
                g_all, w_all = g[:, -1:], w[:, -1:]
                gain = g**2 / (w + SHRINK) + (g_all - g) ** 2 / (w_all - w + SHRINK) - g_all**2 / (w_all + SHRINK)
                gain[(w < MIN_WEIGHT) | (w_all - w < MIN_WEIGHT)] = 0
                gain[:, len(cuts[f]) :] = 0
                where = gain.argmax(axis=1)
                value = gain[np.arange(level), where]
                for i in np.flatnonzero(value > best):
                    best[i] = value[i]
                    feature[tree, at + i], split_bin[at + i] = f, where[i]
                    threshold[tree, at + i] = cuts[f][where[i]]
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[tree, node]] > split_bin[node])
        own = node - inner
        g, w = (np.bincount(own, v, inner + 1) for v in (gradient, weight))
        leaf[tree] = RATE * g / (w + SHRINK)
        total += leaf[tree, own]
    return Forest(base, feature, threshold, leaf)


def training_labels(labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, y) of at most ``limit`` documents outside the held-out third.

    A document labelled more than once has its mean label, ties counting as 0. Null ids
    and labels are left out.
    """
    return (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .where(remainder(F.col("doc_id"), 3) != 1)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg("quality") > 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )


def train_quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Forest:
    """Fit the forest; only the statistics of the bounded sample come to the driver."""
    sample = F.broadcast(materialise(training_labels(labels, limit)))
    names = ", ".join(f"{name} double" for name in FEATURES)

    def measure(parts):
        for part in parts:
            for batch in batches(part):
                x = statistics(batch.column("text"))
                columns = [batch.column("doc_id"), batch.column("y"), *(pa.array(c) for c in x.T)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "y", *FEATURES])

    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .join(sample, "doc_id")
        .mapInArrow(measure, f"doc_id long, y int, {names}")
        .toPandas()
        .sort_values(["doc_id", *FEATURES])
    )
    return fit_forest(rows[list(FEATURES)].to_numpy(float), rows["y"].to_numpy(float))


def quality_score(forest: Forest, text: str = "text") -> Column:
    """The probability of label 1 of each whole text, as a column."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([column.cast(pa.string())], names=["text"])
        found = [forest.score(statistics(piece.column("text"))) for piece in batches(batch)]
        return pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return score(F.coalesce(F.col(text), F.lit("")))


def classify_quality(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    The score is a function of the text alone; null and empty texts score alike. Repeated
    rows are scored each. A null doc_id is not held out. Without labels of both classes
    every score is the share of label 1, or 0.5 without labels. Other columns are ignored;
    an empty table gives an empty result.
    """
    forest = train_quality(docs, labels, limit)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(remainder(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        quality_score(forest).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
