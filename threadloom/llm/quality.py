"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed per Arrow batch, byte counts with numpy over the batch's
text buffer. The trees are fitted on a bounded sample (``max_train``) of labelled
rows, flattened into five arrays, and traversed for all rows of a batch at once.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from threadloom.llm.common import held_out, plain_texts, small_slices, text_bytes, training_sample

MAX_TRAIN = 20_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0

# Byte classes counted per document.
_CLASSES = (
    ("lower", b"abcdefghijklmnopqrstuvwxyz"),
    ("upper", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("digit", b"0123456789"),
    ("space", b" \t\r\n\x0b\x0c"),
    ("line", b"\n"),
    ("stop", b".,;:"),
    ("loud", b"!?"),
    ("symbol", b"#$%&*+=<>@^~\\"),
    ("bar", b"|_/"),
    ("bracket", b"()[]{}\"'`-"),
    ("high", bytes(range(128, 256))),
)
FEATURES = (
    "log_bytes", "log_words", "mean_word", "longest_word", *(f"{name}_share" for name, _ in _CLASSES),
    "distinct_words", "top_word", "distinct_lines", "top_line", "words_per_line",
    "doubled_words", "one_letter_words", "compression",
)


def document_statistics(texts: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` per text. Null and empty texts give zeros."""
    return np.concatenate([_statistics(part) for part in small_slices(texts)])


def _statistics(texts: pa.Array) -> np.ndarray:
    raw, starts = text_bytes(texts)
    sizes = np.diff(starts).astype(float)
    out = np.zeros((len(sizes), len(FEATURES)))
    if not len(sizes):
        return out
    per_byte = np.maximum(sizes, 1.0)
    out[:, 0] = np.log1p(sizes)
    for i, (_, members) in enumerate(_CLASSES):
        table = np.zeros(256, np.uint8)
        table[np.frombuffer(members, np.uint8)] = 1
        seen = np.concatenate(([0], np.cumsum(table[raw], dtype=np.int64)))
        out[:, 4 + i] = (seen[starts[1:]] - seen[starts[:-1]]) / per_byte
    at = 4 + len(_CLASSES)
    for row, text in enumerate(plain_texts(texts)):
        words = text.split()
        if not words:
            continue
        n = len(words)
        counts = Counter(words)
        lines = Counter(filter(None, text.split("\n")))
        n_lines = sum(lines.values())
        packed = text.encode()
        out[row, 1] = np.log1p(n)
        out[row, 2] = (len(text) - n + 1) / n
        out[row, 3] = np.log1p(max(map(len, counts)))
        out[row, at : at + 8] = (
            len(counts) / n,
            max(counts.values()) / n,
            len(lines) / max(n_lines, 1),
            max(lines.values(), default=0) / max(n_lines, 1),
            np.log1p(n / max(n_lines, 1)),
            sum(map(str.__eq__, words, words[1:])) / n,
            sum(c for w, c in counts.items() if len(w) == 1) / n,
            len(zlib.compress(packed, 1)) / len(packed),
        )
    return out


@dataclass(frozen=True)
class FlatTrees:
    """A forest as arrays: node ``i`` of all trees; leaves point at themselves."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    bias: float
    depth: int

    def raw(self, rows: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        every = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            goes_left = rows[every, self.feature[at]] <= self.threshold[at]
            at = np.where(goes_left, self.left[at], self.right[at])
        return self.bias + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.raw(rows)))


def fit_trees(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.15,
    ridge: float = 2.0,
    min_rows: int = 10,
) -> FlatTrees:
    """Boost ``trees`` trees on log loss; splits are found on ``bins``-bin histograms.

    Without any label, or with one class only, the forest is its prior.
    """
    labels = np.asarray(labels, float)
    prior = (labels.sum() + 0.5) / (len(labels) + 1.0)
    bias = float(np.log(prior / (1 - prior)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}

    def leaf(value: float) -> int:
        i = len(nodes["value"])
        for key, x in (("feature", 0), ("threshold", 0.0), ("left", i), ("right", i), ("value", value)):
            nodes[key].append(x)
        return i

    roots = []
    if len(labels) and 0 < labels.sum() < len(labels):
        edges = [np.unique(np.quantile(col, np.linspace(0, 1, bins + 1)[1:-1])) for col in rows.T]
        # bin b holds edges[b - 1] < x <= edges[b]
        binned = np.stack([np.searchsorted(e, col, side="left") for e, col in zip(edges, rows.T, strict=True)])
        score = np.full(len(labels), bias)

        def grow(members: np.ndarray, grad: np.ndarray, hess: np.ndarray, level: int) -> int:
            g, h = grad[members].sum(), hess[members].sum()
            best = (1e-6, None)
            if level < depth and len(members) >= 2 * min_rows:
                for f, edge in enumerate(edges):
                    if not len(edge):
                        continue
                    b = binned[f, members]
                    size = len(edge) + 1
                    gl = np.cumsum(np.bincount(b, grad[members], size))[:-1]
                    hl = np.cumsum(np.bincount(b, hess[members], size))[:-1]
                    nl = np.cumsum(np.bincount(b, minlength=size))[:-1]
                    gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
                    gain[(nl < min_rows) | (len(members) - nl < min_rows)] = -1.0
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (float(gain[k]), (f, k))
            if best[1] is None:
                i = leaf(-rate * g / (h + ridge))
                score[members] += nodes["value"][i]
                return i
            f, k = best[1]
            i = leaf(0.0)
            goes = binned[f, members] <= k
            nodes["feature"][i], nodes["threshold"][i] = f, float(edges[f][k])
            nodes["left"][i] = grow(members[goes], grad, hess, level + 1)
            nodes["right"][i] = grow(members[~goes], grad, hess, level + 1)
            return i

        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-score))
            roots.append(grow(np.arange(len(labels)), p - labels, p * (1 - p), 0))
    else:
        roots.append(leaf(0.0))
    arrays = {k: np.asarray(v) for k, v in nodes.items()}
    return FlatTrees(roots=np.asarray(roots), bias=bias, depth=depth, **arrays)


def _statistics_udf():
    @F.arrow_udf("array<double>")
    def statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(document_statistics(texts).tolist(), pa.list_(pa.float64()))

    return statistics


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    max_train: int = MAX_TRAIN,
    seed: int = 9,
) -> FlatTrees:
    """Fit on at most about ``max_train`` labelled rows that are not held out.

    Only the statistics of the sample come to the driver: ``max_train`` short rows.
    """
    sample = training_sample(docs, labels, label, held_out("doc_id", FOLDS, HELD_OUT), max_train, seed)
    rows = (
        sample.select("_order", "doc_id", "label", _statistics_udf()("text").alias("x"))
        .toPandas()
        .sort_values(["_order", "doc_id"])
    )
    if not len(rows):
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    # Repeated ids with different texts keep a fixed order through their statistics.
    x = np.stack(rows["x"].to_numpy())
    order = np.lexsort((*x.T[::-1], rows["_order"].to_numpy()))
    return fit_trees(x[order], rows["label"].to_numpy()[order])


def quality_score(model: FlatTrees, text: str | Column = "text") -> Column:
    """Probability of label 1 as a column; every text, null and empty included, gets one."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.probability(document_statistics(texts)), pa.float64())

    return score(text)


def classify_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Null and empty texts are scored from all-zero statistics; a null id is never
    held out; repeated rows are scored each; an empty table gives no rows; other
    columns of ``docs`` are not read.
    """
    model = fit_quality(docs, labels, max_train=max_train)
    return docs.select(
        "doc_id",
        held_out("doc_id", FOLDS, HELD_OUT).alias("held_out"),
        quality_score(model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_quality(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """Rows of ``docs`` whose score reaches the threshold, with all their columns."""
    model = fit_quality(docs, labels, max_train=max_train)
    return docs.where(quality_score(model) >= THRESHOLD)
