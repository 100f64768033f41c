"""A quality classifier co-trained on two views: what a text says, and its metadata.

Both views are logistic regressions on sparse features. They are fitted on a sample of
labelled documents whose size is bounded; a bounded sample of unlabelled documents is
the pool. In each round a view labels the pool documents that it is sure of, and the
other view learns from these. Each view is calibrated on labelled documents that it has
not learnt from, and a last regression combines the calibrated views. Features are made
where the documents are; only the samples' features meet in one task. The weights, of
fixed size, are broadcast, and every document is scored from its whole text.

Defined results: a null or empty text has no words; null metadata is a value of its
own; a document with several labels is good only if all say so; null labels are passed
over; without labels of both kinds every document has the share of good labels as its
score (1 if there is none); rows that repeat score alike; an empty table gives an empty
table; extra columns are ignored.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bytes_of, saved
from tidemark.llm.decontaminate import words_of

#: Bounds of the samples, which hold about this many rows at most.
LABELLED = 8_000
POOL = 8_000
ROUNDS = 3
#: A view labels a pool document if its calibrated probability is this far from even.
SURE = 0.95
BITS = 16
STATS = 6
#: The shares are small numbers beside the words.
STAT_WEIGHT = 5.0
KEEP = 0.5


def text_features(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed distinct words, of length one together, and six shares of the text."""
    words = words_of(data)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    distinct = set(words)
    at = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) & ((1 << BITS) - 1)
    n = len(data)
    raw = np.frombuffer(data, np.uint8)
    classes = np.bincount(_CLASS[raw], minlength=4) / n
    stats = [
        *classes[1:4],  # upper case, digits, symbols
        len(distinct) / len(words),
        min(n / len(words), 32) / 32,
        min(np.log1p(len(words)), 16) / 16,
    ]
    return (
        np.append(at, (1 << BITS) + np.arange(STATS)),
        np.append(np.full(len(at), len(at) ** -0.5), STAT_WEIGHT * np.array(stats)),
    )


def _class(c: int) -> int:
    """Of a byte: 1 upper case, 2 digit, 3 symbol, 0 any other."""
    if 65 <= c <= 90:
        return 1
    if 48 <= c <= 57:
        return 2
    return 3 if 33 <= c <= 126 and not chr(c).isalnum() else 0


_CLASS = np.array([_class(c) for c in range(256)])


def meta_features(values: Sequence) -> tuple[np.ndarray, np.ndarray]:
    """Each column's value, hashed with its place; numbers by their power of two."""
    keys = []
    for k, v in enumerate(values):
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            v = f"2^{int(np.log2(max(v, 1)))}" if v == v else None
        keys.append(f"{k}={v!r}")
    at = np.array([zlib.crc32(x.encode()) & ((1 << BITS) - 1) for x in keys], np.int64)
    return at, np.ones(len(at))


class Rows:
    """Sparse rows."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int) -> None:
        self.n, self.width = len(rows), width
        self.row = np.repeat(np.arange(self.n), [len(a) for a, _ in rows])
        self.at = np.concatenate([a for a, _ in rows]) if rows else np.zeros(0, np.int64)
        self.value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.at], self.n)

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.at, self.value * r[self.row], self.width)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class View:
    """Weights of one view, and the line that calibrates its logits."""

    width: int
    w: np.ndarray = field(default=None)
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def fit(self, x: Rows, y: np.ndarray, weight: np.ndarray, steps: int = 200) -> None:
        """Logistic regression by steps of per-weight size, towards small weights."""
        w, b = np.zeros(self.width), 0.0
        sw, sb = np.full(self.width, 1e-8), 1e-8
        total = weight.sum()
        for _ in range(steps):
            r = (sigmoid(x.dot(w) + b) - y) * weight / total
            g, gb = x.back(r) + 1e-6 * w, r.sum()
            sw += g * g
            sb += gb * gb
            w -= 1.5 * g / np.sqrt(sw)
            b -= 1.5 * gb / np.sqrt(sb)
        self.w, self.bias = w, b

    def logit(self, x: Rows) -> np.ndarray:
        return x.dot(self.w) + self.bias

    def calibrate(self, x: Rows, y: np.ndarray) -> None:
        coefficients, shift = line(self.logit(x)[:, None], y)
        self.slope, self.shift = coefficients[0], shift

    def calibrated(self, x: Rows) -> np.ndarray:
        return self.slope * self.logit(x) + self.shift


def line(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[np.ndarray, float]:
    """Logistic regression on few columns by Newton steps."""
    x1 = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x1.shape[1])
    for _ in range(25):
        p = sigmoid(x1 @ w)
        hessian = (x1.T * np.maximum(p * (1 - p), 1e-9)) @ x1 + ridge * np.eye(len(w))
        w = w - np.linalg.solve(hessian, x1.T @ (p - y) + ridge * w)
    return w[:-1], float(w[-1])


@dataclass
class Model:
    views: list[View] | None
    weights: np.ndarray | None
    shift: float
    share: float

    def score(self, rows: list[Rows]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, metadata, combined) probabilities of being good."""
        if self.views is None:
            return (np.full(rows[0].n, self.share),) * 3
        logits = [v.calibrated(x) for v, x in zip(self.views, rows)]
        both = self.weights[0] * logits[0] + self.weights[1] * logits[1] + self.shift
        return sigmoid(logits[0]), sigmoid(logits[1]), sigmoid(both)


WIDTHS = ((1 << BITS) + STATS, 1 << BITS)


def co_train(features: list[list], y: np.ndarray, fold: np.ndarray, rounds: int, sure: float) -> Model:
    """Fits both views. ``y``: 1 good, 0 bad, -1 pool; ``fold`` 0 of the labelled calibrates."""
    known = y >= 0
    share = float(y[known].mean()) if known.any() else 1.0
    learn, hold = known & (fold != 0), known & (fold == 0)
    if min(len(np.unique(y[learn])), len(np.unique(y[hold]))) < 2:
        return Model(None, None, 0.0, share)

    def rows(view: int, which: np.ndarray) -> Rows:
        return Rows([features[view][k] for k in np.flatnonzero(which)], WIDTHS[view])

    pool = np.flatnonzero(y < 0)
    held = [rows(v, hold) for v in (0, 1)]
    pooled = [rows(v, y < 0) for v in (0, 1)]
    views = [View(w) for w in WIDTHS]
    # What each view has been told by the other one: label by pool place.
    told: list[dict[int, int]] = [{}, {}]
    for turn in range(rounds + 1):
        for v, view in enumerate(views):
            labels = y.copy()
            labels[[pool[k] for k in told[v]]] = list(told[v].values())
            which = (labels >= 0) & ~hold
            weight = np.where(known, 1.0, 0.5)[which]
            view.fit(rows(v, which), labels[which].astype(float), weight)
            view.calibrate(held[v], y[hold])
        if turn == rounds:
            break
        for v, view in enumerate(views):
            p = sigmoid(view.calibrated(pooled[v]))
            for k in np.flatnonzero((p >= sure) | (p <= 1 - sure)):
                told[1 - v].setdefault(int(k), int(p[k] >= sure))
    logits = np.column_stack([v.calibrated(x) for v, x in zip(views, held)])
    weights, shift = line(logits, y[hold])
    return Model(views, weights, shift, share)


def sampled(df: DataFrame, id_col: str, size: int, seed: int) -> DataFrame:
    """About ``size`` rows at most, by a hash of the id."""
    n = df.count()
    share = min(1.0, size / max(n, 1))
    return df.filter(F.pmod(F.xxhash64(F.col(id_col), F.lit(seed)), F.lit(1 << 30)) < share * (1 << 30))


def train(
    docs: DataFrame,
    labels: DataFrame,
    good: Column,
    meta: Sequence[str],
    text: str = "text",
    id_col: str = "doc_id",
    labelled: int = LABELLED,
    pool: int = POOL,
    rounds: int = ROUNDS,
    sure: float = SURE,
) -> Model:
    """The model of a bounded sample; ``good`` is a condition on the labels' columns."""
    known = (
        labels.filter(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg(F.min(good.cast("int")).alias("label"))
        .filter("label IS NOT NULL")
    )
    chosen = saved(sampled(known, "label_id", labelled, 1), "labels")
    rows = docs.select(
        F.col(id_col).alias("id"),
        bytes_of(text).alias("data"),
        F.struct(*(F.col(c).alias(f"m{k}") for k, c in enumerate(meta))).alias("meta"),
    )
    with_label = rows.join(chosen, F.col("id") == F.col("label_id")).drop("label_id")
    without = (
        sampled(rows, "id", pool, 2)
        .join(known, F.col("id") == F.col("label_id"), "left_anti")
        .withColumn("label", F.lit(-1))
    )
    fold = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(4)).cast("int")

    def features(batches):
        for batch in batches:
            got = [
                [text_features(d.as_py()) for d in batch.column(0)],
                [meta_features(list(m.as_py().values())) for m in batch.column(1)],
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(
                        pa.array([row[k] for row in view], t)
                        for view in got
                        for k, t in ((0, pa.list_(pa.int32())), (1, pa.list_(pa.float32())))
                    ),
                    batch.column(2),
                    batch.column(3),
                ],
                ["text_at", "text_value", "meta_at", "meta_value", "label", "fold"],
            )

    sample = saved(
        with_label.unionByName(without)
        .select("data", "meta", "label", fold.alias("fold"))
        .mapInArrow(
            features,
            "text_at array<int>, text_value array<float>, meta_at array<int>, "
            "meta_value array<float>, label int, fold int",
        ),
        "sample",
    )

    def fit(batches):
        views, y, folds = [[], []], [], []
        for batch in batches:
            for v in (0, 1):
                for at, value in zip(batch.column(2 * v), batch.column(2 * v + 1)):
                    views[v].append(
                        (at.values.to_numpy().astype(np.int64), value.values.to_numpy().astype(float))
                    )
            y += batch.column(4).to_pylist()
            folds += batch.column(5).to_pylist()
        model = co_train(views, np.array(y, int), np.array(folds, int), rounds, sure)
        yield pa.RecordBatch.from_pylist([{"model": pickle.dumps(model)}])

    # The sample is bounded, and so is the model.
    row = sample.repartition(1).mapInArrow(fit, "model binary").first()
    return pickle.loads(row["model"]) if row else Model(None, None, 0.0, 1.0)


def classified(
    docs: DataFrame,
    model: Model,
    meta: Sequence[str],
    text: str = "text",
    id_col: str = "doc_id",
    keep: float = KEEP,
) -> DataFrame:
    """(id, text_score, meta_score, score, kept) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    id_type = docs.schema[id_col].dataType.simpleString()

    def score(batches):
        for batch in batches:
            views = [
                Rows([text_features(d.as_py()) for d in batch.column(1)], WIDTHS[0]),
                Rows([meta_features(list(m.as_py().values())) for m in batch.column(2)], WIDTHS[1]),
            ]
            parts = shared.value.score(views)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(p, pa.float64()) for p in parts)],
                ["id", "text_score", "meta_score", "score"],
            )

    return (
        docs.select(
            F.col(id_col).alias("id"),
            bytes_of(text).alias("data"),
            F.struct(*(F.col(c).alias(f"m{k}") for k, c in enumerate(meta))).alias("meta"),
        )
        .mapInArrow(score, f"id {id_type}, text_score double, meta_score double, score double")
        .withColumn("kept", F.col("score") >= keep)
    )
