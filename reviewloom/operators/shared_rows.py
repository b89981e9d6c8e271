"""Logistic regression over occurrences that share the features of their text.

``LogisticRegression`` wants a row with all features for each occurrence and keeps its own copy
of them, so a text's term weights are held, and multiplied in each iteration, once per occurrence:
the square of its length. Here a row is a text with its weights and its occurrences. A margin is
the sum of what the text and what the occurrence add to it, so the weights of a text are
multiplied once an iteration, and its gradient takes the summed residuals of its occurrences.

Objective, centring, penalty, start and steps are those of ``LogisticRegression`` with an
intercept, standardised features and the L2 penalty (L-BFGS of ten pairs, strong Wolfe line
search), and so is the model that comes out. Sums over the rows are made by tasks and met in a
tree; the driver holds coefficients only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame

# Of the optimiser: pairs kept, tolerance, and the line search.
PAIRS, TOLERANCE = 10, 1e-6
DECREASE, CURVATURE, TRIES = 1e-4, 0.9, 10
# Texts and occurrences that a task holds at a time.
TEXTS_HELD, OCCURRENCES_HELD = 2_000, 50_000
# Below this share of its mean square the variance of a feature is rounding.
ROUNDING = 1e-12

#: What is read: the term weights of a text as ``indices`` and ``values``, and of its occurrences
#: the ``labels`` and ``own``, the indices of their own features, which are one where they are set.
COLUMNS = ("indices", "values", "labels", "own")


class _SearchFailed(ArithmeticError):
    """No step along the direction meets the conditions."""


@dataclass(frozen=True)
class _Shape:
    own: int
    terms: int
    classes: int

    @property
    def columns(self) -> int:
        """Two classes have one column of coefficients, more have one each."""
        return self.classes if self.classes > 2 else 1


def _summed(table: DataFrame, size: int, of_chunk: Callable[..., np.ndarray], terms: int) -> np.ndarray:
    """The sum of ``of_chunk`` over the rows of the table, for chunks of bounded size."""
    texts_held, occurrences_held, names = TEXTS_HELD, OCCURRENCES_HELD, COLUMNS

    def chunk(batch: pa.RecordBatch) -> np.ndarray:
        indices, values, labels, own = (batch.column(batch.schema.get_field_index(x)) for x in names)
        per_text = labels.value_lengths().to_numpy(zero_copy_only=False)
        weights = np.zeros((batch.num_rows, terms))
        at = np.repeat(np.arange(batch.num_rows), indices.value_lengths().to_numpy(zero_copy_only=False))
        weights[at, indices.flatten().to_numpy(zero_copy_only=False)] = values.flatten().to_numpy(zero_copy_only=False)
        each = own.flatten()
        return of_chunk(
            weights, per_text, labels.flatten().to_numpy(zero_copy_only=False),
            each.flatten().to_numpy(zero_copy_only=False), each.value_lengths().to_numpy(zero_copy_only=False),
        )

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ends = np.cumsum(batch.column(batch.schema.get_field_index("labels")).value_lengths().to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + occurrences_held, "right")))
            stop = min(stop, start + texts_held)
            yield batch.slice(start, stop - start)
            start = stop

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            for part in cut(batch):
                total += chunk(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    partials = table.select(*COLUMNS).mapInArrow(partial, "sums BINARY").rdd
    return partials.map(lambda r: np.frombuffer(bytes(r["sums"]))).treeReduce(lambda a, b: a + b)


def _totals(table: DataFrame, shape: _Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Occurrences of each label, and the sums of the features and of their squares."""
    own, terms, classes = shape.own, shape.terms, shape.classes

    def of_chunk(weights, per_text, labels, flat, _) -> np.ndarray:
        set_ = np.bincount(flat, minlength=own).astype(float)
        counts = np.bincount(labels, minlength=classes).astype(float)
        return np.concatenate([counts, set_, per_text @ weights, set_, per_text @ np.square(weights)])

    sums = _summed(table, classes + 2 * (own + terms), of_chunk, terms)
    return sums[:classes], *np.split(sums[classes:], 2)


def _loss(table: DataFrame, shape: _Shape, coefficients: np.ndarray, intercept: np.ndarray):
    """The summed loss and its gradients by coefficient, one row for a feature, and by intercept."""
    own, terms, columns = shape.own, shape.terms, shape.columns
    sent = table.sparkSession.sparkContext.broadcast((coefficients, intercept))

    def of_chunk(weights, per_text, labels, flat, lengths) -> np.ndarray:
        w, b = sent.value
        margins = np.repeat(weights @ w[own:] + b, per_text, axis=0)
        margins += np.add.reduceat(w[flat], np.cumsum(lengths) - lengths, axis=0)
        if columns == 1:
            margins = np.concatenate([np.zeros_like(margins), margins], axis=1)
        margins -= margins.max(axis=1, keepdims=True)
        rows = np.arange(len(labels))
        right = margins[rows, labels]
        np.exp(margins, out=margins)
        norm = margins.sum(axis=1)
        residual = margins / norm[:, None]
        residual[rows, labels] -= 1
        residual = residual[:, -columns:]
        place = np.repeat(rows, lengths)
        by_own = np.stack([np.bincount(flat, c[place], own) for c in np.ascontiguousarray(residual.T)], axis=1)
        by_text = weights.T @ np.add.reduceat(residual, np.cumsum(per_text) - per_text, axis=0)
        loss = (np.log(norm) - right).sum()
        return np.concatenate([[loss], by_own.ravel(), by_text.ravel(), residual.sum(axis=0)])

    size = (own + terms) * columns
    sums = _summed(table, 1 + size + columns, of_chunk, terms)
    sent.destroy()
    return sums[0], sums[1 : 1 + size].reshape(own + terms, columns), sums[1 + size :]


def _between(a: tuple, b: tuple) -> float:
    """The least point of the cubic through two points (step, slope, value), not too near to either."""
    (t, slope, value), (t2, slope2, value2) = sorted((a, b))
    d1 = slope + slope2 - 3 * (value - value2) / (t - t2)
    d2 = np.sqrt(max(d1 * d1 - slope * slope2, 0.0))
    with np.errstate(all="ignore"):
        found = t2 - (t2 - t) * (slope2 + d2 - d1) / (slope2 - slope + 2 * d2)
    return float(np.clip(np.nan_to_num(found, nan=(t + t2) / 2), t + 0.1 * (t2 - t), t + 0.9 * (t2 - t)))


def _step(phi: Callable[[float], tuple], start: tuple, first: float) -> float:
    """A step that meets the strong Wolfe conditions."""
    _, slope, value = start
    if slope > 0:
        raise _SearchFailed

    def zoom(low: tuple, high: tuple) -> float:
        for _ in range(TRIES):
            c = phi(_between(low, high))
            if c[2] > value + DECREASE * c[0] * slope or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= CURVATURE * abs(slope):
                    return c[0]
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise _SearchFailed

    low, t = start, first
    for i in range(TRIES):
        c = phi(t)
        if not np.isfinite(c[2]):
            t /= 2
            continue
        if c[2] > value + DECREASE * t * slope or (c[2] >= low[2] and i > 0):
            return zoom(low, c)
        if abs(c[1]) <= CURVATURE * abs(slope):
            return c[0]
        if c[1] >= 0:
            return zoom(c, low)
        low, t = c, t * 1.5
    raise _SearchFailed


def _direction(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the gradient by the inverse curvature of the pairs, the newest first."""
    out, kept = gradient.copy(), []
    for s, y in pairs:
        a = (s @ out) / (s @ y)
        out -= a * y
        kept.append(a)
    if pairs:
        s, y = pairs[0]
        out *= (s @ y) / (y @ y)
    for (s, y), a in zip(reversed(pairs), reversed(kept), strict=True):
        out += (a - (y @ out) / (s @ y)) * s
    return -out


def minimise(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int) -> np.ndarray:
    """At most so many steps of L-BFGS from ``x``; ``f`` gives value and gradient."""
    value, gradient = f(x)
    pairs, done, failed = [], 0, False
    while done < steps and np.linalg.norm(gradient) > max(TOLERANCE * abs(value), 1e-8):
        direction, seen = _direction(gradient, pairs), {}

        def phi(t: float, x=x, direction=direction, seen=seen) -> tuple[float, float, float]:
            seen["at"] = t, *f(x + t * direction)
            return t, float(seen["at"][2] @ direction), seen["at"][1]

        try:
            first = 1.0 if done else 1.0 / np.linalg.norm(direction)
            t = _step(phi, (0.0, float(gradient @ direction), value), first)
            if t * np.linalg.norm(gradient) < 1e-10:
                raise _SearchFailed
        except _SearchFailed:
            if failed:
                break
            pairs, failed = [], True
            continue
        if seen["at"][0] != t:
            phi(t)
        before, (_, value, now) = gradient, seen["at"]
        pairs = [(t * direction, now - before), *pairs][:PAIRS]
        x, gradient, done, failed = x + t * direction, now, done + 1, False
    return x


def fit(
    table: DataFrame, own: int, terms: int, classes: int, steps: int, penalty: float
) -> LogisticRegressionModel:
    """The model of the occurrences in ``table`` (``COLUMNS``; no text without one), with ``own``
    features of theirs ahead of the ``terms`` of their text. It is read once a step and should be
    a written table; there are two classes at least."""
    shape = _Shape(own, terms, classes)
    counts, sums, squares = _totals(table, shape)
    n = counts.sum()
    mean = sums / n
    variance = squares / n - mean * mean
    variance[variance <= ROUNDING * squares / n] = 0.0
    deviation = np.sqrt(variance * (n / max(n - 1, 1)))
    scale = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)[:, None]
    middle = mean[:, None] * scale
    features = own + terms

    def split(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[:-shape.columns].reshape(features, shape.columns), x[-shape.columns :]

    def objective(x: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = split(x)
        loss, by_feature, by_class = _loss(table, shape, w * scale, b - (w * middle).sum(axis=0))
        gradient = (by_feature * scale - middle * by_class) / n + penalty * w
        return loss / n + penalty / 2 * (w * w).sum(), np.concatenate([gradient.ravel(), by_class / n])

    if classes > 2:
        start = np.log1p(counts)
        start -= start.mean()
    else:
        start = np.log(counts[1:] / counts[:1])
    w, b = split(minimise(objective, np.concatenate([np.zeros(features * shape.columns), start]), steps))
    intercept = b - (w * middle).sum(axis=0)
    if classes > 2:
        intercept -= intercept.mean()
    context = table.sparkSession.sparkContext
    # by rows, as the model of two classes wants it
    matrix = DenseMatrix(shape.columns, features, (w * scale).T.ravel(), True)
    java = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", f"LogisticRegression_{uuid.uuid4().hex[:12]}",
        _py2java(context, matrix), _py2java(context, DenseVector(intercept)), classes, classes > 2,
    )
    return LogisticRegressionModel(java)
