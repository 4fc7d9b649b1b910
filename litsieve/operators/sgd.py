"""Linear classifiers by seeded stochastic gradient descent.

One epoch is one job: every block of rows is passed over in a seeded order, all blocks from
the same weights, and the weights they end with are averaged by their numbers of rows. A set
of at most ``block`` rows, as the published ones were, is one block and the pass is the plain
sequential one. Averages are sums of fixed-point numbers, so that the result depends neither
on the order of addition nor on the partitions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasSeed, HasWeightCol
from pyspark.sql import Column, DataFrame, functions as F

from litsieve.operators import blocks

#: Bits after the point of a weight that is added up.
_POINT = 40
# An intercept moves by this share of a step where vectors are sparse. Fixed value.
INTERCEPT_DECAY = 0.01
# Epochs without gain after which a fit with a tolerance ends. Fixed value.
PATIENCE = 5


def _log(z: float) -> tuple[float, float]:
    """(loss, minus its slope) of a margin times its sign."""
    if z < -30.0:
        return -z, 1.0
    return math.log1p(math.exp(-z)), 1.0 / (1.0 + math.exp(min(z, 700.0)))


def _hinge(z: float) -> tuple[float, float]:
    return (1.0 - z, 1.0) if z <= 1.0 else (0.0, 0.0)


LOSSES: dict[str, Callable[[float], tuple[float, float]]] = {"log": _log, "hinge": _hinge}


def first_step(alpha: float, loss: str) -> float:
    """Where the schedule 1 / (alpha (first + steps so far)) begins.

    Chosen so that the first step is of the size of a typical weight.
    """
    typical = math.sqrt(1.0 / math.sqrt(alpha))
    slope = -LOSSES[loss](-typical)[1]
    return 1.0 / (typical / max(1.0, slope) * alpha)


def descend(rows: blocks.Rows, order: np.ndarray, weights: np.ndarray, intercept: float, steps: int,
            alpha: float, loss: str) -> tuple[np.ndarray, float, float]:
    """(weights, intercept, sum of losses) after one pass in the given order.

    The penalty shrinks all weights at each step; it is kept as one factor.
    """
    value, first = LOSSES[loss], first_step(alpha, loss)
    w, b, factor, total = weights.copy(), intercept, 1.0, 0.0
    signs, starts, terms = np.where(rows.labels > 0, 1.0, -1.0), rows.starts, rows.terms
    for k, i in enumerate(order):
        at = terms[starts[i] : starts[i + 1]]
        step = 1.0 / (alpha * (first + steps + k))
        cost, slope = value(signs[i] * (factor * w[at].sum() + b))
        total += cost * rows.weights[i]
        factor *= max(0.0, 1.0 - step * alpha)
        if factor < 1e-9:
            w *= factor
            factor = 1.0
        if slope:
            move = step * slope * signs[i] * rows.weights[i]
            w[at] += move / factor
            b += move * INTERCEPT_DECAY
    return w * factor, b, total


def _epoch(epoch: int, seed: int, weights: np.ndarray, intercept: float, total: int, alpha: float,
           loss: str) -> Callable[[blocks.Batches], blocks.Batches]:
    """(feature, part): each block's share of the next weights; -1 the intercept, -2 the loss."""

    def run(batches: blocks.Batches) -> blocks.Batches:
        for batch in batches:
            for rows in blocks.unpack(batch):
                order = np.random.default_rng([seed, epoch, rows.block]).permutation(len(rows))
                w, b, cost = descend(rows, order, weights, intercept, epoch * len(rows), alpha, loss)
                parts = np.append(np.append(w, b) * len(rows), cost) / total
                names = np.append(np.arange(len(w), dtype=np.int64), [-1, -2])
                fixed = np.rint(parts * 2.0**_POINT).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(fixed)], ["feature", "part"])

    return run


def fit_linear(packed: DataFrame, features: int, loss: str, alpha: float, epochs: int,
               tol: float | None = None, seed: int = 0) -> tuple[np.ndarray, float, list[float]]:
    """(weights, intercept, mean loss of each epoch) over packed blocks.

    With a tolerance the fit ends after ``PATIENCE`` epochs whose loss is not below the least one by
    it. What reaches the driver is one number per feature.
    """
    packed = packed.persist()
    try:
        total = int(packed.agg(F.sum(F.length("labels") / 8)).first()[0] or 0)
        weights, intercept, losses, bad = np.zeros(features), 0.0, [], 0
        best = math.inf
        for epoch in range(epochs if total else 0):
            step = _epoch(epoch, seed, weights, intercept, total, alpha, loss)
            sums = packed.mapInArrow(step, "feature bigint, part bigint").groupBy("feature").agg(F.sum("part").alias("part"))
            got = sums.toArrow()
            names, parts = (got.column(c).to_numpy() for c in ("feature", "part"))
            values = parts / 2.0**_POINT
            weights = np.zeros(features)
            weights[names[names >= 0]] = values[names >= 0]
            intercept = float(values[names == -1][0])
            losses.append(float(values[names == -2][0]))
            if tol is not None:
                bad = bad + 1 if losses[-1] > best - tol else 0
                best = min(best, losses[-1])
                if bad >= PATIENCE:
                    break
        return weights, intercept, losses
    finally:
        packed.unpersist()


class _SgdParams(HasFeaturesCol, HasLabelCol, HasWeightCol, HasSeed):
    loss = Param(Params._dummy(), "loss", "log or hinge", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "weight of the L2 penalty", TypeConverters.toFloat)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows, at most", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "gain in mean loss that counts; negative: no early end", TypeConverters.toFloat)
    block = Param(Params._dummy(), "block", "rows of one sequential pass, at most", TypeConverters.toInt)


class SgdClassifier(Estimator, _SgdParams):
    """Linear classifier of presence vectors, by gradient steps that fall as 1 / t."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", weightCol: str | None = None,
                 seed: int = 0, loss: str = "log", alpha: float = 0.0001, epochs: int = 5, tol: float = -1.0,
                 block: int = 1 << 16):
        super().__init__()
        self._setDefault(seed=0, loss="log", alpha=0.0001, epochs=5, tol=-1.0, block=1 << 16)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LinearModel:
        get = self.getOrDefault
        if get("loss") not in LOSSES:
            raise ValueError(f"unknown loss {get('loss')!r}")
        weight = get("weightCol") if self.isDefined("weightCol") else None
        packed = blocks.pack(dataset, get("block"), get("featuresCol"), get("labelCol"), weight, get("seed"))
        # vectors have as many places as the model that made them has terms
        one = dataset.select(get("featuresCol")).first()
        tol = get("tol") if get("tol") >= 0 else None
        weights, intercept, losses = fit_linear(
            packed, one[0].size if one else 0, get("loss"), get("alpha"), get("epochs"), tol, get("seed")
        )
        return self._copyValues(LinearModel(weights, intercept, losses))


class LinearModel(Model, _SgdParams):
    def __init__(self, weights: np.ndarray | None = None, intercept: float = 0.0, losses: list[float] | None = None):
        super().__init__()
        self._setDefault(seed=0, loss="log", alpha=0.0001, epochs=5, tol=-1.0, block=1 << 16)
        self.coefficients = DenseVector(np.zeros(0) if weights is None else weights)
        self.intercept = intercept
        self.losses = losses or []

    def margin(self) -> Column:
        weights, intercept = self.coefficients.toArray(), self.intercept

        def score(starts: np.ndarray, terms: np.ndarray) -> np.ndarray:
            row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            return np.bincount(row, weights=weights[terms], minlength=len(starts) - 1) + intercept

        return blocks.over_vectors(score)(self.getOrDefault("featuresCol"))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_margin(dataset, self.margin())


def with_margin(dataset: DataFrame, margin: Column) -> DataFrame:
    """Add rawPrediction and prediction, as other classifiers do."""
    out = dataset.withColumn("rawPrediction", margin)
    return out.withColumns({
        "prediction": (F.col("rawPrediction") > 0).cast("double"),
        "rawPrediction": array_to_vector(F.array(-F.col("rawPrediction"), F.col("rawPrediction"))),
    })
