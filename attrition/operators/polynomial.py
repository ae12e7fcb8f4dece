"""A margin machine on all products of up to ``degree`` features, without a table of the products.

Of 32 features there are 6,544 products of degree three, 50 kB a row. They are made anew in each step, some hundred rows
at a time: with a constant in front of the features, every product is one of ``degree`` entries. Those of all but the last
entry (``heads``) times the last one give margins and gradients as products of matrices. Rows are kept as packed features, 256 bytes
each. A step is a Spark job that returns one gradient for each task; the driver holds only weights and a few gradients.

The loss is the mean hinge loss, with a penalty on the squared weights of the products in units of their deviation; the constant
bears none. Steps are those of L-BFGS.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.sources.scratch import pinned

#: Rows whose products are made at once, and rows of a task.
CHUNK_ROWS, ROWS_PER_TASK = 128, 16_384
MEMORY, TOLERANCE = 10, 1e-6


class Products:
    """All products of ``degree`` entries of (1, features): ``heads`` by last entry."""

    def __init__(self, width: int, degree: int):
        self.heads = np.array(list(combinations_with_replacement(range(width + 1), degree - 1)), np.int64).reshape(-1, degree - 1)
        last = self.heads[:, -1] if degree > 1 else np.zeros(1, np.int64)
        #: Each product once: the last entry is none before the ones ahead of it. The first one of all is the constant.
        self.allowed = np.arange(width + 1)[None, :] >= last[:, None]

    def of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        z = np.concatenate([np.ones((len(x), 1)), x], axis=1)
        head = np.ones((len(x), len(self.heads)))
        for column in self.heads.T:
            head *= z[:, column]
        return head, z

    def table(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.allowed.shape)
        out[self.allowed] = weights
        return out

    def margins(self, x: np.ndarray, table: np.ndarray) -> np.ndarray:
        parts = [np.zeros(0)]
        for i in range(0, len(x), CHUNK_ROWS):
            head, z = self.of(x[i : i + CHUNK_ROWS])
            parts.append((head * (z @ table.T)).sum(axis=1))
        return np.concatenate(parts)


def _packed(rows: DataFrame, features: str, label: str) -> DataFrame:
    """Features and labels of the rows as bytes, a row of this table for each batch."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.asarray(batch.column(0).flatten(), np.float64)
                y = np.asarray(batch.column(1), np.float64)
                yield pa.RecordBatch.from_pydict(
                    {"x": pa.array([x.tobytes()], pa.binary()), "y": pa.array([y.tobytes()], pa.binary())}
                )

    return rows.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y")).mapInArrow(pack, "x binary, y binary")


def _sums(packed: DataFrame, part: Callable[[np.ndarray, np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """``part`` of all rows, added up in the tasks and then in a fixed order."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for x, y in zip(batch["x"], batch["y"]):
                x, y = np.frombuffer(x).reshape(-1, width), np.frombuffer(y)
                for i in range(0, len(y), CHUNK_ROWS):
                    found = part(x[i : i + CHUNK_ROWS], y[i : i + CHUNK_ROWS])
                    total = found if total is None else total + found
        if total is not None:
            yield pd.DataFrame({"total": [total.tobytes()]})

    rows = packed.mapInPandas(add, "total binary").toPandas()["total"]
    return sum((np.frombuffer(r) for r in rows[1:]), np.frombuffer(rows[0]).copy())


def minimum(
    evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int
) -> np.ndarray:
    """L-BFGS with halved steps. A step that does not help is tried again along the gradient alone."""
    at, (value, gradient) = start, evaluate(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    values = [value]
    turn = 0
    while turn < max_iter and np.abs(gradient).max() > 1e-12:
        way, shares = gradient.copy(), []
        for s, y in reversed(moves):
            shares.append((s @ way) / (s @ y))
            way -= shares[-1] * y
        if moves:
            s, y = moves[-1]
            way *= (s @ y) / (y @ y)
        for (s, y), share in zip(moves, reversed(shares)):
            way += (share - (y @ way) / (s @ y)) * s
        slope = -(gradient @ way)
        step = 1.0 if moves else 1.0 / max(1.0, float(np.linalg.norm(gradient)))
        for _ in range(20):
            there = at - step * way
            new_value, new_gradient = evaluate(there)
            if new_value <= value + 1e-4 * step * slope:
                break
            step /= 2
        else:
            if not moves:
                break
            moves = []
            continue
        s, y = there - at, new_gradient - gradient
        if s @ y > 1e-10 * (y @ y):
            moves = [*moves, (s, y)][-MEMORY:]
        at, value, gradient = there, new_value, new_gradient
        values.append(value)
        turn += 1
        if turn >= 5 and values[-6] - value <= TOLERANCE * max(abs(value), 1e-12):
            break
    return at


class _MachineParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    degree = Param(Params._dummy(), "degree", "most factors of a product", TypeConverters.toInt)


class PolynomialMachine(Estimator, _MachineParams):
    """Linear machine on all products of up to ``degree`` features; labels are 0 and 1."""

    labelCol = Param(Params._dummy(), "labelCol", "0 or 1", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "most steps", TypeConverters.toInt)
    regParam = Param(Params._dummy(), "regParam", "strength of the penalty", TypeConverters.toFloat)

    def __init__(self, featuresCol="features", labelCol="label", degree=3, maxIter=100, regParam=0.0):
        super().__init__()
        if degree < 1:
            raise ValueError(f"degree {degree}")
        self._set(featuresCol=featuresCol, labelCol=labelCol, degree=degree, maxIter=maxIter, regParam=regParam)

    def _fit(self, df: DataFrame) -> PolynomialMachineModel:
        features, label = self.getOrDefault("featuresCol"), self.getOrDefault("labelCol")
        degree, reg = self.getOrDefault("degree"), self.getOrDefault("regParam")
        y = F.col(label).cast("double")
        vector = vector_to_array(features)
        n, wrong, width = df.agg(
            F.count(F.lit(1)), F.count_if(y.isNull() | ~y.isin(0.0, 1.0)), F.max(F.size(vector))
        ).first()
        if not n or wrong:
            raise ValueError(f"{n} rows, of which {wrong} are of no class 0 or 1")
        products = Products(width, degree)

        def moments(x, y):
            head, z = products.of(x)
            return np.stack([(head.T @ z)[products.allowed], ((head**2).T @ z**2)[products.allowed]]).ravel()

        tasks = max(1, math.ceil(n / ROWS_PER_TASK))
        with pinned(_packed(df.repartition(tasks), features, label)) as rows:
            first, second = _sums(rows, moments, width).reshape(2, -1) / n
            spread = second - first**2
            # What does not vary has no weight; nor has the constant, which bears no penalty.
            varies = spread > 1e-12 * np.maximum(second, 1e-300)
            unit = np.where(varies, 1 / np.sqrt(np.where(varies, spread * n / max(n - 1, 1), 1.0)), 0.0)
            unit[0] = 1.0

            def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
                shared = df.sparkSession.sparkContext.broadcast(products.table(weights * unit))

                def hinge(x, y):
                    sign = 2 * y - 1
                    head, z = products.of(x)
                    loss = 1 - sign * (head * (z @ shared.value.T)).sum(axis=1)
                    on = loss > 0
                    slope = (head[on] * -sign[on, None]).T @ z[on]
                    return np.concatenate([[loss[on].sum()], slope[products.allowed]])

                total = _sums(rows, hinge, width) / n
                shared.destroy()
                bound = weights.copy()
                bound[0] = 0.0
                return float(total[0] + 0.5 * reg * (bound @ bound)), total[1:] * unit + reg * bound

            found = minimum(evaluate, np.zeros(len(unit)), self.getOrDefault("maxIter"))
        return PolynomialMachineModel(features, degree, (found * unit).tolist())


class PolynomialMachineModel(Model, _MachineParams, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction``, the margins of both classes, and ``prediction``."""

    weights = Param(Params._dummy(), "weights", "of the products, the constant first", TypeConverters.toListFloat)

    def __init__(self, featuresCol=None, degree=None, weights=None):
        super().__init__()
        if weights is not None:
            self._set(featuresCol=featuresCol, degree=degree, weights=weights)

    def _transform(self, df: DataFrame) -> DataFrame:
        degree, weights = self.getOrDefault("degree"), np.array(self.getOrDefault("weights"))
        width = 0
        while math.comb(width + 1 + degree - 1, degree) < len(weights):
            width += 1
        known = df.sparkSession.sparkContext.broadcast((width, degree, weights))

        @F.pandas_udf("double")
        def margin(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            width, degree, weights = known.value
            products = Products(width, degree)
            table = products.table(weights)
            for vectors in batches:
                x = np.array(vectors.to_list(), np.float64).reshape(-1, width)
                yield pd.Series(products.margins(x, table))

        value = F.col("_margin")
        return (
            df.withColumn("_margin", margin(vector_to_array(self.getOrDefault("featuresCol"))))
            .withColumn("rawPrediction", array_to_vector(F.array(-value, value)))
            .withColumn("prediction", (value > 0).cast("double"))
            .drop("_margin")
        )
