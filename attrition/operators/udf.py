"""Python models applied to a vector column in Arrow batches.

The model is shipped once per executor as a broadcast variable, restored once per task and called
once per batch. It is pickled by value where possible, so it may be defined in a notebook.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.schemas import PREDICTION


def _as_array(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return c if df.schema[column].dataType.typeName() == "array" else vector_to_array(c)


def _batch(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.to_list(), dtype=np.float64)


def score_with(
    df: DataFrame, predictor, column: str = "scaled_features", output: str = PREDICTION
) -> DataFrame:
    """Append ``predictor.predict(matrix)``; any object with a vectorised ``predict`` will do."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(predictor))

    @F.pandas_udf("double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pickle.loads(shared.value)
        for vectors in batches:
            yield pd.Series(
                np.asarray(model.predict(_batch(vectors)), dtype=np.float64)
                if len(vectors) else np.empty(0)
            )

    return df.withColumn(output, predict(_as_array(df, column)))


def scale_with(
    df: DataFrame, scaler, column: str = "features", output: str = "scaled_features"
) -> DataFrame:
    """Append ``scaler.transform(matrix)`` as an array of doubles."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(scaler))

    @F.pandas_udf("array<double>")
    def scale(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = pickle.loads(shared.value)
        for vectors in batches:
            yield pd.Series(
                list(np.asarray(model.transform(_batch(vectors)), dtype=np.float64))
                if len(vectors) else [], dtype=object,
            )

    return df.withColumn(output, scale(_as_array(df, column)))
