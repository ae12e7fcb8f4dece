"""Reports that follow a stream of predictions.

Each report is a grouped aggregate in complete mode: its state has one entry per report row, not
per prediction. Every batch writes the whole report to a folder of its own and removes the one that
is ``KEPT`` batches older; readers take the newest finished folder by its name.

All reports come from one query, which reads the source once: each prediction names the row that it belongs to in
every report, and one aggregation with one state counts and sums them all. A report of a user's own
is a query of its own (:func:`start_report`).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from attrition.functions.columns import label_map, mapped
from attrition.plans.reports import (
    CHURN_NAMES,
    GENDER_NAMES,
    churn_by_age,
    churn_by_gender,
    credit_histogram,
    histogram_bin,
    prediction_counts,
    products_by_prediction,
    with_bin_edges,
    with_known_classes,
)
from attrition.schemas import PREDICTION, PREDICTION_SCHEMA
from attrition.sources.scratch import pinned
from attrition.streaming.scoring import start_stream

# Finished states of a report that stay.
KEPT = 5
# Range of the score scale. Bins cannot move once a stream has started.
CREDIT_SCORE_RANGE = (300.0, 850.0)

LIVE_REPORTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "prediction_counts": prediction_counts,
    "churn_by_gender": churn_by_gender,
    "credit_histogram": lambda df: credit_histogram(
        df, 30, CREDIT_SCORE_RANGE[0], CREDIT_SCORE_RANGE[1]
    ),
    "churn_by_age": churn_by_age,
    "products_by_prediction": products_by_prediction,
}


# What a report's reader adds to each state.
FINISH: dict[Callable, Callable[[DataFrame], DataFrame]] = {prediction_counts: with_known_classes}


def _folder(spark: SparkSession, path: str):
    """A folder of the store that Spark uses, and its file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def start_report(
    predictions: DataFrame,
    report: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    **trigger,
) -> StreamingQuery:
    def write(df: DataFrame, batch_id: int) -> None:
        _write_state(FINISH.get(report, lambda rows: rows)(df), path, batch_id)

    return start_stream(report(predictions), write, checkpoint, output_mode="complete", **trigger)


def _write_state(state: DataFrame, path: str, batch_id: int) -> None:
    # A report is small, so it becomes one file; the exchange keeps the state in parallel tasks.
    state.repartition(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    old, store = _folder(state.sparkSession, f"{path}/batch_id={batch_id - KEPT}")
    store.delete(old, True)


def _report_rows(prediction: str = PREDICTION) -> list[Column]:
    """The row of each report that a prediction counts for: two numbers that name it, and the value to average."""
    label = F.col(prediction).cast("int")
    score = F.col("CreditScore")
    position = histogram_bin(score, 30, *CREDIT_SCORE_RANGE)
    rows = {
        "prediction_counts": (label, None, None),
        "churn_by_gender": (F.col("Female").cast("int"), None, F.col(prediction)),
        # Classes without a name share one row.
        "credit_histogram": (position, F.when(label.isin(list(CHURN_NAMES)), label), None),
        "churn_by_age": (F.col("Age"), None, F.col(prediction)),
        "products_by_prediction": (F.col("NumOfProducts"), F.col(prediction), None),
    }
    none = F.lit(None).cast("double")
    structs = {
        name: F.struct(
            F.lit(name).alias("report"),
            *[(none if c is None else c.cast("double")).alias(to) for c, to in zip(parts, ("a", "b", "value"))],
        )
        for name, parts in rows.items()
    }
    structs["credit_histogram"] = F.when(position.isNotNull(), structs["credit_histogram"])
    return list(structs.values())


def report_states(predictions: DataFrame) -> DataFrame:
    """All reports' rows in one table: report, a, b, rows, values, and their sum. For tables and streams."""
    tagged = predictions.select(F.explode(F.filter(F.array(*_report_rows()), lambda r: r.isNotNull())).alias("_row"))
    return tagged.groupBy("_row.report", "_row.a", "_row.b").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("_row.value").alias("n_values"), F.sum("_row.value").alias("total")
    )


def report_of(states: DataFrame, name: str, schema: T.StructType = PREDICTION_SCHEMA) -> DataFrame:
    """One report from the table of all, as the function of that name makes it."""
    rows = states.filter(F.col("report") == name)
    mean = F.try_divide("total", "n_values").alias("churn_rate")
    if name == "prediction_counts":
        return with_known_classes(rows.select(F.col("a").cast("int").alias("prediction"), "n_rows"))
    if name == "churn_by_gender":
        return label_map(rows.select(F.col("a").cast("int").alias("Female"), mean), "Female", GENDER_NAMES, output="Gender")
    if name == "credit_histogram":
        low, high = CREDIT_SCORE_RANGE
        return with_bin_edges(
            rows.select(F.col("a").cast("int").alias("bin"), mapped(F.col("b").cast("int"), CHURN_NAMES).alias("churn_label"), "n_rows"),
            30, low, high,
        )
    if name == "churn_by_age":
        return rows.select(F.col("a").cast(schema["Age"].dataType).alias("Age"), mean)
    return rows.select(
        F.col("a").cast(schema["NumOfProducts"].dataType).alias("NumOfProducts"), F.col("b").alias("prediction"), "n_rows"
    )


def start_reports(
    predictions: DataFrame, base: str, names: Iterable[str] = tuple(LIVE_REPORTS), **trigger
) -> StreamingQuery:
    """One query that keeps all reports, each in a folder of its name below ``base``."""

    def write(df: DataFrame, batch_id: int) -> None:
        with pinned(df) as states:
            for name in names:
                _write_state(report_of(states, name, predictions.schema), f"{base}/{name}", batch_id)

    return start_stream(report_states(predictions), write, f"{base}/_checkpoint", output_mode="complete", **trigger)


def live_reports(
    predictions: DataFrame,
    base: str,
    reports: Mapping[str, Callable[[DataFrame], DataFrame]] = LIVE_REPORTS,
    **trigger,
) -> dict[str, StreamingQuery]:
    """The query that keeps each report over the whole log and everything that follows it: one for all known reports,
    one for each other."""
    known = [name for name, report in reports.items() if LIVE_REPORTS.get(name) is report]
    running = dict.fromkeys(known, start_reports(predictions, base, known, **trigger)) if known else {}
    return running | {
        name: start_report(predictions, report, f"{base}/{name}", f"{base}/_checkpoints/{name}", **trigger)
        for name, report in reports.items()
        if name not in running
    }


def latest_report(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished state of a report. Only its folder is read."""
    folder, store = _folder(spark, path)
    batches = sorted(
        (
            int(entry.getPath().getName().removeprefix("batch_id="))
            for entry in store.listStatus(folder)
            if entry.getPath().getName().startswith("batch_id=")
        ),
        reverse=True,
    )
    for batch in batches:
        finished, _ = _folder(spark, f"{path}/batch_id={batch}/_SUCCESS")
        if store.exists(finished):
            return spark.read.parquet(f"{path}/batch_id={batch}")
    raise FileNotFoundError(f"no finished report in {path}")
