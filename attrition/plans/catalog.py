"""Registered queries: every operator applied to whole tables of a data folder."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.errors import StreamingQueryException
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.functions import columns as C
from attrition.functions import features as X
from attrition.functions.hashing import key_or_row
from attrition.operators import approximate as A
from attrition.operators import balance as B
from attrition.operators import descent as G
from attrition.operators import encode as E
from attrition.operators import evaluate as V
from attrition.operators import group_stats as Y
from attrition.operators import neighbors as K
from attrition.operators import stats as Q
from attrition.operators import synthetic as S
from attrition.operators import udf as U
from attrition.plans import calibration as H
from attrition.plans import models as M
from attrition.plans import reports as R
from attrition.plans.accounts import accounts
from attrition.plans.preparation import (
    QUANTILE_BINS,
    RANK_BINS,
    engineer_features,
    fit_features,
    model_input,
)
from attrition.schemas import (
    FEATURE_SCHEMA,
    FEATURES,
    LABEL,
    PREDICTION,
    RAW_SCHEMA,
    SCORING_SCHEMA,
)
from attrition.sources import database as D
from attrition.sources import messages as J
from attrition.sources import tables as P
from attrition.sources.scratch import cut_lineage, shared_dir
from attrition.streaming import ledger as O
from attrition.streaming import live as L
from attrition.streaming import scoring as Z

Query = Callable[[SparkSession, str], DataFrame]

NUMBERS = ("CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary")
DIGITS = 6


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, DIGITS) for c in columns})


def _table(name: str) -> Query:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


embeddings = _table("embeddings")
events = _table("events")
orders = _table("orders")


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.remove_outliers(accounts(spark, sf_dir))


def featured(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineer_features(kept(spark, sf_dir))


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with the rule "50 or older leaves" as prediction."""
    return accounts(spark, sf_dir).withColumns(
        {"Female": F.col("Gender") == "Female", PREDICTION: (F.col("Age") >= 50).cast("double")}
    )


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction records by the same rule."""
    return C.bool_to_int(featured(spark, sf_dir).drop(LABEL)).withColumn(
        PREDICTION, (F.col("Age") >= 50).cast("double")
    )


def training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model input, written once: training reads it many times."""
    return cut_lineage(model_input(featured(spark, sf_dir)))


def _over_accounts(change: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: change(accounts(spark, sf_dir))


def _over_ruled(change: Callable[[DataFrame], DataFrame], *rounded: str) -> Query:
    return lambda spark, sf_dir: _rounded(change(ruled(spark, sf_dir)), *rounded)


def _elements(df: DataFrame, column: str, digits: int | None = None) -> DataFrame:
    """A vector or array column as (CustomerId, position, value) rows."""
    c = F.col(column) if df.schema[column].dataType.typeName() == "array" else vector_to_array(column)
    rows = df.select("CustomerId", F.posexplode(c).alias("position", "value"))
    return rows if digits is None else _rounded(rows, "value")


# --- sources and sinks ---------------------------------------------------------------------


def read_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "raw")
    raw = accounts(spark, sf_dir).withColumn("RowNumber", F.col("CustomerId"))
    P.write_table(raw.select(*RAW_SCHEMA.fieldNames()), path, "csv")
    return P.read_table(spark, path, "csv", RAW_SCHEMA)


def write_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "features")
    df = featured(spark, sf_dir)
    P.write_table(df, path, "csv")
    schema = T.StructType([f for f in FEATURE_SCHEMA if f.name in df.columns])
    return P.read_table(spark, path, "csv", schema)


def decode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return J.decode_json(events(spark, sf_dir), schema, "props", keep=["event_id"])


def encode_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = events(spark, sf_dir).select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("event_type"),
        (F.col("value") > 10).alias("large"),
    )
    return J.encode_json(df, key="event_id").select(
        F.col("key").cast("bigint").alias("event_id"), "value"
    )


BATCHES = 4


def _message_files(df: DataFrame, name: str) -> str:
    """JSON lines, one file per core, that a stream reads in a few batches."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    J.write_topic(df.repartition(spark.sparkContext.defaultParallelism), {"path": path}, "text")
    return path


def _stream_options(spark: SparkSession, path: str) -> dict[str, str]:
    files = max(1, spark.sparkContext.defaultParallelism // BATCHES)
    return {"path": path, "maxFilesPerTrigger": str(files)}


def read_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _message_files(predicted(spark, sf_dir), "predictions")
    return J.read_predictions(spark, "text", {"path": path})


def _stream_to_table(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over the files at hand and read what it wrote."""
    spark = df.sparkSession
    out = shared_dir(spark, name)
    query = Z.start_stream(
        df, Z.files_sink(f"{out}/data"), f"{out}/checkpoint", available_now=True
    )
    Z.await_stream(query)
    return spark.read.parquet(f"{out}/data").drop("batch_id")


def _file_stream(spark: SparkSession, path: str) -> DataFrame:
    return J.stream_source(spark, "text", _stream_options(spark, path))


def tail_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _message_files(predicted(spark, sf_dir), "predictions")
    stream = J.tail_predictions(spark, "text", _stream_options(spark, path))
    return _stream_to_table(stream, "tail")


def last_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return D.last_per_key(rows, "o_custkey", "o_orderkey")


# --- columns and features ------------------------------------------------------------------


def fill_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = accounts(spark, sf_dir).select(
        "CustomerId",
        F.nullif("Gender", F.lit("Male")).alias("Gender"),
        F.nullif("Tenure", F.lit(0)).alias("Tenure"),
        F.when(F.col("Age") >= 40, F.col("Balance")).alias("Balance"),
    )
    return C.fill_nulls(gaps)


def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = accounts(spark, sf_dir).select("CustomerId", "NumOfProducts")
    return C.label_map(df, "NumOfProducts", {1: "one", 2: "two"}, output="products")


# Known without a session: the record's fields that are neither given, nor bins, nor levels.
_BINS = {output for output, _ in QUANTILE_BINS.values()} | {RANK_BINS[1]}
ROW_FEATURE_NAMES = [
    c for c in FEATURES
    if c not in RAW_SCHEMA.fieldNames() and c not in C.BOOLEAN_COLUMNS and c not in _BINS
]


def _row_feature(name: str) -> Query:
    return lambda spark, sf_dir: kept(spark, sf_dir).select(
        "CustomerId", X.row_features()[name].alias(name)
    )


def _quantile_feature(column: str) -> Query:
    output, bins = QUANTILE_BINS[column]

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = kept(spark, sf_dir)
        return E.QuantileCut([column], [output], [bins]).fit(df).transform(df).select(
            "CustomerId", output
        )

    return query


def _rank_feature(spark: SparkSession, sf_dir: str) -> DataFrame:
    column, output, bins = RANK_BINS
    df = kept(spark, sf_dir)
    return E.RankCut(column, output, "CustomerId", bins).fit(df).transform(df).select(
        "CustomerId", output
    )


# --- encoding and scaling ------------------------------------------------------------------


def quantile_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = kept(spark, sf_dir)
    names = list(QUANTILE_BINS)
    outputs, bins = zip(*QUANTILE_BINS.values())
    fitted = E.QuantileCut(names, list(outputs), list(bins)).fit(df)
    return fitted.transform(df).select("CustomerId", *outputs)


def rank_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = accounts(spark, sf_dir)
    fitted = E.RankCut("Balance", "bin", "CustomerId", 20).fit(df)
    return fitted.transform(df).select("CustomerId", "Balance", "bin")


def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.label_encode(accounts(spark, sf_dir), ["Geography", "Gender"]).select(
        "CustomerId", "Geography_code", "Gender_code"
    )


def one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.one_hot(accounts(spark, sf_dir), ["Geography", "Gender"], ["Geography"]).select(
        "CustomerId", "Germany", "Spain", "Female", "Male"
    )


def attach_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratio = X.row_features()["BalanceSalary"]
    german = F.col("Geography") == "Germany"
    return X.attach_columns(
        accounts(spark, sf_dir), {"Germany": german, "BalanceSalary": ratio}
    ).select("CustomerId", "Balance", "Germany", "BalanceSalary")


def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = model_input(featured(spark, sf_dir))
    return _elements(E.assemble(df, FEATURES), "features")


def _standardize_vector(with_mean: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = training(spark, sf_dir)
        stages = M.model_pipeline(M.forest(), with_mean=with_mean).getStages()[:-1]
        fitted = M.Pipeline(stages=stages).fit(df)
        return _elements(fitted.transform(df), M.SCALED, DIGITS)

    return query


def _standardize(ddof: int) -> Query:
    return lambda spark, sf_dir: _rounded(
        E.standardize(
            accounts(spark, sf_dir).select("CustomerId", *NUMBERS), NUMBERS, ddof=ddof
        ),
        *NUMBERS,
    )


# --- split and balance ---------------------------------------------------------------------


def random_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, test = B.random_split(accounts(spark, sf_dir), (0.8, 0.2), seed=42)
    return (
        train.select("CustomerId", F.lit(0).alias("part"))
        .unionByName(test.select("CustomerId", F.lit(1).alias("part")))
    )


def _copies(df: DataFrame) -> DataFrame:
    return df.groupBy("CustomerId", LABEL).agg(F.count(F.lit(1)).alias("n_rows"))


def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        B.class_weights(accounts(spark, sf_dir)).select("CustomerId", LABEL, "weight"), "weight"
    )


def union_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = accounts(spark, sf_dir).select("CustomerId", LABEL)
    return B.union_classes(C.filter_class(df, 0), C.filter_class(df, 1))


def smoten_then_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per fold and class when balanced rows are dealt to three folds."""
    rows = S.smoten_oversample(model_input(featured(spark, sf_dir)))
    fold = B.split_part(key_or_row(rows, "CustomerId"), [1.0] * 3, 42)
    return rows.groupBy(fold.alias("fold"), LABEL).agg(F.count(F.lit(1)).alias("n_rows"))


def smoten_oversample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.smoten_oversample(model_input(featured(spark, sf_dir)))


def smoten_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three classes brought to the size of the largest, by the distance summed over the classes."""
    cls = F.when(F.col(LABEL) == 1, 2).when(F.col("NumOfProducts") <= 1, 1).otherwise(0)
    rows = model_input(featured(spark, sf_dir)).withColumn("cls", cls)
    return S.smoten_oversample(rows, label="cls")


def oversample_then_smoten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oversampled rows repeat their keys; synthetic rows make up what is missing. Rows of each class, and whether
    all new keys differ."""
    rows = model_input(featured(spark, sf_dir))
    some = B.union_classes(C.filter_class(rows, 0), B.oversample(rows, 1, 0.6))
    balanced = cut_lineage(S.smoten_oversample(some))
    new = balanced.filter("CustomerId < 0").agg(F.count(F.lit(1)), F.count_distinct("CustomerId")).first()
    return balanced.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("keys_differ", F.lit(new[0] == new[1] > 0))


# --- neighbours ----------------------------------------------------------------------------


def knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embeddings(spark, sf_dir)
    return _rounded(K.knn(df, df, 10), "dist")


def knn_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(K.knn_edges(embeddings(spark, sf_dir), 9), "dist")


def knn_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embeddings(spark, sf_dir)
    return K.knn_classify(df, df, 9, exclude_self=True)


def customer_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers of all customers, in units of about equal spread."""
    units = {"CreditScore": 160.0, "Age": 19.0, "Tenure": 3.0, "Balance": 3000.0, "NumOfProducts": 1.1, "EstimatedSalary": 110_000.0}
    vector = F.array(*[F.col(c) / F.lit(u) for c, u in units.items()])
    return accounts(spark, sf_dir).select(F.col("CustomerId").alias("vec_id"), vector.alias("embedding"))


def _graded(found: DataFrame, vectors: DataFrame, exact: DataFrame) -> DataFrame:
    """For each row: how many neighbours it has, how many of their distances are wrong, and whether
    0.9 of all true neighbours were found."""
    found = cut_lineage(found)
    (share,) = A.recall(found, exact).select("recall").first()
    # Vectors are sent as they are and become double where they meet.
    left = vectors.select(F.col("vec_id").alias("src"), F.col("embedding").alias("a"))
    right = vectors.select(F.col("vec_id").alias("dst"), F.col("embedding").alias("b"))
    apart = lambda x, y: x.cast("double") - y.cast("double")
    squares = F.aggregate(F.zip_with("a", "b", lambda x, y: apart(x, y) * apart(x, y)), F.lit(0.0), lambda t, x: t + x)
    wrong = F.abs(F.col("dist") - F.sqrt(squares)) > 1e-9
    return (
        found.join(left, "src").join(right, "dst").groupBy("src")
        .agg(F.count(F.lit(1)).alias("n_found"), F.count_if(wrong).alias("n_wrong"))
        .withColumn("recall_reached", F.lit(share is not None and share >= 0.9))
    )


def knn_approximate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = embeddings(spark, sf_dir)
    found = A.knn_approximate(df, df, 10, exclude_self=True)
    return _graded(found, df, K.knn(df, df, 10, exclude_self=True))


def knn_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact neighbours of all customers, found in cells below cells without most of the comparisons."""
    df, work = cut_lineage(customer_vectors(spark, sf_dir)), []
    n = df.count()
    # So few customers make cells below cells, too; of many the usual bounds hold.
    rows = min(K.BLOCK_ROWS, max(8, n // 60))
    found = K.knn(df, df, 5, exclude_self=True, block_rows=rows, chunk_rows=min(K.CHUNK_ROWS, 4 * rows), pivots=6, work=work, digits=DIGITS)
    # Among few rows the pivots are most of them.
    return found.withColumn("saved", F.lit(n < 400 or sum(work) < 0.75 * n * n))


def knn_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The neighbour graph of all customers by descent, from less than half of all distances."""
    df = cut_lineage(customer_vectors(spark, sf_dir))
    graph = G.neighbour_graph(df, 9)
    graded = _graded(graph.edges, df, K.knn_edges(df, 9))
    return graded.withColumn("half_of_the_work", F.lit(graph.share < 0.5))


# --- evaluation ----------------------------------------------------------------------------


def _summary(*metrics: str) -> Query:
    return _over_ruled(lambda df: V.summary_metrics(df).select(*metrics), *metrics)


def auc_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = accounts(spark, sf_dir).select(
        LABEL, (F.col("Age") + F.col("NumOfProducts") * 5.0).alias("score")
    )
    return _rounded(V.auc_roc(df, "score"), "auc")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One step per age limit from 20 to 80; rows shrink to one per age and class first."""
    ages = accounts(spark, sf_dir).groupBy("Age", LABEL).agg(F.count(F.lit(1)).alias("n"))
    steps = ages.withColumn("step", F.explode(F.sequence(F.lit(20), F.lit(80), F.lit(5))))
    runs = steps.withColumn(PREDICTION, (F.col("Age") >= F.col("step")).cast("double"))
    return V.run_history(runs, rows=F.col("n"))


def best_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        V.best_metrics(_history(spark, sf_dir)), *[f"best_{m}" for m in V.METRICS]
    )


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.metric_history(_rounded(_history(spark, sf_dir), *V.METRICS))


# --- statistics ----------------------------------------------------------------------------


def iqr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["CreditScore", "Age", "NumOfProducts", "Balance", "EstimatedSalary"]
    return _rounded(
        Q.iqr_summary(accounts(spark, sf_dir), names), "q1", "q3", "lower_bound", "upper_bound"
    )


def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(
        Q.box_stats(accounts(spark, sf_dir), NUMBERS),
        "q1", "median", "q3", "whisker_low", "whisker_high",
    )


def box_stats_of_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box statistics of thousands of groups: the lines of each part. The larger groups are narrowed, not sorted."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    found = Y.grouped_box_stats(lines, ["l_quantity", "l_extendedprice", "l_discount"], "l_partkey", small=32)
    return _rounded(found, "q1", "median", "q3", "whisker_low", "whisker_high")


# --- models --------------------------------------------------------------------------------


def _judged(scored: DataFrame) -> DataFrame:
    """What SQL can state about the predictions of a model that has learnt something: each is a
    class, and they find both classes better than chance does. A class without rows counts as chance."""
    hits = scored.agg(
        F.avg(F.when(F.col(LABEL) == 0, (F.col(PREDICTION) == 0).cast("double"))).alias("kept"),
        F.avg(F.when(F.col(LABEL) == 1, (F.col(PREDICTION) == 1).cast("double"))).alias("left"),
    ).first()
    return scored.select(
        "CustomerId",
        LABEL,
        F.col(PREDICTION).isin(0.0, 1.0).alias("is_class"),
        F.lit(sum(0.5 if h is None else h for h in hits) > 1).alias("beats_chance"),
    )


def _trained(train: Callable[[DataFrame], object], balance: str = "none", **settings) -> Query:
    """Judged test rows of a model trained on the training part."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        _, scored = M.train_and_test(
            training(spark, sf_dir), train, balance=balance, **settings
        )
        return _judged(cut_lineage(scored.select("CustomerId", LABEL, PREDICTION)))

    return query


def _searched(summary: DataFrame) -> DataFrame:
    """The settings, whether each was measured, and how many won on their number alone."""
    best = summary.agg(F.sum(F.col("is_best").cast("int"))).first()[0]
    return summary.select(
        "setting",
        F.col("avg_metric").between(0.5, 1.0).alias("better_than_chance"),
        F.lit(best >= 1).alias("has_winner"),
    )


def tune(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = training(spark, sf_dir)
    return _searched(M.model_summary(M.tune(df), df))


def tune_save_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training flow on a rule that trees can learn: what it reports about the test part must be perfect."""
    df = training(spark, sf_dir).withColumn(LABEL, (F.col("NumOfProducts") >= 2).cast("int"))
    _, found = M.tune_save_report(df, shared_dir(spark, "best-model"))
    return found.select(F.round("accuracy", 3).alias("accuracy"), F.round("auc", 3).alias("auc"), F.round("macro_recall", 3).alias("macro_recall"))


def _chance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of whom each leaves with a chance that rises with the age; a hash of the key decides."""
    rows = featured(spark, sf_dir).withColumn("chance", 1 / (1 + F.exp((45 - F.col("Age")) / F.lit(6.0))))
    drawn = F.conv(F.substring(F.md5(F.concat(F.lit("9:"), F.col("CustomerId").cast("string"))), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    return model_input(rows.withColumn(LABEL, (drawn < F.col("chance")).cast("int")))


def svm_calibrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A margin machine learns the chances: per bin of the true chance the customers, the share that left, and whether the
    mean calibrated probability is near the mean chance, by both methods."""
    rows = cut_lineage(_chance_rows(spark, sf_dir).select("CustomerId", "Age", LABEL))
    rows = rows.withColumn("Age", F.col("Age").cast("double"))
    chance = 1 / (1 + F.exp((45 - F.col("Age")) / F.lit(6.0)))
    train = lambda df: M.train_linear_svm(df, max_iter=30, features=["Age"], reg=0.01)
    # Both methods calibrate the same machine: its fits, each of hundreds of jobs, are made once.
    scored, fitted = rows, H.cross_fitted(rows, train, folds=3)
    for method in ("platt", "isotonic"):
        model = H.train_calibrated(rows, train, method, folds=3, fitted=fitted)
        scored = H.predict_probability(model, scored, f"{method}_class", method)
    # What a few dozen customers do says little about their chances.
    near = lambda c: (F.count(c) < 50) | (F.abs(F.avg(c) - F.avg(chance)) < 0.15)
    return scored.groupBy(F.least(F.floor(chance * 4), F.lit(3)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg(LABEL), DIGITS).alias("rate"),
        near("platt").alias("platt_near"), near("isotonic").alias("isotonic_near"),
    )


def forest_learns_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree that sees a rule's labels predicts the rule."""
    df = training(spark, sf_dir).withColumn(LABEL, (F.col("Age") >= 50).cast("int"))
    model = M.train_forest(df, num_trees=1, max_depth=3, subset="all", max_bins=256)
    return M.predict(model, df).select("CustomerId", PREDICTION)


def knn_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.knn_holdout(training(spark, sf_dir)).select("CustomerId", LABEL, PREDICTION)


def predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = training(spark, sf_dir)
    return _judged(cut_lineage(M.predict(M.train_forest(df), df)))


def save_and_load_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = training(spark, sf_dir)
    model = M.train_forest(df)
    path = shared_dir(spark, "model")
    M.save_model(model, path)
    both = M.predict(M.load_model(path), M.predict(model, df, "first"))
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col("first") != F.col(PREDICTION), 1)).alias("n_different"),
    )


class AgeRule:
    """Stands for any Python model with a vectorised ``predict``."""

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        return (matrix[:, FEATURES.index("Age")] >= 50).astype(float)


class Shift:
    """Stands for any Python scaler with a vectorised ``transform``."""

    def transform(self, matrix: np.ndarray) -> np.ndarray:
        return (matrix - 10.0) / 4.0


class ScaledAgeRule:
    """The same rule behind :class:`Shift`."""

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        return (matrix[:, FEATURES.index("Age")] >= 10).astype(float)


def score_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = E.assemble(model_input(featured(spark, sf_dir)), FEATURES)
    return U.score_with(df, AgeRule(), "features").select("CustomerId", PREDICTION)


def scale_with(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = E.assemble(kept(spark, sf_dir), ["CreditScore", "Age", "Balance"])
    return _elements(U.scale_with(df, Shift(), "features", "scaled"), "scaled")


# --- streams -------------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return featured(spark, sf_dir).select(*SCORING_SCHEMA.fieldNames())


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _message_files(_records(spark, sf_dir), "records")
    stream = C.fill_nulls(C.bool_to_int(J.decode_json(_file_stream(spark, path))))
    return _stream_to_table(stream, "decoded")


def _model_and_messages(spark: SparkSession, sf_dir: str):
    df = cut_lineage(featured(spark, sf_dir))
    model = M.train_forest(model_input(df))
    records = df.select(*SCORING_SCHEMA.fieldNames())
    return records, model, _message_files(records, "records")


def _rule_and_messages(spark: SparkSession, sf_dir: str):
    """A Python model behind a Python scaler, and messages for it."""
    records = _records(spark, sf_dir)
    return Z.python_scorer(ScaledAgeRule(), Shift()), _message_files(records, "records")


def score_stream_python(spark: SparkSession, sf_dir: str) -> DataFrame:
    scorer, path = _rule_and_messages(spark, sf_dir)
    scored = _stream_to_table(Z.score_stream(_file_stream(spark, path), scorer), "ruled")
    return scored.select("CustomerId", PREDICTION)


def score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose prediction differs between the stream and one batch: none."""
    records, model, path = _model_and_messages(spark, sf_dir)
    streamed = _stream_to_table(Z.score_stream(_file_stream(spark, path), model), "scored")
    whole = Z.score_records(records, model).select("CustomerId", F.col(PREDICTION).alias("whole"))
    return streamed.join(whole, "CustomerId").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col(PREDICTION) != F.col("whole"), 1)).alias("n_different"),
    )


def _score_files(spark: SparkSession, model, path: str, sinks, stream=None, checkpoint=None, **settings) -> None:
    checkpoint = checkpoint or shared_dir(spark, "checkpoint")
    source = _file_stream(spark, path) if stream is None else stream
    Z.await_stream(
        Z.start_scoring(source, model, sinks, checkpoint, available_now=True, **settings)
    )


def last_message_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer sends three messages, of which that with the highest offset counts. It comes in the first of three
    batches, an older one with another age in the second, and itself again in the third."""
    records = _records(spark, sf_dir)
    first = records.withColumn("Age", F.lit(20).cast(records.schema["Age"].dataType))
    path, out = shared_dir(spark, "thrice"), shared_dir(spark, "last")
    message = F.to_json(F.struct(*SCORING_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    schema = T.StructType.fromDDL("value string, offset int")
    checkpoint = shared_dir(spark, "checkpoint")
    for i, (at, rows) in enumerate(((7, records), (3, first), (7, records))):
        rows.select(message.alias("value"), F.lit(at).alias("offset")).write.parquet(f"{path}/{i}")
        # The stream goes on where it stopped: a batch is all files of one round, however many tasks wrote them.
        _score_files(
            spark, Z.python_scorer(ScaledAgeRule(), Shift()), path, {"last": Z.files_sink(out)},
            J.stream_source(spark, "parquet", {"path": f"{path}/*"}, schema), checkpoint,
            keep=["offset"], newest_by="offset", ttl="7 days",
        )
    return spark.read.parquet(out).select("CustomerId", "Age", PREDICTION)


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, path = _rule_and_messages(spark, sf_dir)
    out = shared_dir(spark, "sinks")
    _score_files(
        spark, model, path,
        {"table": Z.files_sink(f"{out}/table"), "messages": Z.messages_sink(f"{out}/messages")},
    )
    table = spark.read.parquet(f"{out}/table")
    messages = J.read_predictions(spark, "text", {"path": f"{out}/messages"})

    def seen(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("CustomerId").alias("sum_ids")).select(
            F.lit(name).alias("sink"), "n_rows", "sum_ids"
        )

    return seen("table", table).unionByName(seen("messages", messages))


def _half_broken(spark: SparkSession, sf_dir: str) -> tuple:
    """Messages of which those about women are cut off."""
    df = featured(spark, sf_dir)
    model = Z.python_scorer(ScaledAgeRule(), Shift())
    record = F.to_json(
        F.struct(*SCORING_SCHEMA.fieldNames()), {"ignoreNullFields": "false"}
    )
    cut = F.concat(F.lit('{"CustomerId":'), F.col("CustomerId"), F.lit(',"Age":'))
    path = shared_dir(spark, "mixed")
    messages = df.select(F.when(F.col("Female"), cut).otherwise(record).alias("value"))
    messages.repartition(spark.sparkContext.defaultParallelism).write.text(path)
    out = shared_dir(spark, "sorted")
    _score_files(
        spark, model, path, {"table": Z.files_sink(f"{out}/good")},
        broken=Z.files_sink(f"{out}/broken", "text"),
    )
    return f"{out}/good", f"{out}/broken"


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, broken = _half_broken(spark, sf_dir)
    return spark.read.text(broken).select("value")


def quarantine_passed(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = _half_broken(spark, sf_dir)
    return spark.read.parquet(good).select("CustomerId", "Age")


def dead_letter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that always fails: its rows are set aside and the stream goes on."""
    model, path = _rule_and_messages(spark, sf_dir)
    out = shared_dir(spark, "dead")

    def failing(df: DataFrame, batch_id: int) -> None:
        raise OSError("the sink is out of order")

    _score_files(
        spark, model, path, {"failing": failing},
        dead_letter=lambda name: Z.files_sink(f"{out}/sink={name}"),
    )
    return spark.read.parquet(out).select("sink", "CustomerId")


def sink_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sinks that append, of which the second fails twice. The repeated batch skips the first one, and each
    record is in each sink exactly once."""
    model, path = _rule_and_messages(spark, sf_dir)
    out, checkpoint = shared_dir(spark, "appended"), shared_dir(spark, "checkpoint")
    ledger, failures = O.Ledger(spark, shared_dir(spark, "ledger")), [1, 1]

    def append(name: str) -> Z.Sink:
        def write(df: DataFrame, batch_id: int) -> None:
            if name == "second" and failures:
                failures.pop()
                raise OSError("the sink is out of order")
            df.write.mode("append").parquet(f"{out}/sink={name}")

        return write

    for _ in range(3):
        query = Z.start_scoring(
            _file_stream(spark, path), model, {name: append(name) for name in ("first", "second")}, checkpoint,
            ledger=ledger, available_now=True,
        )
        try:
            Z.await_stream(query)
        except StreamingQueryException:
            continue
    return spark.read.parquet(out).groupBy("sink", "CustomerId").agg(F.count(F.lit(1)).alias("n_rows"))


def dead_letters_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that a sink refused are set aside and given to it again; it takes them at the second try."""
    model, path = _rule_and_messages(spark, sf_dir)
    out, dead = shared_dir(spark, "replayed"), shared_dir(spark, "dead")
    ledger, failures = O.Ledger(spark, shared_dir(spark, "ledger")), []

    def stubborn(df: DataFrame, batch_id: int) -> None:
        if failures.count(batch_id) < 2:
            failures.append(batch_id)
            raise OSError("the sink is out of order")
        df.write.mode("append").parquet(out)

    _score_files(spark, model, path, {"stubborn": stubborn}, dead_letter=O.set_aside(dead))
    while O.replay(ledger, dead, {"stubborn": stubborn}, most_tries=3):
        pass
    return spark.read.parquet(out).groupBy("CustomerId").agg(F.count(F.lit(1)).alias("n_rows"))


def _live(name: str, *rounded: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = _message_files(predicted(spark, sf_dir), "predictions")
        stream = J.tail_predictions(spark, "text", _stream_options(spark, path))
        base = shared_dir(spark, "live")
        running = L.live_reports(stream, base, {name: L.LIVE_REPORTS[name]}, available_now=True)
        Z.await_stream(running[name])
        return _rounded(L.latest_report(spark, f"{base}/{name}"), *rounded)

    return query


def queries() -> dict[str, Query]:
    return {
        "read_table": read_table,
        "write_table": write_table,
        "decode_json": decode_json,
        "encode_json": encode_json,
        "read_predictions": read_predictions,
        "tail_predictions": tail_predictions,
        "store_columns": lambda s, d: D.store_columns(predicted(s, d)),
        "last_per_key": last_per_key,
        "drop_identifiers": _over_accounts(C.drop_identifiers),
        "project": _over_accounts(
            lambda df: C.project(df, {"CustomerId": "id", "CreditScore": "score", LABEL: "label"})
        ),
        "cast_label": _over_accounts(
            lambda df: C.cast_label(df.select("CustomerId", F.col(LABEL).cast("string").alias(LABEL)))
        ),
        "bool_to_int": lambda s, d: C.bool_to_int(
            featured(s, d).select("CustomerId", *C.BOOLEAN_COLUMNS)
        ),
        "fill_nulls": fill_nulls,
        "filter_class": _over_accounts(lambda df: C.filter_class(df, 1)),
        "remove_outliers": kept,
        "label_map": label_map,
        "lower_columns": _over_accounts(
            lambda df: C.lower_columns(df.select("CustomerId", "Surname", "Age"))
        ),
        "preview": _over_accounts(lambda df: C.preview(df, 5, ["CustomerId"])),
        "shape": lambda s, d: C.shape(kept(s, d)),
        "at_risk": _over_ruled(lambda df: C.at_risk(df.select("CustomerId", "Age", PREDICTION))),
        **{f"feature_{name}": _row_feature(name) for name in ROW_FEATURE_NAMES},
        **{f"feature_{QUANTILE_BINS[c][0]}": _quantile_feature(c) for c in QUANTILE_BINS},
        "feature_BalanceScore": _rank_feature,
        "engineer_features": featured,
        "quantile_cut": quantile_cut,
        "rank_cut": rank_cut,
        "label_encode": label_encode,
        "one_hot": one_hot,
        "attach_columns": attach_columns,
        "assemble": assemble,
        "standardize_vector": _standardize_vector(True),
        "standardize_without_mean": _standardize_vector(False),
        "standardize": _standardize(1),
        "standardize_population": _standardize(0),
        "class_distribution": _over_accounts(B.class_distribution),
        "random_split": random_split,
        "undersample": _over_accounts(
            lambda df: B.undersample(df, 0, 0.5).select("CustomerId", LABEL)
        ),
        "oversample": _over_accounts(lambda df: _copies(B.oversample(df, 1, 2.0))),
        "balance_classes": _over_accounts(lambda df: _copies(B.balance_classes(df))),
        "oversample_to_ratio": _over_accounts(lambda df: _copies(B.oversample_to_ratio(df))),
        "undersample_to_ratio": _over_accounts(
            lambda df: B.undersample_to_ratio(df).select("CustomerId", LABEL)
        ),
        "class_weights": class_weights,
        "union_classes": union_classes,
        "smoten_oversample": smoten_oversample,
        "smoten_classes": smoten_classes,
        "oversample_then_smoten": oversample_then_smoten,
        "smoten_then_folds": smoten_then_folds,
        "train_forest": _trained(M.train_forest, "double_and_halve"),
        "train_logistic": _trained(M.train_logistic, seed=0),
        "train_linear_svm": _trained(M.train_linear_svm, "oversample", seed=0),
        "tune": tune,
        "predict": predict,
        "train_logistic_l2": _trained(M.train_logistic_l2),
        "train_forest_default": _trained(M.train_forest_default),
        "train_poly_svm": _trained(M.train_poly_svm),
        "knn_holdout": knn_holdout,
        "save_and_load_model": save_and_load_model,
        "knn": knn,
        "knn_approximate": knn_approximate,
        "knn_cells": knn_cells,
        "knn_graph": knn_graph,
        "knn_classify": knn_classify,
        "knn_edges": knn_edges,
        "confusion_matrix": _over_ruled(V.confusion_matrix),
        "accuracy": _summary("accuracy"),
        "weighted_precision_recall": _summary("weighted_precision", "weighted_recall"),
        "f1": _summary("f1"),
        "precision_recall_by_label": _over_ruled(
            V.precision_recall_by_label, "precision", "recall"
        ),
        "macro_metrics": _summary("macro_precision", "macro_recall", "macro_f1"),
        "classification_report": _over_ruled(V.classification_report),
        "auc_roc": auc_roc,
        "best_metrics": best_metrics,
        "metric_history": metric_history,
        "churn_share": _over_accounts(Q.churn_share),
        "iqr_summary": iqr_summary,
        "box_stats": box_stats,
        "box_stats_of_parts": box_stats_of_parts,
        "prediction_counts": _over_ruled(R.prediction_counts),
        "churn_by_gender": _over_ruled(R.churn_by_gender, "churn_rate"),
        "credit_histogram": _over_ruled(R.credit_histogram, "bin_start", "bin_end"),
        "churn_by_age": _over_ruled(R.churn_by_age, "churn_rate"),
        "products_by_prediction": _over_ruled(R.products_by_prediction),
        "at_risk_customers": _over_ruled(
            lambda df: R.at_risk_customers(df).select(
                "CustomerId", "Surname", "CreditScore", "Age", "Balance", PREDICTION
            )
        ),
        "live_prediction_counts": _live("prediction_counts"),
        "live_churn_by_gender": _live("churn_by_gender", "churn_rate"),
        "live_credit_histogram": _live("credit_histogram", "bin_start", "bin_end"),
        "live_churn_by_age": _live("churn_by_age", "churn_rate"),
        "live_products_by_prediction": _live("products_by_prediction"),
        "stream_records": stream_records,
        "score_stream": score_stream,
        "score_stream_python": score_stream_python,
        "last_message_wins": last_message_wins,
        "tune_save_report": tune_save_report,
        "svm_calibrated": svm_calibrated,
        "forest_learns_rule": forest_learns_rule,
        "fan_out": fan_out,
        "quarantine": quarantine,
        "quarantine_passed": quarantine_passed,
        "dead_letter": dead_letter,
        "sink_ledger": sink_ledger,
        "dead_letters_replayed": dead_letters_replayed,
        "score_with": score_with,
        "scale_with": scale_with,
    }


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts to features to forest to the report of predicted classes."""
    df = cut_lineage(model_input(featured(spark, sf_dir)))
    return R.prediction_counts(M.predict(M.train_forest(df), df))
