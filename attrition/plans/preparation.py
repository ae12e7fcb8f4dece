"""From raw customers to the 32-feature table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.functions.columns import bool_to_int, fill_nulls
from attrition.functions.features import COUNTRY_MONTHLY_SALARY, with_row_features
from attrition.operators.encode import OneHot, cut_all
from attrition.schemas import FEATURES, IDENTIFIERS, LABEL, SCORING_SCHEMA
from attrition.sources.scratch import pinned

# Number of bins of the score columns, and the encoded categories.
QUANTILE_BINS = {
    "CreditScore": ("newCreditScore", 10),
    "Age": ("AgeScore", 8),
    "EstimatedSalary": ("SalaryScore", 10),
}
RANK_BINS = ("Balance", "BalanceScore", 10)
CATEGORIES = ("Geography", "Gender")
DROP_FIRST = ("Geography",)


def fit_features(df: DataFrame, order_col: str = "CustomerId") -> PipelineModel:
    """Measure bin edges, rank cuts and category levels; the result can be saved and reused on
    new customers and streams."""
    column, output, bins = RANK_BINS
    needed = dict.fromkeys([*QUANTILE_BINS, column, order_col, *CATEGORIES])
    with pinned(df.select(*needed)) as part:
        quantile_cut, rank_cut = cut_all(part, QUANTILE_BINS, column, output, bins, order_col)
        one_hot = OneHot(CATEGORIES, DROP_FIRST).fit(part)
    return PipelineModel([quantile_cut, rank_cut, one_hot])


def apply_features(
    df: DataFrame,
    fitted: PipelineModel,
    salaries: Mapping[str, float] = COUNTRY_MONTHLY_SALARY,
) -> DataFrame:
    """The engineered table in record order: identifiers, 32 features and, if present, label.

    A category level that the fitted data never had still gets its column, all false."""
    wide = fitted.transform(with_row_features(df, salaries))
    types = {f.name: f.dataType for f in SCORING_SCHEMA}
    present = set(wide.columns)
    ids = [c for c in IDENTIFIERS if c in present]
    label = [LABEL] if LABEL in present else []
    return wide.select(
        *ids,
        *[
            (F.col(c) if c in present else F.lit(False)).cast(types[c]).alias(c)
            for c in FEATURES
        ],
        *label,
    )


def engineer_features(df: DataFrame, order_col: str = "CustomerId") -> DataFrame:
    return apply_features(df, fit_features(df, order_col))


def model_input(df: DataFrame) -> DataFrame:
    """Booleans to 0/1 and nulls to 0, as the vector assembler needs it."""
    return fill_nulls(bool_to_int(df))
