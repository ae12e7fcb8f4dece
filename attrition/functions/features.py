"""Derived columns of one customer row, as native expressions.

Division by zero and by a missing value give null, which ``fill_nulls`` later turns into 0.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.columns import mapped

# Average monthly salary by country.
COUNTRY_MONTHLY_SALARY = {"France": 3696, "Germany": 4740, "Spain": 2257}
# Fixed value: an adult's age is counted from here.
MINOR_YEARS = 17
MONTHS = 12.0


def _ratio(top: Column | str, bottom: Column | str) -> Column:
    return F.try_divide(
        F.col(top) if isinstance(top, str) else top,
        F.col(bottom) if isinstance(bottom, str) else bottom,
    )


def balance_ratios() -> dict[str, Column]:
    return {
        "BalanceSalary": _ratio("Balance", "EstimatedSalary"),
        "score_balance": _ratio("Balance", "CreditScore"),
        "age_balance": _ratio("Balance", "Age"),
        "balance_salary": _ratio("Balance", "EstimatedSalary"),
    }


def tenure_and_score_ratios() -> dict[str, Column]:
    adult_years = F.col("Age") - MINOR_YEARS
    return {
        "TenureAge": _ratio("Tenure", "Age"),
        "ScoreAge": _ratio("CreditScore", "Age"),
        "tenure_age": _ratio("Tenure", adult_years),
        "tenure_salary": _ratio("Tenure", "EstimatedSalary"),
        "score_age": _ratio("CreditScore", adult_years),
        "score_salary": _ratio("CreditScore", "EstimatedSalary"),
        "age_hascrcard": _ratio("HasCrCard", "Age"),
    }


def age_and_salary_levels() -> dict[str, Column]:
    return {
        "newAge": F.col("Age") - F.col("Tenure"),
        "newEstimatedSalary": F.col("EstimatedSalary") / F.lit(MONTHS),
    }


def product_rates() -> dict[str, Column]:
    products = F.col("NumOfProducts")
    return {
        "product_utilization_rate_by_year": F.when(products == 0, 0.0)
        .when(F.col("Tenure") == 0, products.cast("double"))
        .otherwise(_ratio(products, "Tenure")),
        "product_utilization_rate_by_salary": F.when(products == 0, 0.0).otherwise(
            _ratio(products, "EstimatedSalary")
        ),
    }


def salary_against_country(
    salaries: Mapping[str, float] = COUNTRY_MONTHLY_SALARY,
) -> dict[str, Column]:
    """Monthly salary over the country's average; a country without entry gives null."""
    average = mapped("Geography", {k: float(v) for k, v in salaries.items()})
    return {
        "countries_monthly_average_salaries": _ratio(
            F.col("EstimatedSalary") / F.lit(MONTHS), average
        )
    }


def row_features(salaries: Mapping[str, float] = COUNTRY_MONTHLY_SALARY) -> dict[str, Column]:
    return {
        **balance_ratios(),
        **tenure_and_score_ratios(),
        **age_and_salary_levels(),
        **product_rates(),
        **salary_against_country(salaries),
    }


def with_row_features(
    df: DataFrame, salaries: Mapping[str, float] = COUNTRY_MONTHLY_SALARY
) -> DataFrame:
    """All row-local features in one projection; none refers to another new column."""
    return df.withColumns(row_features(salaries))


def attach_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Put further columns of the same row next to the existing ones: no join is needed."""
    return df.withColumns(dict(columns))
