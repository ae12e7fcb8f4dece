from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from attrition.functions import columns as C
from attrition.functions import features as X
from attrition.plans.preparation import apply_features, engineer_features, fit_features
from attrition.schemas import (
    FEATURES,
    FEATURE_SCHEMA,
    PREDICTION_SCHEMA,
    RAW_SCHEMA,
    SCORING_SCHEMA,
    jdbc_column_types,
    prediction_table_ddl,
)


def row(spark, **changes):
    base = dict(
        RowNumber=1, CustomerId=1, Surname="A", CreditScore=600, Geography="France", Gender="Male",
        Age=40, Tenure=5, Balance=1000.0, NumOfProducts=2, HasCrCard=1, IsActiveMember=1,
        EstimatedSalary=12000.0, Exited=0,
    )
    base.update(changes)
    df = spark.createDataFrame([tuple(base[c] for c in RAW_SCHEMA.fieldNames())], RAW_SCHEMA)
    return X.with_row_features(df).first()


def test_layouts():
    assert len(SCORING_SCHEMA) == 34 and len(FEATURES) == 32
    assert PREDICTION_SCHEMA.fieldNames()[-1] == "ChurnPrediction" and len(PREDICTION_SCHEMA) == 35
    assert PREDICTION_SCHEMA["Germany"].dataType.simpleString() == "int"
    assert FEATURE_SCHEMA.fieldNames()[:3] == ["RowNumber", "CustomerId", "Surname"]
    assert len({c.lower() for c in SCORING_SCHEMA.fieldNames()}) == 34


def test_store_definition():
    ddl = prediction_table_ddl("predictions")
    assert ddl.startswith("CREATE TABLE predictions (customerid BIGINT, surname TEXT, creditscore INTEGER")
    assert ddl.endswith("churnprediction DOUBLE PRECISION, PRIMARY KEY (customerid))")
    assert "surname VARCHAR(100)" in jdbc_column_types(text_type="VARCHAR(100)")


def test_ratios(spark):
    r = row(spark)
    assert r["BalanceSalary"] == r["balance_salary"] == 1000 / 12000
    assert r["TenureAge"] == 5 / 40 and r["tenure_age"] == 5 / 23
    assert r["newAge"] == 35 and r["newEstimatedSalary"] == 1000.0
    assert r["countries_monthly_average_salaries"] == 1000.0 / 3696


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({"Age": 17}, {"tenure_age": None, "score_age": None, "TenureAge": 5 / 17}),
        ({"EstimatedSalary": 0.0}, {"BalanceSalary": None, "tenure_salary": None,
                                    "product_utilization_rate_by_salary": None}),
        ({"Tenure": 0}, {"product_utilization_rate_by_year": 2.0}),
        ({"NumOfProducts": 0}, {"product_utilization_rate_by_year": 0.0,
                                "product_utilization_rate_by_salary": 0.0}),
        ({"NumOfProducts": 0, "Tenure": 0}, {"product_utilization_rate_by_year": 0.0}),
        ({"Geography": "Italy"}, {"countries_monthly_average_salaries": None}),
        ({"Age": None}, {"ScoreAge": None, "newAge": None}),
    ],
)
def test_edge_rows(spark, changes, expected):
    r = row(spark, **changes)
    assert {name: r[name] for name in expected} == expected


def test_outlier_rules_keep_nulls(spark):
    df = spark.createDataFrame(
        [(1, 383, 62, 3), (2, 382, 20, 1), (3, 600, 63, 1), (4, 600, 20, 4), (5, None, None, None)],
        "id int, CreditScore int, Age int, NumOfProducts int",
    )
    assert sorted(r.id for r in C.remove_outliers(df).collect()) == [1, 5]


def test_fill_and_cast(spark):
    df = spark.createDataFrame(
        [(None, None, None, True), (1.5, 2, "x", None)], "a double, b int, c string, Germany boolean"
    )
    filled = C.fill_nulls(C.bool_to_int(df, ["Germany"])).collect()
    assert [tuple(r) for r in filled] == [(0.0, 0, None, 1), (1.5, 2, "x", 0)]


def test_small_helpers(spark, accounts):
    assert C.numeric_columns(accounts.select("Surname", "Age", "Balance")) == ["Age", "Balance"]
    assert C.feature_columns(accounts)[0] == "CreditScore"
    assert "Exited" not in C.feature_columns(accounts)
    assert C.is_empty(accounts.filter("Age < 0")) and not C.is_empty(accounts)
    wide = accounts.withColumns({"features": F.lit(1), "probability": F.lit(2)})
    assert C.drop_intermediate(wide).columns == accounts.columns
    assert C.shape(accounts).first().n_columns == len(accounts.columns)
    mapped = C.label_map(accounts.limit(1).select("Age"), "Age", {}, "x").first()
    assert mapped["x"] is None


def test_prepared_table(spark, accounts):
    df = engineer_features(C.remove_outliers(accounts))
    assert df.columns == ["CustomerId", "Surname", *FEATURES, "Exited"]
    types = {f.name: f.dataType for f in SCORING_SCHEMA}
    assert all(f.dataType == types[f.name] for f in df.schema if f.name in types)


def test_fitted_features_survive_new_rows_and_saving(spark, accounts, tmp_path):
    from pyspark.ml import PipelineModel

    fitted = fit_features(C.remove_outliers(accounts))
    fitted.write().overwrite().save(str(tmp_path / "m"))
    loaded = PipelineModel.load(str(tmp_path / "m"))
    new = accounts.filter("Geography <> 'Spain'").limit(7)
    a = apply_features(new, fitted).orderBy("CustomerId").collect()
    b = apply_features(new, loaded).orderBy("CustomerId").collect()
    assert a == b and len(a) == 7


def test_feature_plan_has_no_python_and_pushes_filters(spark):
    from attrition.plans.catalog import kept

    fe = engineer_features(kept(spark, "/root/testdata/sf0.01"))
    plan = fe._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Window" not in plan
    narrow = fe.select("CustomerId", "Age")._jdf.queryExecution().executedPlan().toString()
    assert "c_acctbal" not in narrow.split("ReadSchema")[1]


def test_outlier_filter_reaches_the_scan(spark, accounts, tmp_path):
    accounts.write.parquet(str(tmp_path / "raw"))
    df = C.remove_outliers(spark.read.parquet(str(tmp_path / "raw"))).select("CustomerId")
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: ")[1].split("]")[0]
    assert "CreditScore" in pushed and "Age" in pushed and "NumOfProducts" in pushed
    assert "Surname" not in plan.split("ReadSchema: ")[1]
