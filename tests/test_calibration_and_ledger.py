from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.plans import calibration as H
from attrition.plans import models as M
from attrition.sources.scratch import shared_dir
from attrition.streaming import ledger as O


def chances(spark, n=3000):
    """Rows whose label is drawn with a chance that rises with x; a third of the rows share one key."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=n)
    p = 1 / (1 + np.exp(-2 * x))
    rows = [(7 if i % 3 == 0 else i, float(a), float(b), int(rng.random() < b)) for i, (a, b) in enumerate(zip(x, p))]
    return spark.createDataFrame(rows, "CustomerId bigint, x double, p double, Exited int").repartition(4)


@pytest.mark.parametrize("method", ["platt", "isotonic"])
def test_calibrated_margins(spark, method):
    df = chances(spark).cache()
    train = lambda rows: M.train_linear_svm(rows, features=["x"])
    model = H.train_calibrated(df, train, method, folds=3)
    path = shared_dir(spark, "calibrated")
    M.save_model(model, path)
    scored = H.predict_probability(M.load_model(path, ["x"]), df).cache()
    assert scored.columns == [*df.columns, "ChurnPrediction", H.PROBABILITY]
    assert scored.filter(~F.col(H.PROBABILITY).between(0, 1)).count() == 0
    assert H.calibration_error(scored) < 0.06
    error = scored.agg(F.avg(F.abs(F.col(H.PROBABILITY) - F.col("p")))).first()[0]
    assert error < 0.08
    # The order of the margins stays.
    pdf = scored.orderBy("x").toPandas()
    assert (np.diff(pdf[H.PROBABILITY]) >= -1e-12).all()


def test_calibration_needs_both_classes(spark):
    df = chances(spark, 60).withColumn("Exited", F.lit(1))
    with pytest.raises(ValueError, match="both classes"):
        H.train_calibrated(df, lambda rows: M.train_linear_svm(rows, features=["x"]), folds=3)
    with pytest.raises(ValueError, match="unknown method"):
        H.train_calibrated(chances(spark, 200), lambda rows: M.train_linear_svm(rows, features=["x"]), "guess", folds=2)


def test_ledger_and_replay(spark, tmp_path):
    ledger = O.Ledger(spark, str(tmp_path / "ledger"))
    taken: list[tuple[int, int]] = []
    good = ledger.once("good", lambda df, batch: taken.append((batch, df.count())))
    df = spark.range(5)
    for batch in (0, 0, 1, 0):
        good(df, batch)
    assert taken == [(0, 5), (1, 5)] and ledger.finished("good", 1) and not ledger.finished("other", 1)

    base, given = str(tmp_path / "dead"), []
    for batch in (3, 11):
        O.set_aside(base)("weak")(spark.range(batch), batch)

    def weak(rows, batch):
        given.append(batch)
        if batch == 11 or given.count(batch) < 2:
            raise OSError

    assert O.replay(ledger, base, {"weak": weak, "none": weak}, 3) == {"weak": [3, 11]}
    assert O.replay(ledger, base, {"weak": weak}, 3) == {"weak": [11]}
    for _ in range(4):
        assert O.replay(ledger, base, {"weak": weak}, 3) == {"weak": [11]}
    assert given.count(3) == 2 and given.count(11) == 3 == ledger.tries("weak", 11)


def test_methods_share_the_fits(spark):
    df, fits = chances(spark, 300), []

    def train(rows):
        fits.append(1)
        return M.train_linear_svm(rows, max_iter=5, features=["x"])

    fitted = H.cross_fitted(df, train, folds=2)
    models = [H.train_calibrated(df, train, method, folds=2, fitted=fitted) for method in ("platt", "isotonic")]
    assert len(fits) == 3
    alone = H.train_calibrated(df, train, "platt", folds=2)
    values = [H.predict_probability(m, df).agg({H.PROBABILITY: "sum"}).first()[0] for m in (*models, alone)]
    assert abs(values[0] - values[2]) < 1e-6 and 0 < values[1] < 300
