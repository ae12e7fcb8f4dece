from __future__ import annotations

import numpy as np
import pytest

from attrition.operators import group_stats as G


def rows_of(spark):
    rng = np.random.default_rng(12)
    rows = [("hot", float(x), None) for x in rng.normal(size=900)]
    rows += [("ties", float(x), float(i)) for i, x in enumerate(rng.choice([1.0, 2.0, 2.0, 2.0, 3.0], 400))]
    rows += [("wide", float(10.0 ** rng.integers(-300, 300)), 5.0) for _ in range(500)]
    rows += [(f"g{i % 170}", float(rng.integers(0, 9)), float(rng.random())) for i in range(800)]
    rows += [(None, float(i), -1.0) for i in range(7)] + [("none", None, float("nan")), ("one", 4.0, None), ("inf", float("-inf"), 1.0)]
    return rows, spark.createDataFrame(rows, "name string, a double, b double").repartition(5)


@pytest.mark.parametrize("small", [20, 50_000])
def test_quantiles_of_groups(spark, small):
    rows, df = rows_of(spark)
    steps = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    got = {(r["_group"], r.feature): r for r in G.grouped_quantiles(df, ["a", "b"], "name", steps, small).collect()}
    want = {}
    for name, a, b in rows:
        for feature, v in (("a", a), ("b", b)):
            if v is not None and v == v:
                want.setdefault((name, feature), []).append(v)
    assert set(got) == set(want)
    for key, values in want.items():
        assert got[key].n == len(values)
        x = np.sort(values)
        place = [p * (len(x) - 1) for p in steps]
        low = [x[int(i)] for i in place]
        high = [x[min(int(i) + 1, len(x) - 1)] for i in place]
        exact = [a + (b - a) * (i - int(i)) if b != a else a for a, b, i in zip(low, high, place)]
        np.testing.assert_allclose(got[key].quantiles, exact, rtol=1e-12, err_msg=str(key))


def test_boxes_of_no_rows(spark):
    _, df = rows_of(spark)
    assert G.grouped_box_stats(df.limit(0), ["a"], "name").count() == 0
