from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators import group_stats as G
from test_group_stats import rows_of


def test_rows_are_not_shuffled_again(spark):
    _, df = rows_of(spark)
    moved, kept = G._layouts(df, ["a", "b"], "name", 300)
    assert not moved.hot and kept.hot
    assert {r["_group"] for r in kept.rows.select("_group").distinct().collect()} == {None, "hot", "ties", "wide"}
    for layout in (moved, kept):
        known = G._counts(layout)
        plan = layout.meet(known).groupBy("_group").agg(F.max("_0"))._jdf.queryExecution().executedPlan().toString()
        # Only what is known of the groups comes to the rows, by one shuffle or to all tasks; so do the results of hot ones.
        assert plan.count("Exchange hashpartitioning") == 1
        assert plan.count("BroadcastExchange") == (1 if layout.hot else 0)
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


@pytest.mark.parametrize("small, hot", [(20, 300), (20, 50_000), (50_000, 1), (3, 3)])
def test_boxes_of_hot_and_other_groups(spark, small, hot):
    rows, df = rows_of(spark)
    got = {(r["name"], r.feature): r for r in G.grouped_box_stats(df, ["a", "b"], "name", small, hot).collect()}
    want = {}
    for name, a, b in rows:
        for feature, v in (("a", a), ("b", b)):
            if v is not None and v == v and np.isfinite(v):
                want.setdefault((name, feature), []).append(v)
    assert set(want) == {k for k in got if k != ("inf", "a")}
    for key, values in want.items():
        x, r = np.array(values), got[key]
        q1, median, q3 = np.percentile(x, [25, 50, 75])
        inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
        np.testing.assert_allclose([r.q1, r.median, r.q3], [q1, median, q3], rtol=1e-12, err_msg=str(key))
        np.testing.assert_allclose(r.whisker_low, min(q1, inside.min()), rtol=1e-12)
        np.testing.assert_allclose(r.whisker_high, max(q3, inside.max()), rtol=1e-12)
        assert abs(r.n_outliers - (len(x) - len(inside))) <= (1 if key[0] == "wide" else 0)
