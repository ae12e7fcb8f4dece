"""The registered queries in plain SQL, used to check the Spark results."""

from __future__ import annotations

from attrition.functions.hashing import threshold

ACCOUNTS = """
WITH o AS (
  SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price,
         max(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS has_p,
         max(CASE WHEN o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' THEN 1 ELSE 0 END) AS recent
  FROM orders GROUP BY o_custkey),
b AS (
  SELECT c_custkey AS CustomerId, c_name AS Surname,
         CAST(300 + (c_custkey * 37) % 551 AS INT) AS CreditScore,
         CASE c_nationkey % 3 WHEN 0 THEN 'France' WHEN 1 THEN 'Germany' ELSE 'Spain' END AS Geography,
         CASE WHEN c_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS Gender,
         CAST(18 + (c_custkey * 7919) % 65 AS INT) AS Age,
         CAST(coalesce(n_orders, 0) % 11 AS INT) AS Tenure,
         CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0.0e0 END AS Balance,
         CAST(1 + (coalesce(n_orders, 0) + c_custkey) % 4 AS INT) AS NumOfProducts,
         CAST(coalesce(has_p, 0) AS INT) AS HasCrCard, CAST(coalesce(recent, 0) AS INT) AS IsActiveMember,
         coalesce(top_price, 0.0e0) AS EstimatedSalary
  FROM customer LEFT JOIN o ON c_custkey = o_custkey),
accounts AS (
  SELECT *, CAST(CASE WHEN (Age >= 50 AND IsActiveMember = 0)
                        OR (Balance > 8000 AND NumOfProducts >= 3) THEN 1 ELSE 0 END AS INT) AS Exited
  FROM b)"""

KEPT = f"""{ACCOUNTS},
kept AS (
  SELECT * FROM accounts
  WHERE NOT coalesce(CreditScore <= 382, false) AND NOT coalesce(Age >= 63, false)
    AND NOT coalesce(NumOfProducts >= 4, false))"""

ROW_FEATURES = {
    "BalanceSalary": "Balance / nullif(EstimatedSalary, 0)",
    "TenureAge": "Tenure / Age",
    "ScoreAge": "CreditScore / Age",
    "tenure_age": "Tenure / nullif(Age - 17, 0)",
    "tenure_salary": "Tenure / nullif(EstimatedSalary, 0)",
    "score_age": "CreditScore / nullif(Age - 17, 0)",
    "score_salary": "CreditScore / nullif(EstimatedSalary, 0)",
    "newAge": "Age - Tenure",
    "newEstimatedSalary": "EstimatedSalary / 12",
    "score_balance": "Balance / CreditScore",
    "age_balance": "Balance / Age",
    "balance_salary": "Balance / nullif(EstimatedSalary, 0)",
    "age_hascrcard": "HasCrCard / Age",
    "product_utilization_rate_by_year": "CASE WHEN NumOfProducts = 0 THEN 0.0e0 WHEN Tenure = 0 "
    "THEN CAST(NumOfProducts AS DOUBLE) ELSE NumOfProducts / Tenure END",
    "product_utilization_rate_by_salary": "CASE WHEN NumOfProducts = 0 THEN 0.0e0 "
    "ELSE NumOfProducts / nullif(EstimatedSalary, 0) END",
    "countries_monthly_average_salaries": "EstimatedSalary / 12 / CASE Geography "
    "WHEN 'Germany' THEN 4740.0e0 WHEN 'France' THEN 3696.0e0 WHEN 'Spain' THEN 2257.0e0 END",
}

_TENTHS = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
_EIGHTHS = "[0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875]"


def _bin(column: str, edges: str) -> str:
    return (
        f"CASE WHEN {column} IS NOT NULL THEN "
        f"CAST(1 + len(list_filter({edges}, lambda e: e < {column})) AS INT) END"
    )


BINNED = f"""{KEPT},
edges AS (
  SELECT quantile_cont(CreditScore, {_TENTHS}) AS score_edges,
         quantile_cont(Age, {_EIGHTHS}) AS age_edges,
         quantile_cont(EstimatedSalary, {_TENTHS}) AS salary_edges,
         count(*) AS n FROM kept),
binned AS (
  SELECT kept.*,
    {_bin('CreditScore', 'score_edges')} AS newCreditScore,
    {_bin('Age', 'age_edges')} AS AgeScore,
    CAST(greatest(1, ceil((row_number() OVER (ORDER BY Balance, CustomerId) - 1) * 10 / (n - 1))) AS INT)
      AS BalanceScore,
    {_bin('EstimatedSalary', 'salary_edges')} AS SalaryScore
  FROM kept, edges)"""

_ORDERED = (
    "BalanceSalary TenureAge ScoreAge tenure_age tenure_salary score_age score_salary newAge "
    "newCreditScore AgeScore BalanceScore SalaryScore newEstimatedSalary score_balance age_balance "
    "balance_salary age_hascrcard product_utilization_rate_by_year "
    "product_utilization_rate_by_salary countries_monthly_average_salaries"
).split()

_DERIVED = ",\n    ".join(
    f"{ROW_FEATURES[c]} AS {c}" if c in ROW_FEATURES else c for c in _ORDERED
)

FEATURED = f"""{BINNED},
fe AS (
  SELECT CustomerId, Surname, CreditScore, Age, Tenure, Balance, NumOfProducts, HasCrCard,
    IsActiveMember, EstimatedSalary,
    {_DERIVED},
    Geography = 'Germany' AS Germany, Geography = 'Spain' AS Spain,
    Gender = 'Female' AS Female, Gender = 'Male' AS Male, Exited
  FROM binned)"""

FLAGS = ("Germany", "Spain", "Female", "Male")
FE_COLUMNS = (
    "CustomerId Surname CreditScore Age Tenure Balance NumOfProducts HasCrCard IsActiveMember "
    "EstimatedSalary"
).split() + _ORDERED + list(FLAGS)
FE_FEATURES = FE_COLUMNS[2:]

# Scored records: the rule "50 or older leaves".
PREDICTED = f"""{FEATURED},
predicted AS (
  SELECT {', '.join(f'CAST({c} AS INT) AS {c}' if c in FLAGS else c for c in FE_COLUMNS)},
    CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM fe)"""

RULED = f"""{ACCOUNTS},
ruled AS (SELECT *, Gender = 'Female' AS Female,
  CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM accounts)"""

METRICS = f"""{RULED},
cells AS (SELECT Exited AS label, CAST(ChurnPrediction AS INT) AS prediction, count(*) AS n
  FROM ruled GROUP BY ALL),
classes AS (SELECT label AS cls FROM cells UNION SELECT prediction FROM cells),
per_class AS (
  SELECT cls AS label,
    coalesce(sum(n) FILTER (label = cls), 0) AS support,
    coalesce(sum(n) FILTER (prediction = cls), 0) AS predicted,
    coalesce(sum(n) FILTER (label = cls AND prediction = cls), 0) AS hits
  FROM classes, cells GROUP BY cls),
scored AS (
  SELECT label, support, hits, coalesce(hits / nullif(predicted, 0), 0) AS precision,
    coalesce(hits / nullif(support, 0), 0) AS recall,
    coalesce(2 * hits / nullif(predicted + support, 0), 0) AS f1 FROM per_class)"""

HISTORY = f"""{ACCOUNTS},
steps AS (SELECT CAST(unnest(range(20, 81, 5)) AS INT) AS step),
pairs AS (SELECT step, Exited AS label, CASE WHEN Age >= step THEN 1 ELSE 0 END AS prediction
  FROM accounts, steps),
step_classes AS (
  SELECT step, label AS cls FROM pairs UNION SELECT step, prediction FROM pairs),
step_counts AS (
  SELECT c.step, c.cls, count(*) FILTER (label = cls) AS support,
    count(*) FILTER (prediction = cls) AS predicted,
    count(*) FILTER (label = cls AND prediction = cls) AS hits
  FROM step_classes c JOIN pairs p ON p.step = c.step GROUP BY ALL),
history AS (
  SELECT step, sum(hits) / sum(support) AS accuracy,
    avg(coalesce(hits / nullif(predicted, 0), 0)) AS precision,
    avg(coalesce(hits / nullif(support, 0), 0)) AS recall,
    avg(coalesce(2 * hits / nullif(predicted + support, 0), 0)) AS f1
  FROM step_counts GROUP BY step)"""


def _hash(seed: int, purpose: str = "") -> str:
    prefix = f"{seed}:{purpose}:" if purpose else f"{seed}:"
    return f"substr(md5('{prefix}' || CustomerId), 1, 8)"


def _poisson_copies(rate_sql: str, seed: int, source: str, purpose: str = "over") -> str:
    """CTEs ``rate``, ``cuts`` and ``copied`` (source rows with the number of their copies)."""
    return f"""
rate AS (SELECT CAST({rate_sql} AS DOUBLE) AS r),
cuts AS (
  SELECT ceil(sum(exp(-r + j * ln(r) - lgamma(j + 1))) OVER (ORDER BY j) * 4294967296) AS cut
  FROM rate, (SELECT unnest(range(0, 120)) AS j)),
copied AS (
  SELECT s.*, (SELECT count(*) FROM cuts
    WHERE cut < 4294967296 AND CAST('0x' || {_hash(seed, purpose)} AS BIGINT) >= cut) AS copies
  FROM {source} s)"""


def _long(columns, source: str, expression: str) -> str:
    """(CustomerId, position, value) rows of several numeric columns."""
    return " UNION ALL ".join(
        f"SELECT CustomerId, CAST({i} AS INT) AS position, "
        f"{expression.format(c=f'CAST({c} AS DOUBLE)')} AS value FROM {source}"
        for i, c in enumerate(columns)
    )


_WHOLE = set(FLAGS) | set(
    "CreditScore Age Tenure NumOfProducts HasCrCard IsActiveMember newAge newCreditScore AgeScore "
    "BalanceScore SalaryScore".split()
)


def _type(column: str) -> str:
    return "INT" if column in _WHOLE else "DOUBLE"


def _filled(column: str) -> str:
    return f"coalesce(CAST({column} AS {_type(column)}), 0) AS {column}"


WIDE = f"""{FEATURED},
filled AS (SELECT CustomerId, Exited, {', '.join(_filled(c) for c in FE_FEATURES)} FROM fe),
wide AS (SELECT CustomerId, Exited, [{', '.join(f'CAST({c} AS DOUBLE)' for c in FE_FEATURES)}] AS vals
  FROM filled)"""


_COPY_KEY = "-(1 + CAST('0x' || substr(md5(src || '#' || copy), 1, 15) AS BIGINT))"


def _synthetic(source: str, seed: int) -> str:
    """CTEs up to ``spread``: the synthetic rows (vals) that bring ``source`` to parity."""
    return f"""
cells AS (SELECT CustomerId, Exited, unnest(range(1, 33)) AS f, unnest(vals) AS v FROM {source}),
codes AS (SELECT f, v, avg(Exited) AS code FROM cells GROUP BY f, v),
coded AS (SELECT CustomerId, list(code ORDER BY f) AS point
  FROM cells JOIN codes USING (f, v) WHERE Exited = 1 GROUP BY CustomerId),
near AS (
  SELECT a.CustomerId AS src, b.CustomerId AS dst FROM coded a JOIN coded b ON a.CustomerId <> b.CustomerId
  QUALIFY row_number() OVER (PARTITION BY a.CustomerId
    ORDER BY round(list_distance(a.point, b.point), 9), b.CustomerId) <= 5),
counted AS (SELECT src, f, v, count(*) AS n FROM near JOIN cells ON dst = CustomerId GROUP BY ALL),
made AS (
  SELECT src, list(v ORDER BY f) AS vals FROM (
    SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY src, f ORDER BY n DESC, v) = 1)
  GROUP BY src),
needed AS (SELECT sum(1 - Exited) - sum(Exited) AS n_new, sum(Exited) AS n_own FROM {source}),
seeds AS (
  SELECT CustomerId AS src, n_new // n_own + CASE WHEN row_number() OVER (
    ORDER BY CAST('0x' || substr(md5('{seed}:' || CustomerId), 1, 15) AS BIGINT), CustomerId)
    <= n_new % n_own THEN 1 ELSE 0 END AS copies FROM {source}, needed WHERE Exited = 1),
spread AS (
  SELECT src, vals, unnest(range(1, 1 + CAST(copies AS BIGINT))) AS copy FROM made JOIN seeds USING (src))"""


_KNN = """
pairs AS (
  SELECT q.vec_id AS src, c.vec_id AS dst, c.label,
    list_distance(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS d
  FROM embeddings q JOIN embeddings c ON {condition}),
near AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY d, dst) AS rank FROM pairs
  QUALIFY rank <= {k})"""

_BOX_COLUMNS = ("CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "EstimatedSalary")


def _iqr(column: str) -> str:
    return f"""
SELECT '{column}' AS feature, round(min(q1), 6) AS q1, round(min(q3), 6) AS q3,
  round(min(low), 6) AS lower_bound, round(min(high), 6) AS upper_bound,
  count(*) FILTER ({column} < low OR {column} > high) AS n_outliers,
  CAST(CASE
    WHEN avg({column}) FILTER ({column} < low OR {column} > high) < min(low)
      THEN max({column}) FILTER ({column} < low OR {column} > high)
    WHEN avg({column}) FILTER ({column} < low OR {column} > high) > min(high)
      THEN min({column}) FILTER ({column} < low OR {column} > high) END AS DOUBLE) AS expected_outlier
FROM accounts, (
  SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
    SELECT quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.75) AS q3 FROM accounts))"""


def _box(column: str) -> str:
    return f"""
SELECT a.Exited, '{column}' AS feature, round(min(q1), 6) AS q1, round(min(q2), 6) AS median,
  round(min(q3), 6) AS q3,
  round(least(min(q1), min({column}) FILTER ({column} >= low)), 6) AS whisker_low,
  round(greatest(min(q3), max({column}) FILTER ({column} <= high)), 6) AS whisker_high,
  count(*) FILTER ({column} < low OR {column} > high) AS n_outliers
FROM accounts a JOIN (
  SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
    SELECT Exited, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2,
      quantile_cont({column}, 0.75) AS q3 FROM accounts GROUP BY Exited)) q ON a.Exited = q.Exited
GROUP BY a.Exited"""


def _part_box(column: str) -> str:
    return f"""
SELECT a.l_partkey, '{column}' AS feature, round(min(q1), 6) AS q1, round(min(q2), 6) AS median, round(min(q3), 6) AS q3,
  round(least(min(q1), min({column}) FILTER ({column} >= low)), 6) AS whisker_low,
  round(greatest(min(q3), max({column}) FILTER ({column} <= high)), 6) AS whisker_high,
  count(*) FILTER ({column} < low OR {column} > high) AS n_outliers
FROM lineitem a JOIN (
  SELECT *, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
    SELECT l_partkey, quantile_cont({column}, 0.25) AS q1, quantile_cont({column}, 0.5) AS q2,
      quantile_cont({column}, 0.75) AS q3 FROM lineitem GROUP BY l_partkey)) q ON a.l_partkey = q.l_partkey
GROUP BY a.l_partkey"""


def _report(source: str, low: str, high: str, prefix: str) -> dict[str, str]:
    """The prediction reports over a CTE that ends ``prefix``."""
    position = f"floor((CreditScore - {low}) / (({high} - {low}) / 30))"
    return {
        "prediction_counts": f"""{prefix}
SELECT CAST(cls AS INT) AS prediction, count(*) FILTER (ChurnPrediction = cls) AS n_rows
FROM (SELECT unnest([0, 1]) AS cls), {source} GROUP BY cls""",
        "churn_by_gender": f"""{prefix}
SELECT CAST(Female AS INT) AS Female, round(avg(ChurnPrediction), 6) AS churn_rate,
  CASE CAST(Female AS INT) WHEN 1 THEN 'Female' WHEN 0 THEN 'Male' END AS Gender
FROM {source} GROUP BY ALL""",
        "credit_histogram": f"""{prefix}
SELECT CAST(greatest(0, least({position}, 29)) AS INT) AS bin,
  CASE ChurnPrediction WHEN 0 THEN 'Stayed' WHEN 1 THEN 'Churned' END AS churn_label,
  count(*) AS n_rows, round({low} + bin * (({high} - {low}) / 30), 6) AS bin_start,
  round({low} + (bin + 1) * (({high} - {low}) / 30), 6) AS bin_end
FROM {source} GROUP BY ALL""",
        "churn_by_age": f"""{prefix}
SELECT Age, round(avg(ChurnPrediction), 6) AS churn_rate FROM {source} GROUP BY Age""",
        "products_by_prediction": f"""{prefix}
SELECT NumOfProducts, ChurnPrediction AS prediction, count(*) AS n_rows FROM {source} GROUP BY ALL""",
    }


def _fe(select: str) -> str:
    return f"{FEATURED}\n{select}"


_ALL_FE = ", ".join(FE_COLUMNS)
_RAW = "CustomerId, Surname, CreditScore, Geography, Gender, Age, Tenure, Balance, NumOfProducts, " \
       "HasCrCard, IsActiveMember, EstimatedSalary, Exited"


def oracle_sql() -> dict[str, str]:
    sql = {
        # sources and sinks
        "read_table": f"{ACCOUNTS} SELECT CustomerId AS RowNumber, {_RAW} FROM accounts",
        "write_table": _fe(f"SELECT {_ALL_FE}, Exited FROM fe"),
        "decode_json": "SELECT event_id, CAST(props->>'$.k' AS INT) AS k FROM events",
        "encode_json": """
SELECT event_id, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":'
  || CASE WHEN event_type = 'click' THEN 'null' ELSE '"' || event_type || '"' END
  || ',"large":' || CASE WHEN value > 10 THEN 'true' ELSE 'false' END || '}' AS value
FROM events""",
        "read_predictions": f"{PREDICTED} SELECT * FROM predicted",
        "tail_predictions": f"{PREDICTED} SELECT * FROM predicted",
        "store_columns": f"{PREDICTED} SELECT {', '.join(f'{c} AS {c.lower()}' for c in FE_COLUMNS)}, "
        "ChurnPrediction AS churnprediction FROM predicted",
        "last_per_key": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1""",
        # columns
        "drop_identifiers": f"{ACCOUNTS} SELECT * EXCLUDE (CustomerId, Surname) FROM accounts",
        "project": f"{ACCOUNTS} SELECT CustomerId AS id, CreditScore AS score, Exited AS label FROM accounts",
        "cast_label": f"{ACCOUNTS} SELECT CustomerId, Exited FROM accounts",
        "bool_to_int": _fe(
            f"SELECT CustomerId, {', '.join(f'CAST({c} AS INT) AS {c}' for c in FLAGS)} FROM fe"
        ),
        "fill_nulls": f"""{ACCOUNTS}
SELECT CustomerId, nullif(Gender, 'Male') AS Gender, coalesce(nullif(Tenure, 0), 0) AS Tenure,
  coalesce(CASE WHEN Age >= 40 THEN Balance END, 0) AS Balance FROM accounts""",
        "filter_class": f"{ACCOUNTS} SELECT {_RAW} FROM accounts WHERE Exited = 1",
        "remove_outliers": f"{KEPT} SELECT {_RAW} FROM kept",
        "label_map": f"""{ACCOUNTS}
SELECT CustomerId, NumOfProducts,
  CASE NumOfProducts WHEN 1 THEN 'one' WHEN 2 THEN 'two' END AS products FROM accounts""",
        "lower_columns": f"""{ACCOUNTS}
SELECT CustomerId AS customerid, Surname AS surname, Age AS age FROM accounts""",
        "preview": f"{ACCOUNTS} SELECT {_RAW} FROM accounts ORDER BY CustomerId LIMIT 5",
        "shape": f"{KEPT} SELECT count(*) AS n_rows, CAST(13 AS INT) AS n_columns FROM kept",
        "at_risk": f"{RULED} SELECT CustomerId, Age, ChurnPrediction FROM ruled WHERE ChurnPrediction = 1",
        # features
        **{
            f"feature_{name}": f"{KEPT} SELECT CustomerId, {text} AS {name} FROM kept"
            for name, text in ROW_FEATURES.items()
        },
        **{
            f"feature_{name}": f"{BINNED} SELECT CustomerId, {name} FROM binned"
            for name in ("newCreditScore", "AgeScore", "BalanceScore", "SalaryScore")
        },
        "engineer_features": _fe(f"SELECT {_ALL_FE}, Exited FROM fe"),
        # encoding
        "quantile_cut": f"{BINNED} SELECT CustomerId, newCreditScore, AgeScore, SalaryScore FROM binned",
        "rank_cut": f"""{ACCOUNTS}
SELECT CustomerId, Balance, CAST(greatest(1, ceil((row_number() OVER (ORDER BY Balance, CustomerId) - 1)
  * 20 / (count(*) OVER () - 1))) AS INT) AS bin FROM accounts""",
        "label_encode": f"""{ACCOUNTS}
SELECT CustomerId, CAST(dense_rank() OVER (ORDER BY Geography) - 1 AS INT) AS Geography_code,
  CAST(dense_rank() OVER (ORDER BY Gender) - 1 AS INT) AS Gender_code FROM accounts""",
        "one_hot": f"""{ACCOUNTS}
SELECT CustomerId, Geography = 'Germany' AS Germany, Geography = 'Spain' AS Spain,
  Gender = 'Female' AS Female, Gender = 'Male' AS Male FROM accounts""",
        "attach_columns": f"""{ACCOUNTS}
SELECT CustomerId, Balance, Geography = 'Germany' AS Germany, Balance / EstimatedSalary AS BalanceSalary
FROM accounts""",
        "assemble": f"{FEATURED} {_long(FE_FEATURES, 'fe', 'coalesce({c}, 0)')}",
        "standardize_vector": f"{FEATURED} "
        + _long(
            FE_FEATURES, "fe",
            "round(coalesce((coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ())"
            " / nullif(stddev_samp(coalesce({c}, 0)) OVER (), 0), 0), 6)",
        ),
        "standardize_without_mean": f"{FEATURED} "
        + _long(
            FE_FEATURES, "fe",
            "round(coalesce(coalesce({c}, 0) / nullif(stddev_samp(coalesce({c}, 0)) OVER (), 0), 0), 6)",
        ),
        "standardize": f"{ACCOUNTS} SELECT CustomerId, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) AS {c}"
            for c in _BOX_COLUMNS
        )
        + " FROM accounts",
        "standardize_population": f"{ACCOUNTS} SELECT CustomerId, "
        + ", ".join(
            f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
            for c in _BOX_COLUMNS
        )
        + " FROM accounts",
        # split and balance
        "class_distribution": f"{ACCOUNTS} SELECT Exited, count(*) AS n_rows FROM accounts GROUP BY Exited",
        "random_split": f"""{ACCOUNTS}
SELECT CustomerId, CAST(CASE WHEN {_hash(42)} < 'cccccccd' THEN 0 ELSE 1 END AS INT) AS part FROM accounts""",
        "undersample": f"""{ACCOUNTS}
SELECT CustomerId, Exited FROM accounts WHERE Exited = 0 AND {_hash(42, 'under')} < '80000000'""",
        "oversample": f"""{ACCOUNTS}, leaving AS (SELECT * FROM accounts WHERE Exited = 1),
{_poisson_copies('2.0', 42, 'leaving')}
SELECT CustomerId, Exited, copies AS n_rows FROM copied WHERE copies > 0""",
        "balance_classes": f"""{ACCOUNTS}, leaving AS (SELECT * FROM accounts WHERE Exited = 1),
{_poisson_copies('2.0', 42, 'leaving')}
SELECT CustomerId, Exited, copies AS n_rows FROM copied WHERE copies > 0 UNION ALL
SELECT CustomerId, Exited, 1 FROM accounts WHERE Exited = 0 AND {_hash(42, 'under')} < '80000000'""",
        "oversample_to_ratio": f"""{ACCOUNTS}, leaving AS (SELECT * FROM accounts WHERE Exited = 1),
{_poisson_copies('(SELECT sum(1 - Exited) / sum(Exited) FROM accounts)', 0, 'leaving')}
SELECT CustomerId, Exited, copies AS n_rows FROM copied WHERE copies > 0 UNION ALL
SELECT CustomerId, Exited, 1 FROM accounts WHERE Exited = 0""",
        "undersample_to_ratio": f"""{ACCOUNTS}
SELECT CustomerId, Exited FROM accounts WHERE Exited = 1 OR
  CAST('0x' || {_hash(42, 'under')} AS BIGINT)
    < (SELECT sum(Exited) / sum(1 - Exited) FROM accounts) * 4294967296""",
        "class_weights": f"""{ACCOUNTS}
SELECT CustomerId, Exited, round(count(*) OVER () / (2 * count(*) OVER (PARTITION BY Exited)), 6) AS weight
FROM accounts""",
        "union_classes": f"{ACCOUNTS} SELECT CustomerId, Exited FROM accounts WHERE Exited IN (0, 1)",
        "smoten_oversample": f"""{WIDE}, {_synthetic('wide', 42)}
SELECT * FROM filled UNION ALL
SELECT {_COPY_KEY}, 1,
  {', '.join(f'CAST(vals[{i}] AS {_type(c)})' for i, c in enumerate(FE_FEATURES, 1))}
FROM spread""",
        "smoten_classes": f"""{WIDE},
three AS (SELECT CustomerId, CASE WHEN Exited = 1 THEN 2 WHEN vals[{FE_FEATURES.index('NumOfProducts') + 1}] <= 1 THEN 1 ELSE 0 END AS cls, vals FROM wide),
cells AS MATERIALIZED (SELECT CustomerId, cls, unnest(range(1, 33)) AS f, unnest(vals) AS v FROM three),
codes AS (SELECT f, v, avg((cls = 0)::INT) AS s0, avg((cls = 1)::INT) AS s1, avg((cls = 2)::INT) AS s2 FROM cells GROUP BY f, v),
coded AS MATERIALIZED (SELECT CustomerId, cls, f, s0, s1, s2 FROM cells JOIN codes USING (f, v)),
apart AS (SELECT cls, a.CustomerId AS src, b.CustomerId AS dst,
    round(sqrt(sum(pow(abs(a.s0 - b.s0) + abs(a.s1 - b.s1) + abs(a.s2 - b.s2), 2))), 9) AS d
  FROM coded a JOIN coded b USING (cls, f) WHERE a.CustomerId <> b.CustomerId GROUP BY ALL),
near AS (SELECT src, dst FROM apart QUALIFY row_number() OVER (PARTITION BY src ORDER BY d, dst) <= 5),
counted AS (SELECT src, f, v, count(*) AS n FROM near JOIN cells ON dst = CustomerId GROUP BY ALL),
made AS (SELECT src, list(v ORDER BY f) AS vals FROM (
  SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY src, f ORDER BY n DESC, v) = 1) GROUP BY src),
sizes AS (SELECT cls, count(*) AS n_own, max(count(*)) OVER () - count(*) AS n_new FROM three GROUP BY cls),
seeds AS (SELECT CustomerId AS src, cls, n_new // n_own + CASE WHEN row_number() OVER (PARTITION BY cls
    ORDER BY CAST('0x' || substr(md5('42:' || CustomerId), 1, 15) AS BIGINT), CustomerId) <= n_new % n_own
    THEN 1 ELSE 0 END AS copies FROM three JOIN sizes USING (cls)),
spread AS (SELECT src, cls, vals, unnest(range(1, 1 + CAST(copies AS BIGINT))) AS copy FROM made JOIN seeds USING (src))
SELECT CustomerId, CAST(cls AS INT) AS cls, {', '.join(f'CAST(vals[{i}] AS {_type(c)}) AS "{c}"' for i, c in enumerate(FE_FEATURES, 1))}
FROM three UNION ALL
SELECT {_COPY_KEY}, cls, {', '.join(f'CAST(vals[{i}] AS {_type(c)})' for i, c in enumerate(FE_FEATURES, 1))} FROM spread""",
        "oversample_then_smoten": f"""{WIDE}
SELECT Exited, count(*) AS n_rows, true AS keys_differ FROM (
  SELECT 0 AS Exited FROM wide WHERE Exited = 0 UNION ALL SELECT 1 FROM wide WHERE Exited = 0) GROUP BY Exited""",
        "smoten_then_folds": f"""{WIDE}, {_synthetic('wide', 42)},
every AS (SELECT CustomerId, Exited FROM wide UNION ALL SELECT {_COPY_KEY}, 1 FROM spread)
SELECT CAST(CASE WHEN {_hash(42)} < '{threshold(1 / 3)}' THEN 0
  WHEN {_hash(42)} < '{threshold(2 / 3)}' THEN 1 ELSE 2 END AS INT) AS fold,
  Exited, count(*) AS n_rows FROM every GROUP BY ALL""",
        "knn_holdout": f"""{WIDE},
train AS (SELECT * FROM wide WHERE {_hash(0)} < 'cccccccd'),
test AS (SELECT * FROM wide WHERE {_hash(0)} >= 'cccccccd'),
{_synthetic('train', 0)},
moments AS (SELECT f, avg(v) AS m, stddev_pop(v) AS s FROM cells GROUP BY f),
every AS (
  SELECT CustomerId AS id, Exited, true AS known, vals FROM train
  UNION ALL SELECT -row_number() OVER (), 1, true, vals FROM spread
  UNION ALL SELECT CustomerId, Exited, false, vals FROM test),
scaled AS (
  SELECT id, Exited, known, list(CASE WHEN s = 0 THEN 0 ELSE (v - m) / s END ORDER BY f) AS point
  FROM (SELECT id, Exited, known, unnest(range(1, 33)) AS f, unnest(vals) AS v FROM every)
  JOIN moments USING (f) GROUP BY ALL),
closest AS (
  SELECT q.id, q.Exited, c.Exited AS label, list_distance(q.point, c.point) AS d
  FROM scaled q JOIN scaled c ON c.known AND NOT q.known
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY list_distance(q.point, c.point), c.id) <= 9),
votes AS (
  SELECT id, Exited, label, count(*) FILTER (d = 0) AS copies, sum(1 / d) FILTER (d > 0) AS w
  FROM closest GROUP BY ALL)
SELECT id AS CustomerId, Exited, CAST(label AS DOUBLE) AS ChurnPrediction FROM votes
QUALIFY row_number() OVER (PARTITION BY id ORDER BY copies DESC,
  CASE WHEN copies > 0 THEN 0 ELSE w END DESC, label) = 1""",
        # neighbours
        "knn_approximate": """SELECT vec_id AS src, 10::BIGINT AS n_found, 0::BIGINT AS n_wrong, true AS recall_reached
          FROM embeddings""",
        "knn_cells": f"""WITH {ACCOUNTS.strip().removeprefix('WITH')},
          v AS MATERIALIZED (SELECT CustomerId AS id, [CreditScore / 160.0e0, Age / 19.0e0, Tenure / 3.0e0, Balance / 3000.0e0,
            NumOfProducts / 1.1e0, EstimatedSalary / 110000.0e0] AS x FROM accounts),
          p AS (SELECT q.id AS src, c.id AS dst, round(list_distance(q.x, c.x), 6) AS dist FROM v q JOIN v c ON q.id <> c.id)
          SELECT src, dst, dist, CAST(row_number() OVER (PARTITION BY src ORDER BY dist, dst) AS INT) AS rank, true AS saved
          FROM p QUALIFY rank <= 5""",
        "knn_graph": f"""WITH {ACCOUNTS.strip().removeprefix('WITH')}
          SELECT CustomerId AS src, 9::BIGINT AS n_found, 0::BIGINT AS n_wrong, true AS recall_reached,
            (SELECT count(*) FROM accounts) > 400 AS half_of_the_work FROM accounts""",
        "knn": f"WITH {_KNN.format(condition='true', k=10)} "
        "SELECT src, dst, CAST(rank AS INT) AS rank, round(d, 6) AS dist FROM near",
        "knn_edges": f"WITH {_KNN.format(condition='q.vec_id <> c.vec_id', k=9)} "
        "SELECT src, dst, CAST(rank AS INT) AS rank, round(d, 6) AS dist FROM near",
        "knn_classify": f"""WITH {_KNN.format(condition='q.vec_id <> c.vec_id', k=9)},
votes AS (
  SELECT src, label, count(*) FILTER (d = 0) AS copies, sum(1 / d) FILTER (d > 0) AS w
  FROM near GROUP BY ALL)
SELECT src AS vec_id, label AS prediction FROM votes
QUALIFY row_number() OVER (PARTITION BY src ORDER BY copies DESC,
  CASE WHEN copies > 0 THEN 0 ELSE w END DESC, label) = 1""",
        # evaluation
        "confusion_matrix": f"""{METRICS}
SELECT l.cls AS label, p.cls AS prediction, CAST(coalesce(n, 0) AS BIGINT) AS n_rows
FROM classes l CROSS JOIN classes p LEFT JOIN cells ON cells.label = l.cls AND cells.prediction = p.cls""",
        "accuracy": f"{METRICS} SELECT round(sum(hits) / sum(support), 6) AS accuracy FROM scored",
        "weighted_precision_recall": f"""{METRICS}
SELECT round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall FROM scored""",
        "f1": f"{METRICS} SELECT round(sum(f1 * support) / sum(support), 6) AS f1 FROM scored",
        "precision_recall_by_label": f"""{METRICS}
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall FROM scored""",
        "macro_metrics": f"""{METRICS}
SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall,
  round(avg(f1), 6) AS macro_f1 FROM scored""",
        "classification_report": f"""{METRICS}
SELECT CAST(label AS VARCHAR) AS entry, round(precision, 4) AS precision, round(recall, 4) AS recall,
  round(f1, 4) AS f1, CAST(support AS BIGINT) AS support FROM scored
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hits) / sum(support), 4), CAST(sum(support) AS BIGINT)
FROM scored
UNION ALL SELECT 'macro avg', round(avg(precision), 4), round(avg(recall), 4), round(avg(f1), 4),
  CAST(sum(support) AS BIGINT) FROM scored
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 4),
  round(sum(recall * support) / sum(support), 4), round(sum(f1 * support) / sum(support), 4),
  CAST(sum(support) AS BIGINT) FROM scored""",
        "auc_roc": f"""{ACCOUNTS},
scores AS (SELECT Exited, Age + NumOfProducts * 5.0e0 AS s FROM accounts),
ranked AS (
  SELECT Exited, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS r FROM scores)
SELECT round((sum(r) FILTER (Exited = 1) - sum(Exited) * (sum(Exited) + 1) / 2)
  / (sum(Exited) * sum(1 - Exited)), 6) AS auc FROM ranked""",
        "best_metrics": f"""{HISTORY}
SELECT round(max(accuracy), 6) AS best_accuracy, round(max(precision), 6) AS best_precision,
  round(max(recall), 6) AS best_recall, round(max(f1), 6) AS best_f1 FROM history""",
        "metric_history": f"""{HISTORY}
SELECT step, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1 FROM history ORDER BY step""",
        # statistics
        "churn_share": f"""{ACCOUNTS}
SELECT Exited, count(*) AS n_rows, round(100 * count(*) / sum(count(*)) OVER (), 1) AS percentage
FROM accounts GROUP BY Exited""",
        "iqr_summary": ACCOUNTS + " UNION ALL ".join(
            _iqr(c) for c in ("CreditScore", "Age", "NumOfProducts", "Balance", "EstimatedSalary")
        ),
        "box_stats_of_parts": " UNION ALL ".join(_part_box(c) for c in ("l_quantity", "l_extendedprice", "l_discount")),
        "box_stats": ACCOUNTS + " UNION ALL ".join(_box(c) for c in _BOX_COLUMNS),
        # reports
        **_report(
            "spanned", "low", "high",
            f"""{RULED},
spanned AS (SELECT *, min(CreditScore) OVER () AS low, max(CreditScore) OVER () AS high FROM ruled)""",
        ),
        "at_risk_customers": f"""{RULED}
SELECT CustomerId, Surname, CreditScore, Age, Balance, ChurnPrediction FROM ruled WHERE ChurnPrediction = 1""",
        **{
            f"live_{name}": text
            for name, text in _report("predicted", "300.0e0", "850.0e0", PREDICTED).items()
        },
        # streams, models and Python models: what must hold whatever the model learned
        "stream_records": f"{PREDICTED} SELECT * EXCLUDE (ChurnPrediction) FROM predicted",
        "score_stream": _fe("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM fe"),
        "fan_out": _fe("""
SELECT unnest(['messages', 'table']) AS sink, count(*) AS n_rows,
  CAST(sum(CustomerId) AS BIGINT) AS sum_ids FROM fe"""),
        "quarantine": _fe("""
SELECT '{"CustomerId":' || CustomerId || ',"Age":' AS value FROM fe WHERE Female"""),
        "quarantine_passed": _fe("SELECT CustomerId, Age FROM fe WHERE NOT Female"),
        "dead_letter": _fe("SELECT 'failing' AS sink, CustomerId FROM fe"),
        "last_message_wins": _fe(
            "SELECT CustomerId, Age, CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM fe"
        ),
        "score_stream_python": _fe(
            "SELECT CustomerId, CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM fe"
        ),
        "forest_learns_rule": _fe(
            "SELECT CustomerId, CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM fe"
        ),
        **{
            name: _fe(f"""
SELECT CustomerId, Exited, true AS is_class, true AS beats_chance FROM fe WHERE {_hash(seed)} >= 'cccccccd'""")
            for name, seed in (
                ("train_forest", 42), ("train_logistic", 0), ("train_linear_svm", 0),
                ("train_logistic_l2", 42), ("train_forest_default", 42), ("train_poly_svm", 42),
            )
        },
        "predict": _fe("SELECT CustomerId, Exited, true AS is_class, true AS beats_chance FROM fe"),
        "tune": """
SELECT 'maxDepth=' || d || ', numTrees=' || n AS setting, true AS better_than_chance, true AS has_winner
FROM (SELECT unnest([5, 10]) AS d), (SELECT unnest([50, 100]) AS n)""",
        "tune_save_report": "SELECT 1.0e0 AS accuracy, 1.0e0 AS auc, 1.0e0 AS macro_recall",
        "svm_calibrated": f"""{FEATURED},
drawn AS (SELECT 1 / (1 + exp((45 - Age) / 6.0e0)) AS chance,
  ('0x' || substr(md5('9:' || CustomerId), 1, 8))::BIGINT / 4294967296.0e0 AS u FROM fe)
SELECT CAST(least(floor(chance * 4), 3) AS INT) AS bin, count(*) AS n_rows, round(avg((u < chance)::INT), 6) AS rate,
  true AS platt_near, true AS isotonic_near FROM drawn GROUP BY bin""",
        "sink_ledger": _fe("SELECT unnest(['first', 'second']) AS sink, CustomerId, 1::BIGINT AS n_rows FROM fe"),
        "dead_letters_replayed": _fe("SELECT CustomerId, 1::BIGINT AS n_rows FROM fe"),
        "save_and_load_model": _fe("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_different FROM fe"),
        "score_with": _fe("SELECT CustomerId, CASE WHEN Age >= 50 THEN 1.0e0 ELSE 0.0e0 END AS ChurnPrediction FROM fe"),
        "scale_with": f"{FEATURED} {_long(('CreditScore', 'Age', 'Balance'), 'fe', '({c} - 10) / 4')}",
    }
    return sql
