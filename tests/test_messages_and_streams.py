from __future__ import annotations

import datetime
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.plans import reports as R
from attrition.plans.catalog import predicted
from attrition.plans.models import train_forest
from attrition.schemas import PREDICTION, PREDICTION_SCHEMA, SCORING_SCHEMA
from attrition.sources import database as D
from attrition.sources import messages as J
from attrition.sources import tables as P
from attrition.sources.scratch import shared_base, shared_dir
from attrition.streaming import latest as N
from attrition.streaming import live as L
from attrition.streaming import scoring as Z

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def records(features):
    return features.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCORING_SCHEMA]
    ).cache()


@pytest.fixture(scope="module")
def model(features):
    return train_forest(features, num_trees=8, max_depth=5)


def write_lines(df, path, files):
    J.encode_json(df).repartition(files).write.mode("append").text(str(path))


def source(spark, path):
    return J.stream_source(spark, "text", {"path": str(path), "maxFilesPerTrigger": "1"})


def finish(query):
    Z.await_stream(query)


def test_json_keeps_nulls_and_types(spark):
    df = spark.createDataFrame([(1, None, 2.5, True)], "a int, b string, c double, d boolean")
    text = J.encode_json(df).first().value
    assert json.loads(text) == {"a": 1, "b": None, "c": 2.5, "d": True}
    keyed = J.encode_json(df, key="a").first()
    assert keyed.key == "1"


def test_broken_messages(spark):
    df = spark.createDataFrame(
        [('{"CustomerId": 1, "Age": 30}',), ("{bad",), ('{"CustomerId": 2, "Germany": 1}',), (None,)],
        "value string",
    )
    rows = J.decode_json(df, corrupt=True).collect()
    assert [r[J.CORRUPT] is None for r in rows] == [True, False, False, False]
    assert rows[0].Age == 30 and rows[0].Surname is None
    assert sorted(r.value for r in Z.quarantine(df).collect()) == [
        "", '{"CustomerId": 2, "Germany": 1}', "{bad",
    ]
    plain = J.decode_json(df).collect()
    assert plain[1].CustomerId is None and len(plain) == 4


def test_bytes_are_decoded(spark):
    df = spark.createDataFrame([(bytearray(b'{"Age": 3}'),)], "value binary")
    assert J.decode_json(df).first().Age == 3


def test_broker_options():
    read = J.broker_options("h:1", "t", "earliest", {"failOnDataLoss": "false"})
    assert read == {
        "kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }
    written = J.topic_write_options("h:1", "t")
    assert written["kafka.acks"] == "all" and written["kafka.retries"] == "3"


def test_csv_needs_a_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(10).withColumn("x", F.col("id") / 3)
    P.write_table(df, path, single_file=True)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) == 1
    with pytest.raises(ValueError):
        P.read_table(spark, path)
    assert P.read_table(spark, path, infer_schema=True).dtypes == [("id", "int"), ("x", "double")]
    assert P.read_table(spark, path, schema=df.schema).orderBy("id").collect() == df.collect()


def test_scratch_follows_the_session(spark):
    assert shared_base(spark) == spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "a") != shared_dir(spark, "a")


# --- database (no database is started here: statements and options only) ------------------------


def test_merge_statements():
    text = D.merge_statement("p", "s", ["customerid", "age"])
    assert text == (
        "MERGE INTO p t USING s s ON t.customerid = s.customerid WHEN MATCHED THEN UPDATE SET "
        "age = s.age WHEN NOT MATCHED THEN INSERT (customerid, age) VALUES (s.customerid, s.age)"
    )
    other = D.merge_statement("p", "s", ["customerid", "age"], dialect="on_conflict")
    assert other.endswith("ON CONFLICT (customerid) DO UPDATE SET age = EXCLUDED.age")
    with pytest.raises(ValueError):
        D.merge_statement("p", "s", ["customerid"], dialect="other")


def test_store_columns_are_found_by_name(spark):
    df = predicted(spark, "/root/testdata/sf0.001").select(*PREDICTION_SCHEMA.fieldNames()[::-1])
    stored = D.store_columns(df)
    assert stored.columns == [c.lower() for c in PREDICTION_SCHEMA.fieldNames()]
    assert stored.filter("customerid IS NULL OR numofproducts IS NULL").isEmpty()
    options = D.jdbc_write_options("jdbc:x", "t", {"user": "u"})
    assert options["batchsize"] == "10000" and options["user"] == "u"


def test_last_record_of_a_key_wins(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 2), (2, "d", 1)], "CustomerId int, v string, at int")
    assert sorted((r.CustomerId, r.v) for r in D.last_per_key(df, order_by="at").collect()) == [
        (1, "b"), (2, "d"),
    ]
    assert D.last_per_key(df).count() == 2


def test_upsert_goes_through_one_staging_table(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(D, "execute_statements", lambda s, u, statements, p: calls.append(statements))

    class Writer:
        def format(self, f):
            return self

        def options(self, **o):
            calls.append(o["dbtable"])
            return self

        def mode(self, m):
            return self

        def save(self):
            pass

    monkeypatch.setattr(type(spark.range(1)), "write", property(lambda df: Writer()))
    df = predicted(spark, "/root/testdata/sf0.001")
    D.write_jdbc(df, "jdbc:x", "p")
    D.write_jdbc(df, "jdbc:x", "p", upsert=True)
    assert calls[0] == "p" and calls[1].startswith("p_staging_")
    assert calls[2][0].startswith("MERGE INTO p") and len(calls[2]) == 1
    assert calls[3] == [f"DROP TABLE IF EXISTS {calls[1]}"]


# --- streams -----------------------------------------------------------------------------------


def test_stream_equals_batch_and_restarts(spark, records, model, tmp_path):
    lines, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    first, second = records.randomSplit([0.5, 0.5], 1)
    write_lines(first, lines, 3)

    def run():
        query = Z.start_scoring(
            source(spark, lines), model, {"table": Z.files_sink(out)}, mark, available_now=True
        )
        finish(query)
        return query

    query = run()
    assert len(query.recentProgress) >= 3
    seen = [p["observedMetrics"]["scoring"] for p in query.recentProgress if p["numInputRows"]]
    assert sum(m["n_rows"] for m in seen) == first.count()
    write_lines(second, lines, 2)
    run()
    got = spark.read.parquet(out).drop("batch_id").orderBy("CustomerId")
    expected = Z.score_records(records, model).orderBy("CustomerId")
    assert got.columns == PREDICTION_SCHEMA.fieldNames()
    assert got.collect() == expected.collect()


def test_start_wait_and_stop(spark, tmp_path):
    spark.range(3).selectExpr("cast(id as string) value").write.text(str(tmp_path / "in"))
    seen = []
    query = Z.start_stream(
        source(spark, tmp_path / "in"), lambda df, i: seen.append(df.count()),
        str(tmp_path / "mark"), interval="1 second", name="waiting",
    )
    query.processAllAvailable()
    assert Z.await_stream(query, timeout=0.1) is False and query.name == "waiting"
    Z.stop_stream(query)
    Z.stop_stream(query)
    assert not query.isActive and Z.await_stream(query) and sum(seen) == 3


def test_compat_scores_broken_messages(spark, model, tmp_path):
    spark.createDataFrame([("{bad",), ('{"CustomerId": 5}',)], "value string").write.text(str(tmp_path / "in"))
    for compat, count in ((True, 2), (False, 1)):
        df = Z.score_stream(spark.read.text(str(tmp_path / "in")), model, compat=compat)
        assert df.count() == count
    zero = Z.score_stream(spark.read.text(str(tmp_path / "in")), model, compat=True)
    assert zero.filter("CustomerId = 0").first().Surname is None


def test_repeated_batch_replaces_its_rows(spark, records, tmp_path):
    sink = Z.files_sink(str(tmp_path / "out"))
    for _ in range(2):
        Z.fan_out(records, 7, {"table": sink})
    assert spark.read.parquet(str(tmp_path / "out")).count() == records.count()


def test_failing_sink(spark, records, tmp_path):
    def failing(df, batch_id):
        raise OSError("down")

    with pytest.raises(OSError):
        Z.fan_out(records, 0, {"bad": failing})
    good = Z.files_sink(str(tmp_path / "good"))
    Z.fan_out(
        records, 0, {"bad": failing, "good": good},
        dead_letter=lambda name: Z.files_sink(str(tmp_path / name)),
    )
    assert spark.read.parquet(str(tmp_path / "bad")).count() == records.count()
    assert spark.read.parquet(str(tmp_path / "good")).count() == records.count()
    Z.fan_out(records.limit(0), 1, {"bad": failing})


def test_scoring_plan_stays_in_the_engine(spark, model, tmp_path):
    spark.createDataFrame([('{"CustomerId": 5}',)], "value string").write.text(str(tmp_path / "in"))
    plan = Z.score_stream(spark.read.text(str(tmp_path / "in")), model)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text


def test_live_reports_equal_batch_reports(spark, tmp_path):
    rows = predicted(spark, SF).cache()
    lines, base = tmp_path / "in", str(tmp_path / "live")
    write_lines(rows, lines, 2)

    def follow():
        stream = J.tail_predictions(spark, "text", {"path": str(lines), "maxFilesPerTrigger": "1"})
        for query in L.live_reports(stream, base, available_now=True).values():
            finish(query)

    follow()
    write_lines(rows.limit(100), lines, 1)
    follow()
    whole = J.read_predictions(spark, "text", {"path": str(lines)})
    assert whole.count() == rows.count() + 100
    for name, report in L.LIVE_REPORTS.items():
        got = L.latest_report(spark, f"{base}/{name}")
        keys = got.columns
        assert got.orderBy(*keys).collect() == report(whole).select(*keys).orderBy(*keys).collect()


def test_absent_class_is_reported_as_zero(spark):
    df = spark.createDataFrame([(1.0,)], "ChurnPrediction double")
    assert sorted(tuple(r) for r in R.prediction_counts(df).collect()) == [(0, 0), (1, 1)]
    assert [r.n_rows for r in R.prediction_counts(df.limit(0)).collect()] == [0, 0]


def test_histogram_bins(spark):
    df = spark.createDataFrame(
        [(v, 0.0) for v in (0, 1, 9, 10, -5, 99, None)], "CreditScore int, ChurnPrediction double"
    )
    bins = {r.bin: r.n_rows for r in R.credit_histogram(df, 5, 0, 10).collect()}
    assert bins == {-1: 1, 0: 2, 4: 2, 5: 1}
    one = spark.createDataFrame([(4, 1.0)], "CreditScore int, ChurnPrediction double")
    assert R.credit_histogram(one).first().bin == 0


def test_newest_record_over_all_batches(spark, tmp_path):
    """A late message in a later batch, a repeat, a null key, a hot key, and names that Python would change."""
    schema = "CustomerId long, `_v` string, at timestamp, n int, price double"
    day = "2024-01-0"
    batches = [
        [(1, "new", f"{day}5", 2, 1.5), (2, "a", f"{day}1", 0, None), (1, "old", f"{day}2", 9, 0.1), (None, "n", f"{day}1", 0, 0.0)],
        [(1, "late", f"{day}5", 1, 7.0), (2, "a", f"{day}1", 0, None), (3, None, f"{day}1", None, float("inf"))],
        [(2, "b", f"{day}7", 0, 2.0), (None, "m", f"{day}2", 0, 0.0)] + [(3, f"x{i}", f"{day}1", i, 0.3) for i in range(50)],
    ]
    for i, rows in enumerate(batches):
        given = [(k, v, datetime.datetime.fromisoformat(t), n, p) for k, v, t, n, p in rows]
        spark.createDataFrame(given, schema).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = J.stream_source(
        spark, "parquet", {"path": f"{tmp_path}/in/*", "maxFilesPerTrigger": "1"}, T.StructType.fromDDL(schema)
    )
    out = N.newest_records(stream, ["at", "n"], ttl="7 days")
    before = [spark.conf.get(name, None) for name in N.SETTINGS]
    with N.keyed_state(spark):
        query = Z.start_stream(out, Z.files_sink(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", available_now=True)
    assert [spark.conf.get(name, None) for name in N.SETTINGS] == before
    Z.await_stream(query)
    assert sum(1 for p in query.recentProgress if p["numInputRows"]) == 3
    rows = spark.read.parquet(f"{tmp_path}/out").collect()
    assert sorted((str(r.CustomerId), str(r["_v"]), r.n, str(r.price)) for r in rows) == sorted(
        [("1", "new", 2, "1.5"), ("2", "a", 0, "None"), ("None", "n", 0, "0.0"), ("3", "None", None, "inf")]
        + [("2", "b", 0, "2.0"), ("None", "m", 0, "0.0"), ("3", "x49", 49, "0.3")]
    )
    assert {r["at"].day for r in rows if r.CustomerId == 1} == {5}
    with pytest.raises(TypeError, match="order by"):
        N.newest_records(stream, "price")


def test_one_state_for_all_reports(spark):
    known = predicted(spark, SF).limit(300)
    odd = known.limit(9).withColumn("_n", F.monotonically_increasing_id() % 3)
    for name, value in (("CreditScore", 9_999), ("Age", None), (PREDICTION, 2.0), ("Female", None)):
        odd = odd.withColumn(name, F.when(F.col("_n") == 1, F.lit(value).cast(known.schema[name].dataType)).otherwise(F.col(name)))
    odd = odd.withColumn(PREDICTION, F.when(F.col("_n") != 2, F.col(PREDICTION)))
    odd = odd.withColumn("CreditScore", F.when(F.col("_n") != 2, F.col("CreditScore")))
    ruled_rows = known.unionByName(odd.drop("_n")).cache()
    states = L.report_states(ruled_rows)
    for name, report in L.LIVE_REPORTS.items():
        want = report(ruled_rows)
        got = L.report_of(states, name, ruled_rows.schema)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name
