"""Continuous scoring of JSON records."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from contextlib import nullcontext

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from attrition.functions.columns import is_empty
from attrition.operators.udf import scale_with, score_with
from attrition.plans.models import predict
from attrition.plans.preparation import model_input
from attrition.schemas import FEATURES, KEY, PREDICTION, PREDICTION_SCHEMA
from attrition.sources.database import last_per_key, write_jdbc
from attrition.sources.messages import CORRUPT, decode_json, write_topic
from attrition.sources.scratch import pinned
from attrition.streaming.latest import keyed_state, newest_records
from attrition.streaming.ledger import Ledger

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


#: A fitted pipeline, or any function that adds the prediction to the model's input.
Scorer = PipelineModel | Callable[[DataFrame], DataFrame]


def python_scorer(
    predictor, scaler=None, features: Sequence[str] = FEATURES, output: str = PREDICTION
) -> Scorer:
    """A scorer of any object with a vectorised ``predict``, behind one with ``transform`` if given.
    Both see a matrix of the features in their order."""

    def score(df: DataFrame) -> DataFrame:
        rows = df.withColumn("_matrix", F.array(*[F.col(c).cast("double") for c in features]))
        if scaler is not None:
            rows = scale_with(rows, scaler, "_matrix", "_matrix")
        return score_with(rows, predictor, "_matrix", output).drop("_matrix")

    return score


def score_records(records: DataFrame, model: Scorer) -> DataFrame:
    """Typed records to prediction records; extra columns of the input stay behind them."""
    rows = model_input(records)
    scored = predict(model, rows) if isinstance(model, PipelineModel) else model(rows)
    names = PREDICTION_SCHEMA.fieldNames()
    return scored.select(*names, *[c for c in scored.columns if c not in names])


def score_stream(
    source: DataFrame, model: Scorer, compat: bool = False, keep_corrupt: bool = False,
    keep: Sequence[str] = (),
) -> DataFrame:
    """``value`` messages to prediction records, as one plan without state.

    Broken messages are left out, or returned with their text in ``_corrupt_record`` if
    ``keep_corrupt``. ``compat`` scores them as records full of zeros instead. ``keep`` names columns
    of the source, such as a topic's offset and timestamp, that stay behind the record."""
    if compat:
        return score_records(decode_json(source, keep=keep), model)
    scored = score_records(decode_json(source, corrupt=True, keep=keep), model)
    return scored if keep_corrupt else scored.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def quarantine(source: DataFrame) -> DataFrame:
    """Text of the messages that cannot be read as records."""
    return (
        decode_json(source, corrupt=True)
        .filter(F.col(CORRUPT).isNotNull())
        .select(F.col(CORRUPT).alias("value"))
    )


# --- sinks ---------------------------------------------------------------------------------


def files_sink(path: str, fmt: str = "parquet") -> Sink:
    """One folder per batch, replaced when a batch is repeated after a failure."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    return write


def latest_files_sink(path: str, order_by: str | Sequence[str], key: str = KEY) -> Sink:
    """As :func:`files_sink`, with the last record of each key only."""

    def write(df: DataFrame, batch_id: int) -> None:
        files_sink(path)(last_per_key(df, key, order_by), batch_id)

    return write


def messages_sink(path: str) -> Sink:
    """JSON lines, one folder per batch: a topic's stand-in on files."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_topic(df, {"path": f"{path}/batch_id={batch_id}"}, "text", mode="overwrite")

    return write


def topic_sink(options: Mapping[str, str], key: str | None = None) -> Sink:
    """Publish to a broker; a repeated batch is published again (at least once)."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_topic(df, options, "kafka", key)

    return write


def jdbc_sink(url: str, table: str, **settings) -> Sink:
    """Merge into the prediction store; repeating a batch changes nothing. Give ``order_by`` columns
    that the stream keeps (``keep``), such as timestamp and offset, so that the last record of a
    customer wins."""

    def write(df: DataFrame, batch_id: int) -> None:
        write_jdbc(df, url, table, **{"upsert": True, **settings})

    return write


def fan_out(
    batch: DataFrame,
    batch_id: int,
    sinks: Mapping[str, Sink],
    broken: Sink | None = None,
    dead_letter: Callable[[str], Sink] | None = None,
) -> None:
    """Give a scored micro-batch to several sinks. It is computed once.

    A failing sink fails the batch, which is then repeated from the checkpoint. With
    ``dead_letter`` the rows go to ``dead_letter(sink name)`` instead and the stream goes on."""
    with pinned(batch) as rows:
        if is_empty(rows):
            return
        good = rows
        if CORRUPT in rows.columns:
            good = rows.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
            if broken is not None:
                bad = rows.filter(F.col(CORRUPT).isNotNull())
                broken(bad.select(F.col(CORRUPT).alias("value")), batch_id)
        for name, sink in sinks.items():
            try:
                sink(good, batch_id)
            except Exception:
                if dead_letter is None:
                    raise
                log.exception("batch %s: sink %s failed, rows set aside", batch_id, name)
                dead_letter(name)(good, batch_id)


# --- life cycle ----------------------------------------------------------------------------


def start_stream(
    df: DataFrame,
    each_batch: Sink,
    checkpoint: str,
    output_mode: str = "append",
    available_now: bool = False,
    interval: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a query whose progress is kept in ``checkpoint``. ``available_now`` ends after the
    data at hand; otherwise batches start at ``interval`` or as soon as possible."""
    writer = (
        df.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(each_batch)
    )
    if name:
        writer = writer.queryName(name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return writer.start()


def await_stream(query: StreamingQuery, timeout: float | None = None) -> bool:
    """Wait for the end; True if it ended. A failure of the query is raised."""
    if timeout is not None:
        return query.awaitTermination(timeout)
    query.awaitTermination()
    return True


def stop_stream(query: StreamingQuery) -> None:
    if query.isActive:
        query.stop()


def start_scoring(
    source: DataFrame,
    model: Scorer,
    sinks: Mapping[str, Sink],
    checkpoint: str,
    broken: Sink | None = None,
    compat: bool = False,
    dead_letter: Callable[[str], Sink] | None = None,
    keep: Sequence[str] = (),
    newest_by: str | Sequence[str] | None = None,
    ttl: str | None = None,
    ledger: Ledger | None = None,
    **trigger,
) -> StreamingQuery:
    """Score a message stream into ``sinks``. Row counts of each batch are in the query's progress
    under ``scoring``.

    ``newest_by`` names kept columns that order the messages, such as timestamp and offset: of each customer
    only records that are newer than all before them are passed on, see :func:`newest_records`. Broken messages
    have no customer; they need a query of their own then.

    With a ``ledger``, a batch that is repeated after a failure skips the sinks that had finished it."""
    if ledger is not None:
        sinks = {name: ledger.once(name, sink) for name, sink in sinks.items()}
    scored = score_stream(source, model, compat=compat, keep_corrupt=newest_by is None, keep=keep)
    if newest_by is not None:
        if broken is not None:
            raise ValueError("broken messages are not kept with newest_by")
        scored = newest_records(scored, newest_by, ttl=ttl)
    bad = F.count(F.col(CORRUPT)) if CORRUPT in scored.columns else F.lit(0).cast("bigint")
    observed = scored.observe(
        "scoring",
        F.count(F.lit(1)).alias("n_rows"),
        bad.alias("n_broken"),
        F.sum(PREDICTION).alias("n_predicted"),
    )
    with keyed_state(source.sparkSession) if newest_by is not None else nullcontext():
        return start_stream(
            observed,
            lambda batch, batch_id: fan_out(batch, batch_id, sinks, broken, dead_letter),
            checkpoint,
            **trigger,
        )
