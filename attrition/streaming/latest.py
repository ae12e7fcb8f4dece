"""The last record of each key over a whole stream.

The state holds, for each key, where its newest record stands in the order of the messages (such as
timestamp and offset). A record that is older, or the same again, is dropped, in whatever batch it comes; so sinks that write
by key hold one row for each key, the newest. State that is not renewed within ``ttl`` is given up.

Records are thinned to the newest of each key before the shuffle, so a key with a large share of the messages
is no hot spot. State is versioned with the batches: a batch that is repeated after a failure gives the
same records again.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from attrition.schemas import KEY

#: Keyed state needs this store; and state with a time to live asks for a batch without data after each batch, so that a
#: query over the data at hand would never end.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside the block may hold state by key; the session's settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _processor(ttl_ms: int | None) -> StatefulProcessor:
    """Lets a record of a key through if it is newer than all before it. ``place`` is its place in the order, as text
    that sorts alike. The class is made here, so that it travels by value: a process of the driver, which knows nothing of
    this package, loads it too."""

    class Newest(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.place = handle.getValueState("place", "place string", ttl_ms)

        def handleInputRows(self, key, rows, timerValues):
            best = None
            for part in rows:
                part = part.sort_values("place", kind="stable").iloc[-1:]
                if best is None or part["place"].iloc[0] > best["place"].iloc[0]:
                    best = part
            known = self.place.get() if self.place.exists() else None
            if best is not None and (known is None or best["place"].iloc[0] > known[0]):
                self.place.update((best["place"].iloc[0],))
                yield best[["record"]]

        def close(self) -> None:
            pass

    return Newest()


def _sortable(name: str, kind: T.DataType):
    """A value as text of fixed width that sorts as the value does; null goes first."""
    value = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        value, kind = F.unix_micros(value), T.LongType()
    elif isinstance(kind, T.DateType):
        value, kind = F.unix_date(value).cast("long"), T.LongType()
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        # The sign bit turned over makes the hexadecimal digits sort as the numbers.
        flipped = value.cast("long").bitwiseXOR(F.lit(-(2**63)))
        return F.coalesce(F.lpad(F.hex(flipped), 16, "0"), F.lit(""))
    raise TypeError(f"{name}: order by whole numbers, dates or timestamps, not {kind.simpleString()}")


def newest_records(
    records: DataFrame, order_by: str | Sequence[str], key: str = KEY, ttl: str | None = None
) -> DataFrame:
    """The records of a stream that are newer than all before them with their key, by ``order_by``; of one batch the
    newest only. Columns stay as they are (all become nullable); rows with a null key share one state. ``ttl`` is a duration in
    milliseconds, seconds, minutes, hours or days, such as ``"7 days"``.

    The query has to be started inside :func:`keyed_state`."""
    by = [order_by] if isinstance(order_by, str) else list(order_by)
    kinds = {f.name: f.dataType for f in records.schema}
    # Records travel as text: types, nulls and names are Spark's own affair.
    exact = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
    rows = records.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{key}`").cast("string")), F.lit("")).alias("name"),
        F.concat(*[_sortable(c, kinds[c]) for c in by]).alias("place"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns]), exact).alias("record"),
    )

    def thin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield part.sort_values("place", kind="stable").drop_duplicates("name", keep="last")

    ttl_ms = None if ttl is None else milliseconds(ttl)
    newest = (
        rows.mapInPandas(thin, "name string, place string, record string")
        .groupBy("name")
        .transformWithStateInPandas(_processor(ttl_ms), "record string", "Append", "None" if ttl is None else "ProcessingTime")
    )
    return newest.select(F.from_json("record", records.schema, exact).alias("_record")).select("_record.*")


def milliseconds(duration: str) -> int:
    number, unit = duration.split()
    units = {"millisecond": 1, "second": 1000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(number) * units[unit.removesuffix("s")]
