"""Which sinks have finished which batch.

A batch that fails is repeated as a whole. The ledger, a folder beside the checkpoint, has an empty file for each
sink and batch that is done, so a repeated batch skips the sinks that are finished, and a sink that appends is not given
its rows twice. Between a sink's last write and its mark a crash can still repeat it: sinks that must not see
that have to write by key.

Rows that were set aside (dead letters) are given to their sink again by :func:`replay`, at most ``most_tries`` times each.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame, int], None]


class Ledger:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _file(self, kind: str, name: str, number: int):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{kind}/{name}/{number}")
        return place, place.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _has(self, kind: str, name: str, number: int) -> bool:
        place, store = self._file(kind, name, number)
        return store.exists(place)

    def _mark(self, kind: str, name: str, number: int) -> None:
        place, store = self._file(kind, name, number)
        store.create(place, True).close()

    def finished(self, sink: str, batch_id: int) -> bool:
        return self._has("done", sink, batch_id)

    def finish(self, sink: str, batch_id: int) -> None:
        self._mark("done", sink, batch_id)

    def once(self, name: str, sink: Sink) -> Sink:
        """The sink, but for batches that it has finished."""

        def write(df: DataFrame, batch_id: int) -> None:
            if not self.finished(name, batch_id):
                sink(df, batch_id)
                self.finish(name, batch_id)

        return write

    def tries(self, sink: str, batch_id: int) -> int:
        n = 0
        while self._has("tries", f"{sink}/{batch_id}", n):
            n += 1
        return n

    def tried(self, sink: str, batch_id: int) -> None:
        self._mark("tries", f"{sink}/{batch_id}", self.tries(sink, batch_id))


def set_aside(base: str) -> Callable[[str], Sink]:
    """Dead letters in a folder for each sink and batch, as :func:`replay` reads them."""

    def of(name: str) -> Sink:
        def write(df: DataFrame, batch_id: int) -> None:
            df.write.mode("overwrite").parquet(f"{base}/{name}/{batch_id}")

        return write

    return of


def replay(ledger: Ledger, base: str, sinks: Mapping[str, Sink], most_tries: int = 3) -> dict[str, list[int]]:
    """Give dead letters to their sinks again, oldest batch first. A batch that its sink takes is marked as done; one that fails
    counts a try and is left alone after ``most_tries``. Returns the batches still set aside, by sink."""
    left: dict[str, list[int]] = {}
    for name, sink in sinks.items():
        folder = ledger.spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}")
        store = folder.getFileSystem(ledger.spark._jsc.hadoopConfiguration())
        entries = store.listStatus(folder) if store.exists(folder) else []
        batches = sorted(int(e.getPath().getName()) for e in entries if e.getPath().getName().isdigit())
        for batch in batches:
            if ledger.finished(name, batch):
                continue
            if ledger.tries(name, batch) < most_tries:
                try:
                    sink(ledger.spark.read.parquet(f"{base}/{name}/{batch}"), batch)
                    ledger.finish(name, batch)
                    continue
                except Exception:
                    ledger.tried(name, batch)
                    log.exception("batch %s: sink %s failed again", batch, name)
            left.setdefault(name, []).append(batch)
    return left
