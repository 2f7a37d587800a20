"""Late rows of every micro-batch of a stateful query, kept in a folder of their own.

Spark keeps a limited number of progress reports.  Here each report is written out as it comes, one
small file for each batch, and sums are taken over the files.  A batch that is repeated overwrites
its file.  The batches that the checkpoint lists as committed say whether the files are complete.
"""

from __future__ import annotations

import contextlib
import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from txnlake import files

WAIT_SECONDS = 60


@dataclass(frozen=True)
class Place:
    """Where a query keeps its checkpoint and its counters."""

    checkpoint: str
    counters: str


class _Writer(StreamingQueryListener):
    def __init__(self, spark: SparkSession, places: dict[str, Place]):
        self.spark, self.places = spark, places

    def onQueryProgress(self, event):
        report = event.progress
        place = self.places.get(report.name)
        if place is None:
            return
        late = sum(state.numRowsDroppedByWatermark for state in report.stateOperators)
        path = f"{place.counters}/{report.batchId}"
        # A report without late rows (an idle trigger) does not replace one that has them.
        if late or not files.exists(self.spark, path):
            files.write_text(self.spark, path, json.dumps({"late": late}))

    def onQueryStarted(self, event):
        pass

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


@contextlib.contextmanager
def recorded(spark: SparkSession, places: dict[str, Place]) -> Iterator[None]:
    """Record the queries of these names for the length of a `with` block."""
    writer = _Writer(spark, places)
    before = {name: last_batch(spark, place) for name, place in places.items()}
    spark.streams.addListener(writer)
    try:
        yield
        # Reports come a little after the queries end.
        until = time.monotonic() + WAIT_SECONDS
        while any(missing(spark, place, before[name]) for name, place in places.items()):
            if time.monotonic() > until:
                raise TimeoutError(f"no counters of the last batches of {sorted(places)}")
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(writer)


def _numbers(spark: SparkSession, folder: str) -> set[int]:
    names = (path.rsplit("/", 1)[1] for path in files.children(spark, folder))
    return {int(name) for name in names if name.isdigit()}


def last_batch(spark: SparkSession, place: Place) -> int:
    """The last batch that the checkpoint has as committed, -1 before the first."""
    return max(_numbers(spark, f"{place.checkpoint}/commits"), default=-1)


def missing(spark: SparkSession, place: Place, after: int = -1) -> set[int]:
    """Batches after a given one, up to the last committed one, without counters.

    Spark clears old entries of a checkpoint, so their numbers are counted, not listed.
    """
    wanted = set(range(after + 1, last_batch(spark, place) + 1))
    return wanted - _numbers(spark, place.counters)


def _reports(spark: SparkSession, place: Place, after: int) -> list[dict]:
    gone = missing(spark, place, after)
    if gone:
        raise RuntimeError(f"no counters of batches {sorted(gone)[:5]} in {place.counters}")
    numbers = sorted(n for n in _numbers(spark, place.counters) if n > after)
    texts = (files.read_text(spark, f"{place.counters}/{n}") for n in numbers)
    return [json.loads(text) for text in texts]


def late_rows(spark: SparkSession, place: Place, after: int = -1) -> int:
    """Rows that came after the watermark, summed over the batches after a given one."""
    return sum(report["late"] for report in _reports(spark, place, after))
