"""Late rows as rows: a pass before the windows that keeps what they would drop.

Each micro-batch is split by the watermark that the batches before it have left, the latest event
time seen less the delay allowed.  Rows whose window the watermark has closed go to a part of their
own, with their delay; all others, those without a time included, go on.  Both parts of a batch become
visible by one rename, with their counts and the next watermark, so accepted and late rows together are
the input, and a repeated batch adds nothing.  Nothing is shuffled.

A stream with the same delay over the accepted rows drops none of them.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake import files, schemas
from txnlake.streaming.batches import BatchTable
from txnlake.streaming.layers import WRITERS

SECOND = 1_000_000
MARK = "_watermark"
ACCEPTED, LATE = "late=false", "late=true"
COUNTED = "arrivals"


@dataclass(frozen=True)
class LateGate:
    """Folders and limits of one gate.

    `window_seconds` is the length of the windows to come: a row is late once its window has closed;
    with 0 a row is late as soon as its own time is behind the watermark.  `followers` are files in
    which readers of the accepted rows keep how far they are (see `BatchTable`); folders are deleted
    only behind them.
    """

    root: str
    window_seconds: int = 3600
    delay_seconds: int = 600
    schema: str = schemas.SILVER
    followers: tuple[str, ...] = ()

    @property
    def table(self) -> BatchTable:
        parts = {ACCEPTED: self.schema, LATE: f"{self.schema}, delay_seconds DOUBLE"}
        return BatchTable(f"{self.root}/batches", parts, self.followers)

    def start(self, rows: DataFrame, **trigger) -> StreamingQuery:
        """Take in a stream of rows; `trigger` as for a stream writer, by default what is there."""
        writer = rows.writeStream.foreachBatch(self.take).trigger(**(trigger or {"availableNow": True}))
        return writer.option("checkpointLocation", f"{self.root}/checkpoint").start()

    def take(self, batch: DataFrame, number: int) -> None:
        """One micro-batch, split and published."""
        spark = batch.sparkSession
        mark = self._mark(spark, number - 1)
        at = F.unix_micros("event_timestamp")
        closes = at  # when the row is no longer of use
        if self.window_seconds:
            span = self.window_seconds * SECOND
            closes = at - F.pmod(at, F.lit(span)) + span - 1
        is_late = F.lit(False) if mark is None else F.coalesce(closes < mark, F.lit(False))
        delay = F.when(is_late, (F.lit(mark) - at) / SECOND)

        def write(folder: str) -> dict:
            seen = Observation(COUNTED)
            split = batch.withColumns({"delay_seconds": delay, "late": is_late}).observe(
                seen,
                F.max(at).alias("latest"),
                F.count(F.lit(1)).alias("total"),
                F.count_if("late").alias("late"),
            )
            spark.conf.set(WRITERS, "2")
            split.write.partitionBy("late").parquet(folder)
            found = dict(seen.get)
            latest = found.pop("latest")
            marks = [mark, None if latest is None else latest - self.delay_seconds * SECOND]
            known = [m for m in marks if m is not None]
            files.write_text(spark, f"{folder}/{MARK}", json.dumps(max(known, default=None)))
            return {COUNTED: found}

        self.table.take(spark, number, write)

    def _mark(self, spark: SparkSession, number: int) -> int | None:
        """The watermark that a batch has left, in microseconds; the last batch's folder is there."""
        text = files.read_text(spark, f"{self.table.folder(number)}/{MARK}") if number >= 0 else None
        return None if text is None else json.loads(text)

    def stream(self, spark: SparkSession) -> DataFrame:
        """The accepted rows, as a stream of those not read yet."""
        return spark.readStream.schema(self.schema).parquet(self.table.pattern(ACCEPTED))

    def accepted(self, spark: SparkSession) -> DataFrame:
        return self.table.read(spark, ACCEPTED)

    def late(self, spark: SparkSession) -> DataFrame:
        """The late rows, and by how many seconds the watermark was ahead of each."""
        return self.table.read(spark, LATE)

    def counts(self, spark: SparkSession) -> dict[str, int]:
        """`total` and `late` rows of all batches."""
        return self.table.totals(spark).get(COUNTED, {"total": 0, "late": 0})
