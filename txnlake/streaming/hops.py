"""Geographic hops on a stream, by the batch operator on rows that the watermark has closed.

A row waits until the watermark has passed it: then all rows before it are there, and its hop is
decided once.  Each micro-batch reads the state that the one before left, a small table of waiting
rows and of the last closed row of each account that can still hop, and writes its hops and the next
state under its own number.  A batch that is repeated reads the same state and overwrites the same
folders.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake import files
from txnlake.operators import timeline
from txnlake.operators.detect import HOP_CARRIED, MAX_GAP_SECONDS, hop_report, is_hop

VISIT = ["account_id", *HOP_CARRIED]
VISIT_SCHEMA = (
    "account_id STRING, transaction_id STRING, event_timestamp TIMESTAMP, country STRING, "
    "latitude DOUBLE, longitude DOUBLE"
)
HOP_SCHEMA = (
    "account_id STRING, transaction_id STRING, event_timestamp TIMESTAMP, country STRING, "
    "previous_transaction_id STRING, previous_timestamp TIMESTAMP, previous_country STRING, "
    "gap_seconds DOUBLE, distance_km DOUBLE, speed_kmh DOUBLE"
)
# `closed` rows are behind the watermark, which lies in a small file beside the rows.
STATE_SCHEMA = f"{VISIT_SCHEMA}, closed BOOLEAN"
LATE_SCHEMA = f"{VISIT_SCHEMA}, delay_seconds DOUBLE"
MARK = "_watermark"
WATERMARK_SECONDS = 600


@dataclass(frozen=True)
class HopStream:
    """Folders and limits of one stream of hops."""

    root: str
    max_gap_seconds: int = MAX_GAP_SECONDS
    watermark_seconds: int = WATERMARK_SECONDS

    def _state(self, number: int) -> str:
        return f"{self.root}/state/version={number}"

    def start(self, silver: DataFrame) -> StreamingQuery:
        """Take in the rows of a silver stream that are there."""
        rows = silver.select(*VISIT)
        return (
            rows.writeStream.foreachBatch(self.take)
            .option("checkpointLocation", f"{self.root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )

    def take(self, batch: DataFrame, number: int) -> None:
        """One micro-batch: hops of the rows it closes, and the state for the next one."""
        spark = batch.sparkSession
        before, mark = self._read_state(spark, number - 1)
        at = F.unix_micros("event_timestamp")
        placed = batch.filter("account_id IS NOT NULL AND event_timestamp IS NOT NULL")
        delay = F.lit(None).cast("double") if mark is None else (F.lit(mark) - at) / timeline.SECOND
        # Several steps read the rows of the batch: without this each would go back to the source.
        placed = placed.select(*VISIT, delay.alias("delay_seconds")).persist()
        late = placed.filter("delay_seconds > 0")
        fresh = placed.filter("delay_seconds IS NULL OR delay_seconds <= 0")
        fresh = fresh.select(*VISIT, F.lit(False).alias("closed"))
        try:
            latest, n_late = placed.agg(F.max(at), F.count_if(F.col("delay_seconds") > 0)).first()
            if latest is not None:
                closing = latest - self.watermark_seconds * timeline.SECOND
                mark = closing if mark is None else max(mark, closing)
            rows = before.unionByName(fresh)
            is_ready = F.lit(False)
            if mark is not None:
                is_ready = F.unix_micros("event_timestamp") < mark
            ready = rows.filter(is_ready)
            hops = self._hops(ready)
            state = rows.filter(~is_ready).unionByName(self._last(ready, mark or 0))
            outputs = [
                (hops, f"{self.root}/hops/batch={number}"),
                (state, self._state(number)),
            ]
            if n_late:
                outputs.append((late, f"{self.root}/late/batch={number}"))
            # None needs another, and each is mostly waiting for small stages.
            with ThreadPoolExecutor(len(outputs)) as pool:
                writes = [
                    pool.submit(df.write.mode("overwrite").parquet, path) for df, path in outputs
                ]
                for write in writes:
                    write.result()
        finally:
            placed.unpersist()
        # The state is whole once it has its watermark.
        files.write_text(spark, f"{self._state(number)}/{MARK}", json.dumps(mark))
        files.delete(spark, self._state(number - 2))

    def result(self, spark: SparkSession) -> DataFrame:
        """The hops decided so far."""
        folders = files.children(spark, f"{self.root}/hops")
        if not folders:
            return spark.createDataFrame([], HOP_SCHEMA)
        return spark.read.schema(HOP_SCHEMA).parquet(*folders)

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came behind the watermark and are in no hop, with their delay."""
        folders = files.children(spark, f"{self.root}/late")
        if not folders:
            return spark.createDataFrame([], LATE_SCHEMA)
        return spark.read.schema(LATE_SCHEMA).parquet(*folders)

    def with_waiting(self, spark: SparkSession) -> DataFrame:
        """The hops decided so far, and those of waiting rows as if no other row could come."""
        versions = files.children(spark, f"{self.root}/state")
        # A version without its watermark is still being written.
        whole = [path for path in versions if files.exists(spark, f"{path}/{MARK}")]
        numbers = [int(path.rsplit("=", 1)[1]) for path in whole]
        if not numbers:
            return self.result(spark)
        state, _ = self._read_state(spark, max(numbers))
        return self.result(spark).unionByName(self._hops(state))

    def _read_state(self, spark: SparkSession, number: int) -> tuple[DataFrame, int | None]:
        """The rows that a batch has left and its watermark in microseconds."""
        mark = files.read_text(spark, f"{self._state(number)}/{MARK}") if number >= 0 else None
        if mark is None:
            return spark.createDataFrame([], STATE_SCHEMA), None
        rows = spark.read.schema(STATE_SCHEMA).parquet(self._state(number))
        return rows.select(*VISIT, "closed"), json.loads(mark)

    def _hops(self, rows: DataFrame) -> DataFrame:
        """Hops of rows that are not closed yet; closed ones are there to be looked back at."""
        ordered = timeline.with_previous(
            rows,
            "account_id",
            "event_timestamp",
            "transaction_id",
            HOP_CARRIED,
            self.max_gap_seconds,
        )
        return hop_report(ordered.filter(~F.col("closed")).filter(is_hop(self.max_gap_seconds)))

    def _last(self, ready: DataFrame, mark: int) -> DataFrame:
        """Each account's last closed row, unless it lies too far back for a hop."""
        values = F.struct(*VISIT)
        last = F.max_by(values, F.struct("event_timestamp", "transaction_id")).alias("v")
        kept = ready.groupBy("account_id").agg(last).select("v.*", F.lit(True).alias("closed"))
        reach = mark - self.max_gap_seconds * timeline.SECOND
        return kept.filter(F.unix_micros("event_timestamp") >= reach)
