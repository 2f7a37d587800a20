"""Stored layers and message landings over the test tables, built once per Spark application."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import schemas, session
from txnlake.operators import layout
from txnlake.operators.bronze import to_bronze
from txnlake.operators.gold import merchant_analytics
from txnlake.operators.silver import to_silver
from txnlake.sources import events

# A fixed ingestion time: compared results must not depend on the clock.
INGESTED_AT = "2024-02-01 00:00:00"

# Rows arrive in so many runs, each an equal part of the time range.
QUARTERS = 4

_built: dict[tuple[str, str, str], str] = {}


def ingested_at():
    return F.lit(INGESTED_AT).cast("timestamp")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kafka-shaped messages."""
    session.use_utc(spark)
    return events.messages(spark, sf_dir)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows, computed in place."""
    return to_bronze(raw(spark, sf_dir), ingested_at())


def _once(spark: SparkSession, sf_dir: str, kind: str, build) -> str:
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _built:
        path = session.scratch_dir(spark, kind)
        build(path)
        _built[key] = path
    return _built[key]


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path).select(*schemas.names(ddl))


def stored_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bronze table, written on first use."""

    def build(path):
        bronze(spark, sf_dir).write.partitionBy("ingestion_date").parquet(path)

    return _read(spark, _once(spark, sf_dir, "bronze", build), schemas.BRONZE)


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver table, written on first use from the bronze table.

    Messages come roughly in time order, so a task meets few dates and the write needs no shuffle.
    """

    def build(path):
        rows = to_silver(stored_bronze(spark, sf_dir))
        rows.write.partitionBy("transaction_date").parquet(path)

    session.use_utc(spark)
    return _read(spark, _once(spark, sf_dir, "silver", build), schemas.SILVER)


def stored_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric view, written on first use from the silver table."""

    def build(path):
        metrics = merchant_analytics(stored_silver(spark, sf_dir))
        layout.write_clustered(metrics, "gold_merchant_analytics", path)

    return _read(spark, _once(spark, sf_dir, "gold", build), schemas.GOLD)


def arrival_bounds(spark: SparkSession, sf_dir: str) -> list[datetime]:
    """The times that cut the events into quarters; none where no event has a time."""
    _, first, last = events.extent(spark, sf_dir)
    if first is None:
        return []
    return [first + q * ((last - first) // QUARTERS) for q in range(1, QUARTERS)]


def message_arrivals(spark: SparkSession, sf_dir: str, path: str) -> Iterator[int]:
    """Append the messages to `path` quarter by quarter; yields after each.

    Events without a time come with the last quarter.  There is always a last quarter, so `path`
    exists in the end even where there are no events.
    """
    session.use_utc(spark)
    cuts = [None, *arrival_bounds(spark, sf_dir), None]
    for number, (since, until) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        rows = events.messages(spark, sf_dir, since, until, untimed=until is None)
        rows.write.mode("append").parquet(path)
        yield number


def landed_messages(spark: SparkSession, sf_dir: str) -> str:
    """A folder with all messages, landed range by range, written on first use."""

    def build(path):
        for _ in message_arrivals(spark, sf_dir, path):
            pass

    return _once(spark, sf_dir, "landing", build)


def silver_arrivals(
    spark: SparkSession,
    sf_dir: str,
    path: str,
    delayed: str = "false",
    overlap_seconds: int = 0,
) -> Iterator[int]:
    """Append silver rows to `path` quarter by quarter, in time order; yields after each.

    Rows of the first quarter that satisfy `delayed` arrive with the last one, and so do rows
    without a time.  With an overlap, every second row of the seconds before a cut arrives after it.
    The date folders that a quarter does not touch are not read.
    """
    # Event times are cut to milliseconds, so a quarter starts at its first millisecond.
    cuts = [
        cut.replace(microsecond=cut.microsecond // 1000 * 1000)
        for cut in arrival_bounds(spark, sf_dir)
    ]
    at, day = F.col("event_timestamp"), F.col("transaction_date")
    rows = stored_silver(spark, sf_dir)
    is_late = F.lit(False)
    if cuts:
        is_late = (at < _time(cuts[0])) & F.coalesce(F.expr(delayed), F.lit(False))
    held_back = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
    overlap = timedelta(seconds=overlap_seconds)

    def after(cut):
        """Rows that arrive after a cut."""
        moved = held_back & (at >= _time(cut - overlap))
        return (at >= _time(cut)) | moved if overlap_seconds else at >= _time(cut)

    edges = [None, *cuts, None]
    for number, (since, until) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        chosen, days = F.lit(True), F.lit(True)
        if since is not None:
            chosen, days = chosen & after(since), days & (day >= (since - overlap).date())
        if until is not None:
            chosen, days = chosen & ~after(until), days & (day <= until.date())
            part = rows.filter(days & chosen & ~is_late)
        else:
            part = rows.filter(days & chosen)
            if cuts:
                early = rows.filter((day <= cuts[0].date()) & is_late)
                part = part.filter(~is_late).unionByName(early)
                part = part.unionByName(rows.filter(at.isNull()))
        part.write.mode("append").parquet(path)
        yield number


def _time(moment: datetime):
    return F.lit(moment).cast("timestamp_ntz").cast("timestamp")
