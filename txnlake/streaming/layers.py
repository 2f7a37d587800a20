"""The layers as Structured Streaming queries: one query and one checkpoint for each pass.

A pass writes all that it makes of a micro-batch into one folder (see `batches`): bronze its rows;
silver the rows it keeps, those it does not, and partial sums of the metric view; alerts their rows.
The rule counters of the batch lie beside.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlake import files, schemas
from txnlake.operators import gold, layout, quality, silver
from txnlake.operators.bronze import to_bronze
from txnlake.plans import config
from txnlake.plans.config import LakeConfig
from txnlake.streaming.batches import number_of

SCHEMAS = {
    config.BRONZE: schemas.BRONZE,
    config.SILVER: schemas.SILVER,
    config.QUARANTINE: schemas.QUARANTINE,
    config.ALERTS: schemas.ALERTS,
    config.ALERT_SINK: schemas.ALERT_MESSAGES,
}

FILE = "_file"
# Two folders at a time: without this every task would sort its rows by folder.
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def read_table(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A stored layer, as it stands."""
    rows = cfg.batches(name).read(spark, config.PART_OF[name])
    return rows.select(*schemas.names(SCHEMAS[name]))


def read_gold(spark: SparkSession, cfg: LakeConfig) -> DataFrame:
    """The metric view: partial sums of all silver batches, merged."""
    return gold.merged(cfg.batches(config.SILVER).read(spark, "partials"))


def stream_table(spark: SparkSession, cfg: LakeConfig, name: str) -> DataFrame:
    """A stored layer as a stream of the rows not read yet, with the file each comes from."""
    reader = spark.readStream.schema(SCHEMAS[name])
    if cfg.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    rows = reader.parquet(cfg.batches(name).pattern(config.PART_OF[name]))
    return rows.select(*schemas.names(SCHEMAS[name]), F.col("_metadata.file_path").alias(FILE))


def _start(rows: DataFrame, cfg: LakeConfig, name: str, take: Callable) -> StreamingQuery:
    writer = rows.writeStream.queryName(name).foreachBatch(take).trigger(**cfg.trigger())
    return writer.option("checkpointLocation", cfg.checkpoint(name)).start()


def _ordered(name: str) -> Callable[[DataFrame, str], DataFrame]:
    """The clustered order of a layer, for the part that has its rows."""

    def order(rows: DataFrame, part: str) -> DataFrame:
        if part == "partials":
            return gold.added(rows).coalesce(1)  # as many rows as the view has
        if part == config.PART_OF[name]:
            return layout.clustered(rows, name)
        return rows

    return order


def _note_progress(batch: DataFrame, cfg: LakeConfig, name: str) -> None:
    """Keep the last batch read of the table before; it may have been read in part only."""
    last = batch.agg(F.max(FILE)).first()[0]
    if last is not None:
        files.write_text(batch.sparkSession, cfg.progress(name), str(number_of(last)))


def start_bronze(spark: SparkSession, cfg: LakeConfig) -> StreamingQuery:
    table = cfg.batches(config.BRONZE)

    def take(batch: DataFrame, number: int) -> None:
        def write(folder: str) -> dict:
            seen = Observation("dq_bronze")
            rows = batch.observe(seen, *quality.counters(quality.BRONZE_RULES))
            rows.write.options(**cfg.table_options).parquet(f"{folder}/rows")
            return {"dq_bronze": dict(seen.get)}

        table.take(batch.sparkSession, number, write, _ordered(config.BRONZE))

    rows = to_bronze(cfg.source.load(spark), cfg.ingested_at)
    return _start(rows, cfg, config.BRONZE, take)


def start_silver(spark: SparkSession, cfg: LakeConfig) -> StreamingQuery:
    """Silver, quarantine and the partial sums of gold, from one parse of each message."""
    table = cfg.batches(config.SILVER)

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession

        def write(folder: str) -> dict:
            seen = Observation("dq_silver")
            rows = silver.split(batch, cfg.corrupt_policy, cfg.rules)
            rows = rows.observe(seen, *quality.counters(quality.SILVER_RULES))
            session.conf.set(WRITERS, "2")
            rows.write.options(**cfg.table_options).partitionBy(silver.KEPT).parquet(folder)
            if files.exists(session, f"{folder}/kept=true"):
                kept = session.read.schema(schemas.SILVER).parquet(f"{folder}/kept=true")
                gold.partials(kept).coalesce(1).write.parquet(f"{folder}/partials")
            return {"dq_silver": dict(seen.get)}

        table.take(session, number, write, _ordered(config.SILVER))
        _note_progress(batch, cfg, config.SILVER)

    return _start(stream_table(spark, cfg, config.BRONZE), cfg, config.SILVER, take)


def start_alerts(spark: SparkSession, cfg: LakeConfig) -> StreamingQuery:
    table = cfg.batches(config.ALERTS)

    def take(batch: DataFrame, number: int) -> None:
        def write(folder: str) -> dict:
            seen = Observation("dq_gold")
            rows = gold.fraud_alerts(batch)
            rows = rows.observe(seen, *quality.counters(quality.GOLD_RULES))
            rows.write.options(**cfg.table_options).parquet(f"{folder}/rows")
            return {"dq_gold": dict(seen.get)}

        table.take(batch.sparkSession, number, write, _ordered(config.ALERTS))
        _note_progress(batch, cfg, config.ALERTS)

    return _start(stream_table(spark, cfg, config.SILVER), cfg, config.ALERTS, take)


def start_alert_sink(spark: SparkSession, cfg: LakeConfig) -> StreamingQuery:
    sink = cfg.sink()

    def take(batch: DataFrame, number: int) -> None:
        sink.send(gold.alert_messages(batch), number)
        _note_progress(batch, cfg, config.ALERT_SINK)

    return _start(stream_table(spark, cfg, config.SILVER), cfg, config.ALERT_SINK, take)
