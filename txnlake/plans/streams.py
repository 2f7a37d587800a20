"""Streaming queries over the test tables, run to the end of their input."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import files, schemas, session
from txnlake.functions.rules import COUNTRY_CURRENCY
from txnlake.operators import detect, quality
from txnlake.plans import config, lake
from txnlake.plans.config import LakeConfig
from txnlake.plans.runner import counted, finish
from txnlake.sources.kafka import FileSource
from txnlake.streaming import counters, hops, late, layers, windows
from txnlake.streaming.counters import Place

BATCHES = 8  # micro-batches that a landing is read in, about


def pipeline_config(spark: SparkSession, landing: str, label: str) -> LakeConfig:
    """A pipeline of its own below the scratch folder, reading messages from `landing`."""
    per_batch = max(1, -(-len(files.children(spark, landing)) // BATCHES))
    return LakeConfig(
        root=session.scratch_dir(spark, label),
        source=FileSource(landing, max_files_per_trigger=per_batch),
        max_files_per_trigger=per_batch * 8,
        ingested_at=lake.ingested_at(),
    )


def _run(spark: SparkSession, sf_dir: str, label: str, *starts) -> tuple[LakeConfig, list]:
    """Run layers one after the other over all messages."""
    session.use_utc(spark)
    cfg = pipeline_config(spark, lake.landed_messages(spark, sf_dir), label)
    return cfg, [finish(start(spark, cfg))[0] for start in starts]


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run(spark, sf_dir, "stream_bronze", layers.start_bronze)
    return layers.read_table(spark, cfg, config.BRONZE)


def stream_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run(spark, sf_dir, "stream_silver", layers.start_bronze, layers.start_silver)
    return layers.read_table(spark, cfg, config.SILVER)


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run(spark, sf_dir, "stream_quarantine", layers.start_bronze, layers.start_silver)
    return layers.read_table(spark, cfg, config.QUARANTINE)


def stream_fraud_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run(
        spark,
        sf_dir,
        "stream_fraud_alerts",
        layers.start_bronze,
        layers.start_silver,
        layers.start_alerts,
    )
    return layers.read_table(spark, cfg, config.ALERTS)


def stream_alert_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    cfg, _ = _run(
        spark,
        sf_dir,
        "stream_alert_sink",
        layers.start_bronze,
        layers.start_silver,
        layers.start_alert_sink,
    )
    return cfg.sink().read(spark)


def stream_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of the bronze and silver batches of one continuous stretch."""
    session.use_utc(spark)
    cfg = pipeline_config(spark, lake.landed_messages(spark, sf_dir), "stream_dq")
    cfg = replace(cfg, continuous="0 seconds")
    for start in (layers.start_bronze, layers.start_silver):
        query = start(spark, cfg)
        try:
            query.processAllAvailable()
        finally:
            query.stop()
    sums, rows = counted(spark, cfg), []
    for layer, rules in (("bronze", quality.BRONZE_RULES), ("silver", quality.SILVER_RULES)):
        own = sums[layer][f"dq_{layer}"]
        rows += [(layer, r.name, r.action, own["total"], own[r.name]) for r in rules]
    columns = "layer STRING, rule STRING, action STRING, total BIGINT, violations BIGINT"
    return spark.createDataFrame(rows, columns)


def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver from runs that stop and resume on their checkpoints as messages arrive."""
    session.use_utc(spark)
    landing = session.scratch_dir(spark, "restart_landing")
    cfg = pipeline_config(spark, landing, "stream_restart")
    for _ in lake.message_arrivals(spark, sf_dir, landing):
        finish(layers.start_bronze(spark, cfg))
        finish(layers.start_silver(spark, cfg))
    return layers.read_table(spark, cfg, config.SILVER)


def stream_gold_merchant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metric view, merged from the partial sums that the silver stream has left."""
    cfg, _ = _run(spark, sf_dir, "stream_gold", layers.start_bronze, layers.start_silver)
    return layers.read_gold(spark, cfg)


def _state_partitions(spark: SparkSession):
    """State is split once, when a query first starts: one part per core of the cluster."""
    cores = spark.sparkContext.defaultParallelism
    return session.settings(spark, {"spark.sql.shuffle.partitions": str(cores)})


def _stateful(
    spark: SparkSession,
    sf_dir: str,
    label: str,
    transform: Callable[[DataFrame], DataFrame],
    delayed: str = "false",
) -> tuple[DataFrame, Place]:
    """Run a query after each arrival of silver rows, on one checkpoint, and record its counters."""
    session.use_utc(spark)
    root = session.scratch_dir(spark, label)
    place = Place(f"{root}/checkpoint", f"{root}/counters")
    with _state_partitions(spark), counters.recorded(spark, {label: place}):
        for _ in lake.silver_arrivals(spark, sf_dir, f"{root}/silver", delayed):
            rows = spark.readStream.schema(schemas.SILVER).parquet(f"{root}/silver")
            result = transform(rows)
            query = (
                result.writeStream.format("parquet")
                .queryName(label)
                .option("path", f"{root}/out")
                .option("checkpointLocation", place.checkpoint)
                .trigger(availableNow=True)
                .start()
            )
            finish(query)
    return spark.read.schema(result.schema).parquet(f"{root}/out"), place


def stream_geo_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hops after arrivals that overlap in time, within the watermark; waiting rows included."""
    session.use_utc(spark)
    root = session.scratch_dir(spark, "stream_geo_hop")
    stream = hops.HopStream(f"{root}/hops")
    overlap = hops.WATERMARK_SECONDS // 2
    for _ in lake.silver_arrivals(spark, sf_dir, f"{root}/silver", overlap_seconds=overlap):
        rows = spark.readStream.schema(schemas.SILVER).parquet(f"{root}/silver")
        finish(stream.start(rows))
    return stream.with_waiting(spark)


def stream_sliding_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    transform = windows.sliding_category_volume
    return _stateful(spark, sf_dir, "stream_sliding_volume", transform)[0]


def stream_velocity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stateful(spark, sf_dir, "stream_velocity", windows.account_velocity)[0]


# One country's feed of the first quarter comes in with the last arrival.
DELAYED_FEED = "country = 'JP'"


def late_data_run(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Hourly spend without the rows that came too late, and how many late partial sums went."""
    result, place = _stateful(
        spark, sf_dir, "stream_late_data", windows.hourly_spend, DELAYED_FEED
    )
    return result, counters.late_rows(spark, place)


def stream_currency_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The currency rule as a join of the silver stream with a stored table of currencies."""
    path = f"{session.scratch_dir(spark, 'currencies')}/table"
    known = spark.createDataFrame(
        list(COUNTRY_CURRENCY.items()), "country STRING, currency STRING"
    )
    known.write.parquet(path)

    def transform(rows):
        currencies = spark.read.schema(known.schema).parquet(path)
        return detect.currency_rule_join(rows, currencies)

    return _stateful(spark, sf_dir, "stream_currency_join", transform)[0]


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return late_data_run(spark, sf_dir)[0]


def late_gate_run(spark: SparkSession, sf_dir: str) -> late.LateGate:
    """Silver arrivals through a gate before hourly windows, one feed too late."""
    session.use_utc(spark)
    root = session.scratch_dir(spark, "stream_late_rows")
    gate = late.LateGate(f"{root}/gate")
    for _ in lake.silver_arrivals(spark, sf_dir, f"{root}/silver", DELAYED_FEED):
        rows = spark.readStream.schema(schemas.SILVER).parquet(f"{root}/silver")
        finish(gate.start(rows))
    return gate


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that came too late for its hour, and by how much."""
    rows = late_gate_run(spark, sf_dir).late(spark)
    return rows.select(
        "transaction_id",
        "account_id",
        "event_timestamp",
        F.round("delay_seconds", 3).alias("delay_seconds"),
    )
