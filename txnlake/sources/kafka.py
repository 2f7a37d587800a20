"""Message sources and sinks: Kafka, and file streams of the same shape."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake import schemas


@dataclass(frozen=True)
class KafkaSource:
    """Options of one topic scan."""

    servers: str
    # Topic name and reader limits.
    topic: str = "banking.transactions"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int = 10000
    session_timeout_ms: int = 30000
    request_timeout_ms: int = 40000
    fail_on_data_loss: bool = False
    # Splits a topic's offset ranges over more tasks than it has partitions.
    min_partitions: int | None = None
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        chosen = {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
            "maxOffsetsPerTrigger": str(self.max_offsets_per_trigger),
            "kafka.session.timeout.ms": str(self.session_timeout_ms),
            "kafka.request.timeout.ms": str(self.request_timeout_ms),
            "failOnDataLoss": str(self.fail_on_data_loss).lower(),
        }
        if self.min_partitions is not None:
            chosen["minPartitions"] = str(self.min_partitions)
        return {**chosen, **self.extra}

    def load(self, spark: SparkSession) -> DataFrame:
        return spark.readStream.format("kafka").options(**self.options()).load()


@dataclass(frozen=True)
class FileSource:
    """A folder of Parquet files with Kafka's columns, read as a stream."""

    path: str
    max_files_per_trigger: int | None = None

    def options(self) -> dict[str, str]:
        chosen = {"ignoreMissingFiles": "true"}
        if self.max_files_per_trigger is not None:
            chosen["maxFilesPerTrigger"] = str(self.max_files_per_trigger)
        return chosen

    def load(self, spark: SparkSession) -> DataFrame:
        reader = spark.readStream.schema(schemas.KAFKA).options(**self.options())
        return reader.parquet(self.path)


BATCH_HEADER = "batch"


@dataclass(frozen=True)
class KafkaSink:
    """An outbound topic.  Delivery is at least once; the header `batch` has the micro-batch.

    Where a batch is sent again its messages come twice with the same number; `once` drops them.
    """

    servers: str
    # Fixed value: topic name.
    topic: str = "banking.fraud-alerts"
    extra: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "topic": self.topic,
            **self.extra,
        }

    def send(self, messages: DataFrame, number: int) -> None:
        header = F.struct(
            F.lit(BATCH_HEADER).alias("key"), F.lit(str(number)).cast("binary").alias("value")
        )
        sent = messages.withColumn("headers", F.array(header))
        sent.write.format("kafka").options(**self.options()).save()


@dataclass(frozen=True)
class JsonFileSink:
    """JSON lines of `key` and `value`, for runs without a broker: a folder for each micro-batch."""

    path: str

    def send(self, messages: DataFrame, number: int) -> None:
        # A batch that is sent again replaces its own messages.
        messages.write.mode("overwrite").json(f"{self.path}/{BATCH_HEADER}={number:012d}")

    def read(self, spark: SparkSession) -> DataFrame:
        rows = spark.read.schema(schemas.ALERT_MESSAGES).json(self.path)
        return rows.select(*schemas.names(schemas.ALERT_MESSAGES))


def once(messages: DataFrame, time: str = "timestamp", within: str = "1 hour") -> DataFrame:
    """A stream of alert messages, each alert once: repeats come within that time of event time.

    `messages` has `value`, the JSON of the alert, and a timestamp column.
    """
    key = F.get_json_object(F.col("value").cast("string"), "$.transaction_id")
    marked = messages.withColumn("_alert", key).withWatermark(time, within)
    return marked.dropDuplicatesWithinWatermark(["_alert"]).drop("_alert")
