"""Where a pipeline reads, writes and keeps its progress."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column

from txnlake import schemas
from txnlake.functions.rules import Rule
from txnlake.operators.gold import PARTIALS
from txnlake.operators.validate import MAX_FRAUD_PCT
from txnlake.sources.kafka import FileSource, JsonFileSink, KafkaSink, KafkaSource
from txnlake.streaming.batches import BatchTable

BRONZE = "bronze_transactions"
SILVER = "silver_transactions"
QUARANTINE = "silver_quarantine"
GOLD = "gold_merchant_analytics"
ALERTS = "gold_fraud_alerts"
ALERT_SINK = "fraud_alerts_sink"

# Comment and quality tag of each table.
COMMENTS = {
    BRONZE: "Payment messages as received, with their topic position.",
    SILVER: "Typed payment transactions with fraud flags.",
    QUARANTINE: "Messages that could not be read.",
    GOLD: "Hourly volume and fraud metrics by category and country.",
    ALERTS: "Transactions flagged as fraud.",
}
# Parts of each streamed table, and which part a layer is.
PARTS = {
    BRONZE: {"rows": schemas.BRONZE},
    SILVER: {
        "kept=true": schemas.SILVER,
        "kept=false": schemas.QUARANTINE,
        "partials": PARTIALS,
    },
    ALERTS: {"rows": schemas.ALERTS},
}
PART_OF = {BRONZE: "rows", SILVER: "kept=true", QUARANTINE: "kept=false", ALERTS: "rows"}
# Streams that read a table; what they have not read yet is kept.
FOLLOWERS = {BRONZE: (SILVER,), SILVER: (ALERTS, ALERT_SINK), ALERTS: ()}
QUALITY = {BRONZE: "bronze", SILVER: "silver", QUARANTINE: "silver", GOLD: "gold", ALERTS: "gold"}


@dataclass(frozen=True)
class LakeConfig:
    """One pipeline.

    `root` is a folder that every node can reach; tables, checkpoints and (without `alert_sink`)
    alert messages lie below it.  `continuous` runs micro-batches at that interval until stopped;
    without it a run takes what is there and ends.  `full_refresh` starts a new generation of all
    tables and checkpoints.
    """

    root: str
    source: KafkaSource | FileSource
    database: str = "txnlake"
    alert_sink: KafkaSink | JsonFileSink | None = None
    corrupt_policy: str = "drop"
    rules: list[Rule] | None = None
    max_fraud_pct: float = MAX_FRAUD_PCT
    continuous: str | None = None
    max_files_per_trigger: int | None = None
    ingested_at: Column | None = None
    generation: str = "g0"
    table_options: dict[str, str] = field(default_factory=dict)  # of the Parquet writer

    def table(self, name: str) -> str:
        return f"{self.root}/{self.generation}/tables/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/{self.generation}/checkpoints/{name}"

    def progress(self, name: str) -> str:
        """The file in which a stream keeps which batches of the table before it has read."""
        return f"{self.root}/{self.generation}/progress/{name}"

    def batches(self, name: str) -> BatchTable:
        """A streamed table; quarantine lies beside silver, as one pass over bronze makes both."""
        if name == QUARANTINE:
            name = SILVER
        follow = tuple(self.progress(follower) for follower in FOLLOWERS[name])
        return BatchTable(self.table(name), PARTS[name], follow)

    def sink(self) -> KafkaSink | JsonFileSink:
        return self.alert_sink or JsonFileSink(self.table(ALERT_SINK))

    def trigger(self) -> dict:
        if self.continuous:
            return {"processingTime": self.continuous}
        return {"availableNow": True}
