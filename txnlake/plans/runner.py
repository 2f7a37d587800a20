"""One run of the whole pipeline: prepare, layers in order, gold refresh, checks."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from txnlake import files, schemas, session
from txnlake.operators import gold, layout, validate
from txnlake.plans import config
from txnlake.plans.config import LakeConfig
from txnlake.streaming import layers
from txnlake.streaming.batches import since

# Names the generation that a full refresh has made the valid one.
GENERATION = "current_generation"
# The layers with rules, and the tables that have their counters.
COUNTED = {"bronze": config.BRONZE, "silver": config.SILVER, "gold": config.ALERTS}


@dataclass
class RunResult:
    """What a run left behind."""

    config: LakeConfig
    checks: DataFrame
    violations: dict[str, dict[str, int]]
    summary: dict


def finish(*queries: StreamingQuery) -> list[StreamingQuery]:
    """Wait for queries that end by themselves; raises what made one fail."""
    for query in queries:
        query.awaitTermination()
    return list(queries)


def cluster(spark: SparkSession, cfg: LakeConfig, name: str) -> str:
    """Write a stored layer once more in clustered order, for readers that select by its columns."""
    path = f"{cfg.root}/{cfg.generation}/clustered/{name}/version={uuid.uuid4().hex}"
    layout.write_clustered(layers.read_table(spark, cfg, name), name, path)
    return path


def register(spark: SparkSession, cfg: LakeConfig, name: str) -> None:
    """Point the catalog's view of a table at the folders that are live now.

    The view is replaced in one step, so readers always find it; before the first row it is empty.
    The metric view merges the partial sums as it is read.
    """
    is_gold = name == config.GOLD
    ddl = schemas.GOLD if is_gold else layers.SCHEMAS[name]
    table = cfg.batches(config.SILVER if is_gold else name)
    folders = table.folders(spark, "partials" if is_gold else config.PART_OF[name])
    if folders:
        inside = ",".join(folder.removeprefix(table.path + "/") for folder in folders)
        relation = f"parquet.`{table.path}/{{{inside}}}`"
        columns = ", ".join(schemas.names(ddl))
        text = gold.merged_sql(relation) if is_gold else f"SELECT {columns} FROM {relation}"
    else:
        fields = spark.createDataFrame([], ddl).schema.fields
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in fields)
        text = f"SELECT {empty} WHERE false"
    spark.sql(
        f"CREATE OR REPLACE VIEW {cfg.database}.{name} COMMENT '{config.COMMENTS[name]}' "
        f"TBLPROPERTIES ('quality' = '{config.QUALITY[name]}') AS {text}"
    )


def current(spark: SparkSession, cfg: LakeConfig) -> LakeConfig:
    """The configuration with the generation that the last full refresh has left."""
    generation = files.read_text(spark, f"{cfg.root}/{GENERATION}")
    return replace(cfg, generation=generation) if generation else cfg


def run_once(spark: SparkSession, cfg: LakeConfig, full_refresh: bool = False) -> RunResult:
    """Take in what has arrived since the last run, through all layers, and check the result.

    `full_refresh` reads everything again into a new generation of tables and checkpoints.  The
    catalog and later runs move there once all its tables are whole; readers never see empty ones.
    Raises `ValidationError` when a check does not pass; its `result` is what the run left.
    """
    if cfg.continuous:
        raise ValueError("run_once takes what is there; use start_all for a continuous run")
    session.use_utc(spark)
    cfg = current(spark, cfg)
    if full_refresh:
        cfg = replace(cfg, generation=f"g{uuid.uuid4().hex[:12]}")
    validate.ensure_namespace(spark, cfg.database)
    for name in config.COMMENTS:
        if not spark.catalog.tableExists(f"{cfg.database}.{name}"):
            register(spark, cfg, name)

    before = counted(spark, cfg)
    finish(layers.start_bronze(spark, cfg))
    finish(layers.start_silver(spark, cfg))
    finish(layers.start_alerts(spark, cfg), layers.start_alert_sink(spark, cfg))
    for name in config.COMMENTS:
        register(spark, cfg, name)
    if full_refresh:
        files.write_text(spark, f"{cfg.root}/{GENERATION}", cfg.generation)

    tables = {name: layers.read_table(spark, cfg, name) for name in config.PART_OF}
    tables[config.GOLD] = layers.read_gold(spark, cfg)
    summary = validate.run_summary(
        tables[config.BRONZE],
        tables[config.SILVER],
        tables[config.QUARANTINE],
        tables[config.GOLD],
        tables[config.ALERTS],
    ).first()
    checked = validate.checks_of(summary, cfg.max_fraud_pct)
    now = counted(spark, cfg)
    result = RunResult(
        cfg,
        spark.createDataFrame(checked, validate.CHECK_SCHEMA),
        {layer: since(now[layer], before[layer]).get(f"dq_{layer}", {}) for layer in COUNTED},
        summary.asDict(),
    )
    validate.enforce(checked, result)
    return result


def counted(spark: SparkSession, cfg: LakeConfig) -> dict[str, dict]:
    """Counters of the rules of each layer over all batches that its table has."""
    return {layer: cfg.batches(name).totals(spark) for layer, name in COUNTED.items()}


def start_all(spark: SparkSession, cfg: LakeConfig) -> list[StreamingQuery]:
    """Start every layer as a continuous query; each follows the table before it.

    Counters and partial sums come with every batch: `counted` and `layers.read_gold` show them at
    any time, `register` moves the catalog's views on.
    """
    if not cfg.continuous:
        raise ValueError("set `continuous` to the interval between micro-batches")
    session.use_utc(spark)
    cfg = current(spark, cfg)
    starts = (
        layers.start_bronze,
        layers.start_silver,
        layers.start_alerts,
        layers.start_alert_sink,
    )
    return [start(spark, cfg) for start in starts]
