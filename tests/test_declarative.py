"""The pipeline definitions, registered without a runner."""

from pyspark.pipelines.graph_element_registry import (
    GraphElementRegistry,
    graph_element_registration_context,
)

from rows import flag_texts, messages
from txnlake import schemas
from txnlake.plans import config, declarative
from txnlake.sources.kafka import FileSource, KafkaSink


class Registry(GraphElementRegistry):
    def __init__(self):
        self.outputs, self.flows = {}, {}

    def register_output(self, output):
        self.outputs[output.name] = output

    def register_flow(self, flow):
        self.flows[flow.target] = flow

    def register_sql(self, sql_text, file_path):
        raise AssertionError


def test_definitions(spark, tmp_path):
    landing = str(tmp_path / "landing")
    messages(spark, flag_texts()).write.parquet(landing)
    registry = Registry()
    with graph_element_registration_context(registry):
        declarative.declare(FileSource(landing), KafkaSink("broker:9092"))
    assert set(registry.outputs) == {*config.COMMENTS, config.ALERT_SINK}
    assert set(registry.flows) == set(registry.outputs)
    silver = registry.outputs[config.SILVER]
    assert silver.cluster_by == ["account_id", "transaction_date"]
    assert silver.table_properties == {"quality": "silver"}
    assert registry.outputs[config.ALERT_SINK].options["topic"] == "banking.fraud-alerts"
    bronze = registry.flows[config.BRONZE].func()
    assert bronze.isStreaming
    assert bronze.columns == schemas.names(schemas.BRONZE)


def test_flows_follow_the_tables_before_them(spark, tmp_path):
    registry = Registry()
    with graph_element_registration_context(registry):
        declarative.declare(FileSource("x"), KafkaSink("broker:9092"))
    spark.sql("CREATE SCHEMA IF NOT EXISTS txnlake_declared")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase("txnlake_declared")
    try:
        for name, ddl in ((config.BRONZE, schemas.BRONZE), (config.SILVER, schemas.SILVER)):
            (tmp_path / name).mkdir()
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet LOCATION '{tmp_path}/{name}'")
        expected = {
            config.SILVER: (schemas.SILVER, True),
            config.QUARANTINE: (schemas.QUARANTINE, True),
            config.GOLD: (schemas.GOLD, False),
            config.ALERTS: (schemas.ALERTS, True),
            config.ALERT_SINK: (schemas.ALERT_MESSAGES, True),
        }
        for name, (ddl, streaming) in expected.items():
            df = registry.flows[name].func()
            assert df.columns == schemas.names(ddl)
            assert df.isStreaming is streaming
    finally:
        spark.catalog.setCurrentDatabase(before)
