"""The shop pipeline on the benchmark tables: Bronze change logs derived
from ``events`` and the vault and order-value queries over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators import profiles as P
from medallion.operators.changes import change_rejects, utc_wall_clock
from medallion.operators.profiles import stacked
from medallion.plans import vault as V
from medallion.plans.jobs import order_value_report, vault_job
from medallion.plans.order_value import order_value_live, order_value_versions
from medallion.session import work_path
from medallion.sources.testdata import change_messages
from medallion.streaming.cdc import ChangeStreamSpec, land_changes, run_to_completion

# Money columns of the registered queries are presented as doubles: DuckDB
# hands DECIMAL columns to pandas as float64 while Spark returns Decimal
# objects, so a value-level comparison of the two engines would see 8.50 vs
# 8.5. The conversion of these two-decimal values is exact on both sides;
# the library itself keeps decimal(10,2).
MONEY = ("unit_price", "order_value_khr")


def money_as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in MONEY if c in df.columns})


def bronze_changes(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: land_changes(m, name) for name, m in change_messages(spark, sf_dir).items()}


def staged(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Decoded once and staged, as in the vault job."""
    b = bronze_changes(spark, sf_dir)
    return V.staged_changes(b["products"], b["orders"])


def vault_table(name: str):
    """A table of the vault from the logs that it reads. Only change detection
    needs a log staged in order; hubs and links take the events as they come."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bronze = bronze_changes(spark, sf_dir)
        if name in V.SATELLITES:
            log = V.SATELLITES[name].log
            return money_as_double(V.vault_table({log: V.staged_log(bronze[log], log)}, name))
        return V.vault_table({log: V.decoded(b, log) for log, b in bronze.items()}, name)
    return run


def order_value_versions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money_as_double(order_value_versions(staged(spark, sf_dir)))


def order_value_live_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return money_as_double(order_value_live(staged(spark, sf_dir)))


def published_vault_order_value_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the vault job into a lake of its own, then ask its published tables."""
    b = bronze_changes(spark, sf_dir)
    root = work_path(spark, "lake")
    vault_job(spark, b["products"], b["orders"], root)
    return money_as_double(order_value_report(spark, root))


def changes_query(source_table: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return money_as_double(V.decoded(bronze_changes(spark, sf_dir)[source_table], source_table))
    return run


def change_rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stacked([change_rejects(b, V.LOGS[n]) for n, b in bronze_changes(spark, sf_dir).items()])
    return rows.withColumn("payload", F.sha2("payload", 256))


def log_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.log_counts(list(bronze_changes(spark, sf_dir).values()))


def op_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.op_profile(list(bronze_changes(spark, sf_dir).values()))


def op_transactions_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.op_transactions(bronze_changes(spark, sf_dir)["products"])


def op_by_source_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bronze_changes(spark, sf_dir)
    return P.op_by_source([b["products"], b["orders"]])


def version_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.version_counts(vault_table("sat_product")(spark, sf_dir), "hk_product")


def vault_inventory_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = staged(spark, sf_dir)
    return P.inventory(V.vault_tables(logs, V.staged_firsts(logs)))


def bronze_change_stream_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land both change streams to completion, then read the Bronze logs back."""
    root = work_path(spark, "change-stream")
    specs = []
    for name, messages in change_messages(spark, sf_dir).items():
        source = f"{root}/messages/{name}"
        messages.write.parquet(source)
        specs.append(ChangeStreamSpec(
            source_table=name, topic=f"shop.public.{name}", target_path=f"{root}/bronze/{name}",
            checkpoint=f"{root}/checkpoints/{name}", source_path=source,
        ))
    run_to_completion(spark, specs, source_format="parquet")
    landed = stacked([spark.read.parquet(s.target_path) for s in specs])
    return landed.select(
        "kafka_key", "source_table", "op", "lsn", "tx_id", "source_ts_ms", "topic", "partition", "offset",
        utc_wall_clock(F.unix_micros("event_timestamp"), "MICROSECOND").alias("event_timestamp"),
        F.sha2("event", 256).alias("event"), F.sha2("payload", 256).alias("payload"),
    )
