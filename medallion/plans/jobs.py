"""The batch jobs with I/O (S1-S11 around the pure plans).

* :func:`bronze_price_job`: delimited file → typed Bronze table.
* :func:`silver_price_job`: Bronze prices → Silver prices + quarantine.
* :func:`vault_job`: both Bronze change logs → six vault tables.
* :func:`order_value_report`: the point-in-time question over the published vault.
* change streams: :mod:`medallion.streaming.cdc`.

Counters are gathered with ``observe`` during the writes, so no table is
scanned again just to be counted. Every table is published under its
declared schema, and tables of one job are committed together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from medallion.operators import quality as Q
from medallion.operators.profiles import log_counts, preview
from medallion.operators.segments import drop_staged
from medallion.plans import prices as P
from medallion.plans import vault as V
from medallion.plans.order_value import order_value_published
from medallion.session import remove, work_path
from medallion.sources.delimited import accepted, landed, rejected
from medallion.sources.tables import commit, read_table, with_year, write_version
from medallion.sources.testdata import PRICE_COLUMNS


def bronze_price_job(
    spark: SparkSession, csv_path: str, root: str, table: str = "bronze.food_prices", rejects_table: str = "bronze.food_prices_rejects",
) -> dict:
    """Land price files. Rows that their file's header can't bind are a table
    of their own, committed together with the prices."""
    rows = landed(spark, csv_path, PRICE_COLUMNS)
    bronze = P.bronze_prices(accepted(rows, PRICE_COLUMNS))
    obs = Observation("bronze_prices")
    bronze = bronze.observe(
        obs,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("price_date").isNull()).alias("unparseable_dates"),
        F.min("price_date").alias("first_date"),
        F.max("price_date").alias("last_date"),
        F.min("ingested_at").alias("first_load"),
        F.max("ingested_at").alias("last_load"),
    )
    out = write_version(bronze, table, root, schema=P.BRONZE_SCHEMA)
    lost = write_version(rejected(rows), rejects_table, root)
    commit(spark, root, [out, lost])
    return {**out, **obs.get, "rejects": lost, "preview": preview(read_table(spark, root, table))}


def silver_price_job(
    spark: SparkSession,
    bronze: DataFrame,
    root: str,
    table: str = "silver.food_prices",
    rejects_table: str = "silver.food_prices_rejects",
) -> dict:
    """Refine Bronze prices. Rows are judged once, into a staged table split
    by the verdict; Silver and the rejects are written from it and become
    visible together. One shuffle by ranges of the natural key, whose first
    column is the date, serves both the de-duplication and the files per year. Unknown units abort the job before that, all named."""
    seen = Observation("silver_in")
    rows = P.judged(bronze).withColumn("_good", Q.is_accepted()).observe(
        seen, F.count(F.lit(1)).alias("bronze_rows"), F.count_if(~F.col("_good")).alias("rows_quarantined")
    )
    path = work_path(spark, "judged-prices")
    Q.lean(rows, P.TYPED_COLUMNS).write.option("compression", "zstd").partitionBy("_good").parquet(path)
    staged = spark.read.schema(rows.schema).parquet(path)
    bad = staged.where(~F.col("_good")).drop("_good")
    only_unit = bad.where(F.col(Q.VERDICT) == Q.vocabulary_reason("unit"))
    Q.require_vocabulary(only_unit, "unit", list(P.UNIT_MAP))
    good = staged.where("_good").drop("_good")
    silver, year = with_year(P.refined(good, Q.dedup_in_ranges), "price_date")
    written = write_version(silver, table, root, schema=P.SILVER_SCHEMA, partition_by=[year], dealt=True)
    rejected = write_version(Q.quarantine(bad), rejects_table, root)
    commit(spark, root, [written, rejected])
    remove(spark, path)
    counters = {**seen.get, "silver_rows": written["rows"]}
    counters["duplicates_removed"] = counters["bronze_rows"] - counters["rows_quarantined"] - counters["silver_rows"]
    return {"silver": written, "rejects": rejected, **counters}


def vault_job(
    spark: SparkSession, products_bronze: DataFrame, orders_bronze: DataFrame, root: str, namespace: str = "silver",
) -> dict:
    """Replay both logs into the vault. Each log is decoded once and staged,
    hubs and links are taken from one pass over both; the six tables are
    written from that and become visible together. The events
    and transactions of both logs by op are published beside them as
    ``op_profile``."""
    staged = V.staged_changes(products_bronze, orders_bronze)
    firsts = V.staged_firsts(staged)
    tables = V.vault_tables(staged, firsts)
    written = {n: write_version(df, f"{namespace}.{n}", root, schema=V.SCHEMAS[n]) for n, df in tables.items()}
    counts = log_counts([products_bronze, orders_bronze])
    profile_schema = "source_table string, op string, events long, transactions long"
    written["op_profile"] = write_version(counts, f"{namespace}.op_profile", root, schema=profile_schema)
    commit(spark, root, list(written.values()))
    drop_staged(*staged.values(), firsts)
    return written


def order_value_report(spark: SparkSession, root: str, namespace: str = "silver") -> DataFrame:
    """Order values over the published vault tables."""
    names = ("sat_order", "hub_order", "link_order", "sat_product")
    return order_value_published({n: read_table(spark, root, f"{namespace}.{n}") for n in names})
