"""The price pipeline on the benchmark tables (rows derived from lineitem)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.operators import quality as Q
from medallion.operators.profiles import group_count, load_span, span
from medallion.plans import prices as P
from medallion.plans.jobs import silver_price_job
from medallion.session import work_path
from medallion.sources.delimited import FILE, LINE, landed, read_delimited, rejected, write_delimited
from medallion.sources.tables import read_table, within_dates
from medallion.sources.testdata import PRICE_COLUMNS, broken_lines, price_rows

# The lookup the Silver layer was built to answer.
LOOKUP_COMMODITY = 96
LOOKUP_PRICETYPE = "Retail"
LOOKUP_LIMIT = 5
WINDOW = (dt.date(1995, 11, 20), dt.date(1996, 2, 10))
# A vocabulary missing two units, so the gate has values to report.
PARTIAL_UNITS = [u for u in P.UNIT_MAP if u not in ("730 ML", "140 ML")]

COMPARED_SILVER = [c for c in P.SILVER_COLUMNS if c not in ("ingested_at", "processed_at")]


def landed_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the price rows as header CSVs in the shared work folder: some
    files with the columns in another order and one more, and files of broken
    rows or of a header that lacks a column."""
    path = work_path(spark, "prices-csv")

    def rows_of(lineitems: Column) -> DataFrame:
        return price_rows(spark, sf_dir, lineitems)

    even = F.col("l_suppkey") % 2 == 0
    write_delimited(rows_of(even), f"{path}/usual", compression="gzip")
    write_delimited(rows_of(~even).select(F.lit("x").alias("note"), *reversed(PRICE_COLUMNS)), f"{path}/reversed", compression="gzip")
    for name, (header, lines) in broken_lines(rows_of).items():
        write_delimited(lines.select(F.col(LINE).alias(header)), f"{path}/{name}", sep="\u0001", compression="gzip")
    return path


def bronze_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.as_bronze_text(price_rows(spark, sf_dir))


def bronze_prices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = read_delimited(spark, landed_csv(spark, sf_dir), PRICE_COLUMNS)
    return P.bronze_prices(raw).drop("ingested_at")


def landing_rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the landing could not bind, by the folder of its file."""
    lost = rejected(landed(spark, landed_csv(spark, sf_dir), PRICE_COLUMNS))
    return lost.withColumn(FILE, F.regexp_extract(FILE, "([^/]+)/[^/]+$", 1))


def bronze_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = P.bronze_prices(price_rows(spark, sf_dir))
    return bronze.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("price_date").isNull()).alias("unparseable_dates"),
        *span(bronze, "price_date", "date"),
    )


def load_span_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load times differ from run to run; that they are there and in order does not."""
    spans = load_span(P.bronze_prices(price_rows(spark, sf_dir)))
    return spans.select("source", "rows", (F.col("first_load") <= F.col("last_load")).alias("in_order"))


def published_silver_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the Silver job into a lake of its own, then read the table by name."""
    root = work_path(spark, "lake")
    silver_price_job(spark, bronze_text(spark, sf_dir), root)
    return read_table(spark, root, "silver.food_prices").select(*COMPARED_SILVER, "price_date_year")


def price_window_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of a span of dates per currency and type, from the published table."""
    root = work_path(spark, "lake")
    silver_price_job(spark, bronze_text(spark, sf_dir), root)
    rows = within_dates(read_table(spark, root, "silver.food_prices"), "price_date", *WINDOW)
    return rows.groupBy("price_date", "pricetype").agg(F.count(F.lit(1)).alias("rows"), F.max("price").alias("highest"))


def silver_prices_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.silver_prices(bronze_text(spark, sf_dir)).select(*COMPARED_SILVER)


def price_rejects_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.rejects(bronze_text(spark, sf_dir)).drop("ingested_at")


def dedup_audit_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.dedup_audit(bronze_text(spark, sf_dir))


def unmapped_units_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = Q.accepted(P.judged(bronze_text(spark, sf_dir)), P.TYPED_COLUMNS)
    return Q.unmapped_values(good, "unit", PARTIAL_UNITS)


def flag_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = P.silver_prices(bronze_text(spark, sf_dir))
    return group_count(silver, ["priceflag", "is_actual", "is_aggregate"], "rows")


def food_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = P.silver_prices(bronze_text(spark, sf_dir))
    return group_count(silver, ["is_food"], "rows")


def price_lookup_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = P.silver_prices(bronze_text(spark, sf_dir))
    return (
        silver.where((F.col("commodity_id") == LOOKUP_COMMODITY) & (F.col("pricetype") == LOOKUP_PRICETYPE))
        .orderBy(F.col("price_date").desc(), "market_id", "unit", "priceflag")
        .limit(LOOKUP_LIMIT)
        .select("price_date", "unit", "price", "price_per_base_unit")
    )
