import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.sources import tables as TB

SCHEMA = T.StructType([
    T.StructField("price_date", T.DateType()),
    T.StructField("market", T.StringType()),
    T.StructField("price", T.DoubleType()),
])


def test_publish_swap_and_history(spark, tmp_root):
    rows = [(dt.date(2003, 1, 15), "Battambang", 500.0)]
    df = TB.declared_rows(spark, rows, SCHEMA)
    first = TB.publish(df, "bronze_t.food_prices", tmp_root, schema=SCHEMA)
    assert first["rows"] == 1
    assert spark.table("bronze_t.food_prices").count() == 1
    # a rebuild may read the table it replaces
    again = spark.table("bronze_t.food_prices").unionByName(df.withColumn("price", F.lit(600.0)))
    second = TB.publish(again, "bronze_t.food_prices", tmp_root, schema=SCHEMA)
    assert second["rows"] == 2 and spark.table("bronze_t.food_prices").count() == 2
    assert TB.read_table(spark, tmp_root, "bronze_t.food_prices").count() == 2
    hist = TB.load_history(spark, tmp_root, "bronze_t.food_prices").collect()
    assert [h["version"] for h in hist] == [second["version"], first["version"]]
    assert [h["rows"] for h in hist] == [2, 1]


def test_commit_time_is_the_true_time_in_any_zone(spark, tmp_root):
    import time

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        TB.publish(TB.declared_rows(spark, [(dt.date(2003, 1, 15), "m", 1.0)], SCHEMA), "zone_t.prices", tmp_root)
        stamp = TB.load_history(spark, tmp_root).select(F.unix_seconds("committed_at")).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs(stamp - time.time()) < 120


def test_unpublished_and_uncommitted_tables_cannot_be_read(spark, tmp_root):
    with pytest.raises(TB.NoSuchTableError):
        TB.read_table(spark, tmp_root, "bronze_t.never")
    df = TB.declared_rows(spark, [(dt.date(2003, 1, 15), "m", 1.0)], SCHEMA)
    written = [TB.write_version(df, f"pair_t.{n}", tmp_root, schema=SCHEMA) for n in ("a", "b")]
    with pytest.raises(TB.NoSuchTableError):
        TB.read_table(spark, tmp_root, "pair_t.a")
    TB.commit(spark, tmp_root, written)
    assert TB.read_table(spark, tmp_root, "pair_t.a").count() == TB.read_table(spark, tmp_root, "pair_t.b").count() == 1


def test_schema_mismatch_is_refused(spark, tmp_root):
    df = spark.createDataFrame([("x", 1)], "market string, price int")
    with pytest.raises(TB.SchemaMismatchError):
        TB.publish(df, "bronze_t.bad", tmp_root, schema=SCHEMA)


def test_a_span_of_dates_reads_its_years_only(spark, tmp_root):
    rows = [(dt.date(2003 + i % 5, 1 + i % 12, 1), "m", float(i)) for i in range(60)]
    TB.publish_by_year(TB.declared_rows(spark, rows, SCHEMA), "silver_t.spans", tmp_root, "price_date", schema=SCHEMA)
    span = dt.date(2004, 6, 1), dt.date(2005, 2, 1)
    df = TB.within_dates(TB.read_table(spark, tmp_root, "silver_t.spans"), "price_date", *span)
    assert df.count() == sum(span[0] <= r[0] <= span[1] for r in rows)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "price_date_year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {r[0] for r in TB.read_table(spark, tmp_root, "silver_t.spans").where("price_date_year BETWEEN 2004 AND 2005").select("price_date").collect()}
    assert {r.price_date for r in df.collect()} < read


def test_year_partitions_prune(spark, tmp_root):
    rows = [(dt.date(2003 + i % 3, 1, 1), "m", float(i)) for i in range(9)]
    out = TB.publish_by_year(TB.declared_rows(spark, rows, SCHEMA), "silver_t.prices", tmp_root, "price_date", schema=SCHEMA)
    df = spark.table("silver_t.prices").where(F.col("price_date_year") == 2004)
    assert df.count() == 3
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "price_date_year" in plan
    assert out["rows"] == 9 and len(spark.read.parquet(out["path"]).inputFiles()) == 3  # a file for each year
