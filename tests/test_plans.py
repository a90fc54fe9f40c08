"""Physical-plan properties the scale design relies on."""

import re

import pytest
from pyspark.sql import functions as F

from medallion.plans import food, shop
from medallion.plans import vault as V
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    for name, log in shop.bronze_changes(spark, SF_SMALL).items():
        log.write.parquet(f"{root}/{name}")
    return {n: spark.read.parquet(f"{root}/{n}") for n in V.LOGS}


def jobs_started(spark, build) -> int:
    """Jobs that building a plan starts."""
    group = f"plan-{id(build)}"
    spark.sparkContext.setJobGroup(group, "plan")
    try:
        build()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def final(df) -> str:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_decode_pushes_tombstone_filter_and_prunes(landed):
    plan = V.decoded(landed["products"], "products")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(op)]" in plan
    read_schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert "event" not in read_schema and "kafka_key" not in read_schema and "payload" in read_schema


def test_plans_start_no_job(spark, landed):
    text = food.bronze_text(spark, SF_SMALL)
    from medallion.plans import prices as P

    assert jobs_started(spark, lambda: V.decoded(landed["orders"], "orders")) == 0
    assert jobs_started(spark, lambda: P.silver_prices(text)) == 0
    staged = V.staged_changes(landed["products"], landed["orders"])
    assert jobs_started(spark, lambda: V.vault_tables(staged)) == 0


def test_the_order_value_writes_one_table_more(spark, landed):
    from medallion.plans.order_value import order_value_versions

    staged = V.staged_changes(landed["products"], landed["orders"])
    assert jobs_started(spark, lambda: order_value_versions(staged)) > 0  # the as-of rows, staged in segments
    plan = final(order_value_versions(staged))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan and "Python" not in plan


def test_hubs_are_reduced_before_the_shuffle(landed):
    staged = V.staged_changes(landed["products"], landed["orders"])
    plan = final(V.vault_table(staged, "hub_order"))
    assert re.search(r"WindowGroupLimit .* 1, Partial", plan.split("Exchange")[1]) and "SortAggregate" not in plan


def test_one_scan_of_each_log_gives_all_hubs_and_links(landed):
    staged = V.staged_changes(landed["products"], landed["orders"])
    plan = final(V.first_seen(staged))
    assert plan.count("FileScan parquet") == len(staged) and plan.count("Exchange hashpartitioning") == 1
    assert re.search(r"WindowGroupLimit .* 1, Partial", plan.split("Exchange")[1])
    own = V.staged_firsts(staged)
    read = V.from_firsts(own, "link_order")._jdf.queryExecution().executedPlan().toString()
    assert "(_table" in read.split("PartitionFilters: ")[1].splitlines()[0]


def test_joins_carry_no_hint(spark):
    from medallion.sources.testdata import price_rows

    assert "hint" not in price_rows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_the_landing_joins_only_the_lineitems_of_a_file(spark):
    from medallion.sources.testdata import price_rows

    whole = price_rows(spark, SF_SMALL)
    parts = [price_rows(spark, SF_SMALL, F.col("l_suppkey") % 2 == k) for k in (0, 1)]
    assert sorted(map(tuple, whole.collect()), key=str) == sorted((tuple(r) for p in parts for r in p.collect()), key=str)
    plan = parts[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("l_suppkey#") and "s_suppkey" in plan
    scans = [line for line in plan.splitlines() if "Filter" in line and "l_suppkey" in line and "% 2" in line]
    assert scans, plan


def test_the_landing_is_compressed(spark):
    from pathlib import Path

    from medallion.plans.food import landed_csv

    files = [f for f in Path(landed_csv(spark, SF_SMALL).removeprefix("file:")).rglob("part-*")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)


@pytest.mark.parametrize("log", ["products", "orders"])
def test_decoding_parses_each_json_text_once(spark, log):
    plan = V.decoded(shop.bronze_changes(spark, SF_SMALL)[log], log)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 2, plan  # the envelope and its payload
    assert plan.count("get_json_object(") <= 2, plan


def test_price_rows_of_lines_without_number_flags_or_order(spark, tmp_root):
    from medallion.sources.testdata import price_rows

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/{name}.parquet")

    lines = [(None, 1, 1, None, 4000.0, None, None, None), (97 * 50, 1, 1, 2, 8000.0, "R", "F", "1997-01-02"), (89, 1, 1, 7, 1.0, "A", "O", "1997-01-02")]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, "
          "l_linestatus string, l_shipdate string")
    write("part", [(1, "p", "t", 1)], "p_partkey long, p_name string, p_type string, p_size int")
    write("supplier", [(1, "s", 1)], "s_suppkey long, s_name string, s_nationkey int")
    write("nation", [(1, "n", 1)], "n_nationkey int, n_name string, n_regionkey int")
    write("region", [(1, "r")], "r_regionkey int, r_name string")
    rows = price_rows(spark, tmp_root).select("date", "unit", "priceflag", "pricetype", "price").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([
        (None, "Day", None, None, "4000.0"), ("bad-date", "5 L", "actual,aggregate", "Wholesale", "8000.0"),
        (" bad-date ", " 5 L ", " actual,aggregate ", " Wholesale ", " 8000.0 "), ("1997-01-02", "KG", "actual", "Retail", "n/a"),
    ], key=str)
