"""One key holding a third of all rows takes several segments and files, whatever its positions look like."""

import random
import re

import pytest
from pyspark.sql import functions as F

from medallion.functions.ordering import EVENT_ORDER
from medallion.operators.history import change_rows
from medallion.operators.segments import BUCKET, SEGMENT, _table_of, bucket_values, drop_staged, stage_ordered

N, SEGMENTS = 3000, 12
POSITIONS = {
    "rising": lambda i: i * 10,
    "same": lambda i: 7,
    "null": lambda i: None,
    "one far outlier": lambda i: 10**12 if i == 0 else 5,
}


def test_rows_are_made_once(spark):
    """Segments are sampled from written rows: what makes the rows runs once for each."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(5000).selectExpr("id % 7 AS k", "id AS lsn", "id * 3 AS v").mapInArrow(counted, "k long, lsn long, v long")
    staged = stage_ordered(rows, ["k"], ["lsn"], "once")
    assert staged.count() == 5000 and seen.value == 5000


@pytest.fixture()
def twelve_segments(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(SEGMENTS))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def skewed_log(spark, position):
    rnd = random.Random(11)
    rows = [("hot" if i % 3 == 0 else f"k{rnd.randint(0, 300)}", position(i), i, rnd.choice("ABC")) for i in range(N)]
    return spark.createDataFrame(rows, "hk string, lsn long, offset long, h string").select(
        "hk", "lsn", F.lit(1).cast("long").alias("source_ts_ms"), "offset", F.lit("s").alias("record_source"), "h")


@pytest.mark.parametrize("shape", sorted(POSITIONS))
def test_segments_are_balanced_and_stitched(spark, twelve_segments, shape):
    log = skewed_log(spark, POSITIONS[shape])
    staged = stage_ordered(log, ["hk"], EVENT_ORDER, "skew")
    sizes = [r["count"] for r in staged.groupBy(SEGMENT).count().collect()]
    assert max(sizes) < 2 * N / SEGMENTS
    hot = staged.where("hk = 'hot'")
    assert hot.select(SEGMENT).distinct().count() >= 4 and hot.select(F.input_file_name()).distinct().count() >= 4
    previous, expected = {}, []
    rows = [(r.hk, r.lsn, r.offset, r.h) for r in log.collect()]
    for hk, lsn, offset, h in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        if previous.get(hk) != h:
            expected.append((hk, offset, h))
        previous[hk] = h
    assert sorted((r.hk, r.offset, r.h) for r in change_rows(staged, "hk", "h").collect()) == sorted(expected)
    folder = staged.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("///", "/")
    drop_staged(staged)
    import os
    assert not os.path.exists(folder)


def test_rows_that_are_equal_in_all_but_a_value_are_dealt_too(spark, twelve_segments):
    log = spark.range(N).select(F.lit("hot").alias("hk"), F.lit(1).cast("long").alias("lsn"), F.col("id").alias("v"))
    staged = stage_ordered(log, ["hk"], ["lsn"], "ties")
    assert max(r["count"] for r in staged.groupBy(SEGMENT).count().collect()) < 2 * N / SEGMENTS


def test_windows_read_segments_where_they_lie(spark, twelve_segments):
    """A segment is a bucket of its own, so no operator above shuffles the rows: the exchanges are those of one row per segment."""
    log = skewed_log(spark, POSITIONS["rising"])
    staged = stage_ordered(log, ["hk"], EVENT_ORDER, "buckets")
    assert staged.groupBy(BUCKET).agg(F.count_distinct(SEGMENT).alias("n")).where("n > 1").count() == 0
    values = bucket_values(spark, SEGMENTS)
    slots = spark.createDataFrame([(v,) for v in values], "v int").selectExpr(f"pmod(hash(v), {SEGMENTS}) AS slot")
    assert [r.slot for r in slots.collect()] == list(range(SEGMENTS))
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for threshold in ("-1", held):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            plan = change_rows(staged, "hk", "h")._jdf.queryExecution().executedPlan().toString()
            assert not re.findall(rf"hashpartitioning\((?:{BUCKET}|{SEGMENT}|hk)#", plan)
            assert "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert spark.catalog.tableExists(_table_of(staged.inputFiles()[0].rsplit("/", 1)[0]))
    name = _table_of(staged.inputFiles()[0].rsplit("/", 1)[0])
    drop_staged(staged)
    assert not spark.catalog.tableExists(name)
