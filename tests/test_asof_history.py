import random

import pytest
from pyspark.sql import functions as F

from medallion.operators.asof import asof_join
from medallion.functions.ordering import EVENT_ORDER
from medallion.operators.history import change_rows, earliest, latest
from medallion.operators.segments import stage_ordered


def brute_asof(left, right, how):
    out = []
    for lk, lt, lid in left:
        cands = [r for r in right if lk is not None and r[0] == lk and r[1] is not None and lt is not None and r[1] <= lt]
        if cands:
            best = max(cands, key=lambda r: (r[1], r[2]))
            out.append((lid, best[3]))
        elif how == "left":
            out.append((lid, None))
    return sorted(out, key=lambda t: (t[0], t[1] is None, t[1] or 0))


@pytest.fixture()
def segments(spark):
    """Set the number of segments; small tables would otherwise be one."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}

    def use(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")

    yield use
    for k, v in held.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize(("seed", "n"), [(1, 1), (2, 4), (3, 13)])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_matches_brute_force(spark, segments, seed, n, how):
    segments(n)
    rnd = random.Random(seed)
    keys = ["a", "b", "c", None]
    right = []
    for i in range(120):
        t = rnd.randint(0, 200) if rnd.random() > 0.05 else None
        right.append((rnd.choice(keys), t, rnd.randint(0, 5), i))  # (key, t, tiebreak, payload)
    left = [(rnd.choice(keys), rnd.randint(-10, 220) if rnd.random() > 0.05 else None, j) for j in range(150)]
    ldf = spark.createDataFrame(left, "k string, t long, lid int")
    rdf = spark.createDataFrame(right, "k string, rt long, tb int, payload int")
    got = asof_join(ldf, rdf, "k", "t", "rt", tiebreak=["tb", "payload"], how=how)
    got_rows = sorted(((r["lid"], r["payload"]) for r in got.collect()), key=lambda t: (t[0], t[1] is None, t[1] or 0))
    right_for_brute = [(k, t, (tb, p), p) for k, t, tb, p in right]
    assert got_rows == brute_asof(left, right_for_brute, how)


def test_asof_timestamps(spark, segments):
    segments(4)
    left = spark.createDataFrame(
        [("x", "2024-01-01 00:00:10", 1), ("x", "2024-01-03 00:00:00", 2)], "k string, at string, id int"
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))
    right = spark.createDataFrame(
        [("x", "2024-01-01 00:00:05", 10), ("x", "2024-01-01 00:00:10", 11)], "k string, vt string, v int"
    ).withColumn("vt", F.col("vt").cast("timestamp_ntz"))
    got = sorted((r["id"], r["v"]) for r in asof_join(left, right, "k", "at", "vt").collect())
    assert got == [(1, 11), (2, 11)]


def brute_changes(rows):
    out, prev = [], {}
    for k, lsn, h in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2])):
        if prev.get(k, object()) != h:
            out.append((k, lsn, h))
        prev[k] = h
    return sorted(out, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))


@pytest.mark.parametrize(("seed", "n"), [(5, 1), (5, 7), (6, 40)])
def test_change_rows_match_brute_force(spark, segments, seed, n):
    segments(n)
    rnd = random.Random(seed)
    data = []
    lsns = list(range(200))
    rnd.shuffle(lsns)
    for i in lsns:
        data.append((rnd.choice(["k1", "k2", "k3"]), i if rnd.random() > 0.03 else None, rnd.choice(["A", "B"])))
    df = spark.createDataFrame(data, "hk string, lsn long, h string").select(
        "hk", "lsn", F.lit(None).cast("long").alias("source_ts_ms"), F.lit(None).cast("long").alias("offset"),
        F.lit("s").alias("record_source"), "h")
    got = change_rows(stage_ordered(df, ["hk"], EVENT_ORDER, "t"), "hk", "h")
    got_rows = sorted(((r["hk"], r["lsn"], r["h"]) for r in got.collect()), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert got_rows == brute_changes(data)


def test_earliest_and_latest_put_nulls_first(spark):
    df = spark.createDataFrame(
        [("k", 5, 1, 1, "b"), ("k", None, 9, 9, "a"), ("j", 2, 1, 2, "a"), ("j", 2, 1, 1, "z")],
        "hk string, lsn long, source_ts_ms long, offset long, record_source string",
    )
    first = sorted((r["hk"], r["lsn"], r["offset"]) for r in earliest(df, "hk", ["lsn", "offset"]).collect())
    last = sorted((r["hk"], r["lsn"], r["offset"]) for r in latest(df, "hk").collect())
    assert first == [("j", 2, 1), ("k", None, 9)] and last == [("j", 2, 2), ("k", 5, 1)]
