"""Counters and profiles.

Each profile is one aggregation; group-bys are partially aggregated on the
map side, so a hot group costs one row per map task in the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_count(df: DataFrame, by: Sequence[str | Column], name: str = "n") -> DataFrame:
    """Rows per group; null is a group of its own."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def log_counts(logs: Sequence[DataFrame]) -> DataFrame:
    """Events and distinct source transactions of each log and op, tombstones
    included, from one scan: what the three profiles below ask one by one.
    They can be read from a written copy of it."""
    events = stacked([log.select("source_table", "op", "tx_id") for log in logs])
    return events.groupBy("source_table", "op").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("tx_id").alias("transactions")
    )


def op_profile(logs: Sequence[DataFrame]) -> DataFrame:
    """Change events per log and op, tombstones (null op) included (A4)."""
    counts = [group_count(log, ["source_table", "op"], "events") for log in logs]
    return stacked(counts).orderBy("source_table", F.col("op").asc_nulls_first())


def stacked(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of all frames, columns matched by name."""
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return whole


def op_transactions(changes: DataFrame) -> DataFrame:
    """Events and distinct source transactions per op, busiest first (A5)."""
    return (
        changes.groupBy("op")
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("tx_id").alias("transactions"))
        .orderBy(F.col("events").desc(), F.col("op").asc_nulls_first())
    )


def op_by_source(logs: Sequence[DataFrame]) -> DataFrame:
    """Events per (source table, op) over the union of several logs."""
    events = stacked([log.select("source_table", "op") for log in logs])
    busiest_first = [F.col("source_table").asc(), F.col("events").desc(), F.col("op").asc_nulls_first()]
    return group_count(events, ["source_table", "op"], "events").orderBy(*busiest_first)


def span(df: DataFrame, column: str, prefix: str) -> list[Column]:
    """Min and max of a column."""
    return [F.min(column).alias(f"first_{prefix}"), F.max(column).alias(f"last_{prefix}")]


def preview(df: DataFrame, n: int = 5) -> list:
    """The first ``n`` rows for a log line (O3); ``n`` bounds what reaches the driver."""
    return df.limit(n).collect()


def load_span(df: DataFrame, by: str = "source", column: str = "ingested_at") -> DataFrame:
    """Rows and first/last load time per source."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *span(df, column, "load"))


def inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table in one job."""
    return stacked([
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name, df in tables.items()
    ])


def version_counts(satellite: DataFrame, key: str) -> DataFrame:
    """Versions per hub key, most versions first (A10)."""
    return group_count(satellite, [key], "versions").orderBy(F.col("versions").desc(), F.col(key))
