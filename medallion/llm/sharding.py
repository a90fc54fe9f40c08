"""Weighted rendezvous hashing of record keys over shards.

Every (key, shard) pair has its own uniform number u in (0, 1), and a key goes
to the shard with the largest ``weight / -ln(u)``. A shard's number does not
depend on the others, so adding one moves only the keys that the new shard
wins, and removing one moves only its own keys; the shares follow the weights.

The shard is a column expression. The place inside a shard (``slot``) needs a
running count: rows are numbered inside (shard, writer partition), and a
table of counts with one row for each such pair gives each its first slot, so
no task sees more of a shard than one partition's part of it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.common import staged

_DIGITS = 13
_SPAN = float(16**_DIGITS)


def uniform(key: Column, label: Column) -> Column:
    """A number in (0, 1) from the md5 of ``key:label``."""
    digest = F.md5(F.concat_ws(":", key, label.cast("string")).cast("binary"))
    return (F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") + F.lit(0.5)) / F.lit(_SPAN)


def rendezvous(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of ``key``; shards of weight 0 take nothing. A null key is
    the empty text. Equal scores go to the smaller shard number."""
    if not any(w > 0 for w in weights.values()):
        raise ValueError("some shard needs a positive weight")
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights cannot be negative")
    text = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(*[
        F.struct(F.lit(int(s)).alias("shard"), F.lit(float(w)).alias("weight")) for s, w in sorted(weights.items()) if w > 0
    ])
    scores = F.transform(
        shards,
        lambda s: F.struct((s["weight"] / -F.log(uniform(text, s["shard"]))).alias("score"), (-s["shard"]).alias("tie")),
    )
    return (-F.array_max(scores)["tie"]).cast("int")


def assign(df: DataFrame, key: str, weights: Mapping[int, float], shard_col: str = "shard") -> DataFrame:
    """``df`` with its shard. An existing column of that name is replaced."""
    return df.withColumn(shard_col, rendezvous(F.col(key), weights))


def number_slots(rows: DataFrame, shard_col: str, order: list[str], slot_col: str = "slot") -> DataFrame:
    """``rows`` with a gapless number from 0 in each shard.

    The rows are written once with the partition that wrote them; both the
    counts and the numbers come from that written table, so they agree after
    a retry. Repeated rows get places of their own.
    """
    own = staged(
        rows.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id()), "slots"
    )
    counts = own.groupBy(shard_col, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(shard_col).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col(shard_col).alias("__s"), F.col("__part").alias("__p"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__first"),
    )
    inside = Window.partitionBy(shard_col, "__part").orderBy(*order, "__row")
    numbered = own.withColumn("__i", F.row_number().over(inside) - 1)
    return (
        numbered.join(first, (F.col(shard_col) == F.col("__s")) & (F.col("__part") == F.col("__p")))
        .withColumn(slot_col, (F.col("__first") + F.col("__i")).cast("long"))
        .drop("__part", "__row", "__s", "__p", "__first", "__i")
    )


def shard_documents(documents: DataFrame, shards: int = 24, weights: Mapping[int, float] | None = None) -> DataFrame:
    """Placement of documents under the ``key`` law.

    Columns: doc_id, size (UTF-8 bytes plus 8; null text has none),
    text_crc32 (null text: that of no bytes, 0), law, shard, slot, and
    grown_shard: the shard if one more of weight 1 existed. An empty table
    gives no rows; repeated rows share a shard and get a slot each; other
    columns are not read.
    """
    weights = dict(weights or {s: 1.0 for s in range(shards)})
    text = F.coalesce(F.col("text"), F.lit(""))
    more = weights | {max(weights) + 1: 1.0}
    rows = documents.select(
        F.col("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), more).alias("grown_shard"),
    )
    return number_slots(rows, "shard", ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )
