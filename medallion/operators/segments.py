"""Row-balanced segments of ordered per-key rows.

Operators that need a key's rows in order (change detection, as-of matching)
would put a key with a third of all rows into one task if they were
partitioned by key. Here the rows are range-partitioned by key *and* order,
so every partition holds about as many rows, whatever the keys; the
partition is kept as a column, the *segment*, in a table in the shared
folder. A key's rows lie in one segment or in consecutive ones, and what an
operator must know about a key's earlier segments is one row per segment
(:func:`carried`).

The staged table is bucketed so that a segment is a bucket of its own: Spark
knows from the table where a segment's rows lie, and windows, aggregates and
joins by segment read them there, without another shuffle.

There is one plan at every size: no statistics are gathered and no threshold
picks another. The number of segments is that of shuffle partitions, less
what adaptive execution joins when they are small.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from medallion.session import remove, work_path

#: The place of a segment among all, and the value that Spark buckets it by.
SEGMENT, BUCKET = "_seg", "_bucket"


def most_segments(spark: SparkSession) -> int:
    """Partitions that a shuffle of this session has at most."""
    first = spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None)
    return max(int(n) for n in (spark.conf.get("spark.sql.shuffle.partitions"), first) if n)


def bucket_values(spark: SparkSession, n: int) -> list[int]:
    """For each of ``n`` buckets the smallest number that falls into it, so
    that no two segments share a bucket (hashes of the segments' own numbers
    would leave a third of the buckets empty). Evaluated while planning."""
    tried = math.ceil(n * (math.log(n) + 5))
    while True:
        buckets = spark.sql(f"SELECT transform(sequence(0, {tried}), x -> pmod(hash(x), {n})) FROM VALUES (0)").first()[0]
        found: dict[int, int] = {}
        for value, bucket in enumerate(buckets):
            found.setdefault(bucket, value)
        if len(found) == n:
            return [found[k] for k in range(n)]
        tried *= 2


def stage_ordered(df: DataFrame, by: Sequence[str], order: Sequence[str], name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` with its segment as a bucketed table and read that. Rows
    with equal keys and order are dealt by their other columns.

    The rows are written once as they come, and the bounds of the segments
    are sampled from what is written: whatever ``df`` does (decoding, joins)
    is done once.
    """
    spark = df.sparkSession
    plain, path = (work_path(spark, f"{kind}-{name}", folder) for kind in ("plain", "ordered"))
    df.write.parquet(plain)
    rows = spark.read.schema(df.schema).parquet(plain)
    ties = [c for c in df.columns if c not in {*by, *order}]
    dealt = rows.withColumn("_tie", F.xxhash64(*ties)) if ties else rows.withColumn("_tie", F.lit(0))
    ranged = dealt.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*by, *order, "_tie"]]).drop("_tie")
    n = most_segments(spark)
    values = F.split(F.lit(",".join(map(str, bucket_values(spark, n)))), ",").cast("array<int>")
    staged = ranged.withColumn(SEGMENT, F.spark_partition_id()).withColumn(BUCKET, F.element_at(values, F.col(SEGMENT) + 1))
    staged.write.bucketBy(n, BUCKET).format("parquet").option("path", path).saveAsTable(_table_of(path))
    remove(spark, plain)
    return spark.table(_table_of(path))


def _table_of(path: str) -> str:
    return re.sub(r"\W", "_", path.rsplit("/", 1)[1])


def drop_staged(*tables: DataFrame) -> None:
    """Delete the folders of staged tables, those above their partitions, and
    what the catalog says of them."""
    for df in tables:
        for folder in {re.sub(r"(/[^/=]+=[^/]*)*/[^/]+$", "", file) for file in df.inputFiles()}:
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {_table_of(folder)}")
            remove(df.sparkSession, folder)


def carried(staged: DataFrame, last: Column) -> DataFrame:
    """For every segment, the last non-null ``last`` (an aggregate over a
    segment's rows) of the segments before it. One row per segment."""
    ends = staged.groupBy(BUCKET).agg(F.first(SEGMENT).alias(SEGMENT), last.alias("_last"))
    before = Window.orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(F.col(BUCKET).alias("_bucket_to"), F.last("_last", ignorenulls=True).over(before).alias("_carry"))


def with_carry(staged: DataFrame, last: Column) -> DataFrame:
    """``staged`` with ``_carry`` of its segment."""
    seams = carried(staged, last)
    return staged.join(seams, F.col(BUCKET) == F.col("_bucket_to")).drop("_bucket_to")
