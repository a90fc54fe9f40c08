"""Tables, staging and connected components shared by the operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from medallion.session import checkpoint_root

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of the session
    (once per application), however the driver came to import it."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parent.parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="medallion-code-")), "medallion_code.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, str(file.relative_to(package.parent)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else (``lower`` would also fold other scripts)."""
    return F.translate(text, UPPER, UPPER.lower())


def fold(doc_id: Column, modulus: int = 5) -> Column:
    """crc32 of the decimal doc_id, modulo ``modulus``; null ids fold as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(modulus)).cast("int")


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder of the session and read it back.

    Cuts the lineage in files that every executor can reach, so a lost
    executor costs a re-read and not the steps before. The folder is the one
    of ``spark.checkpoint.dir``; it is the caller's to clean with the rest of
    that folder.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*tables: DataFrame) -> None:
    """Delete the folders of tables written by :func:`staged` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            jvm = spark._jvm
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps whose result is staged.

    Spark removes a shuffle's files when the driver collects the plan that
    made them; a job of several steps would else hold the files of all.
    """
    gc.collect()
    spark._jvm.System.gc()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of the undirected graph of ``edges`` (a, b), by
    alternating large and small stars; ``component`` is the smallest node.

    Every round maps an edge list to one of at most the same length, so a hub
    node costs rows in proportion to its edges and never pairs of its
    neighbours; the minimum per node is pre-aggregated before the shuffle and
    written, so that the join with a hub's edges can be split. Each round is
    written to the shared folder; it ends when no edge changes.
    """
    def minima(pairs: DataFrame) -> DataFrame:
        return staged(pairs.groupBy("u").agg(F.min("v").alias("m")), "minima")

    def large_star(e: DataFrame) -> DataFrame:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select(F.col("b"), F.col("a")))
        near = minima(both).select("u", F.least("m", "u").alias("m"))
        return both.join(near, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))

    def small_star(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
        near = minima(down)
        moved = down.join(near, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        return moved.union(near.select("u", "m")).where("a <> b").distinct()

    current = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        following = staged(small_star(large_star(current)), "edges")
        sums = following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        drop_staged(current)
        current = following
        if sums == before:
            break
        before = sums
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def row_ranges(offsets, max_bytes: int):
    """Consecutive row ranges [i, j) of an offsets array of about ``max_bytes``
    each; a longer single row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = i + 1
        while j < n and offsets[j + 1] - offsets[i] <= max_bytes:
            j += 1
        yield i, j
        i = j


Query = Callable[[SparkSession, str], DataFrame]
