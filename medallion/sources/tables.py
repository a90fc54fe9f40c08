"""Table lifecycle on plain files.

A publish writes a new versioned directory and then appends one row per
table to the load log; that append is the commit. A table *is* the version
that its newest row in the log names, so any process that knows the lake's
root reads what was committed last (:func:`read_table`), never half of a
table, and a rebuild may read the table it replaces. Tables committed
together become visible together, in one append.

A name in the session's catalog is a convenience on top, a view of the
committed version.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("version", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("rows", T.LongType()),
])


class SchemaMismatchError(ValueError):
    pass


class NoSuchTableError(LookupError):
    pass


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """``CREATE DATABASE IF NOT EXISTS``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def declared(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def check_schema(df: DataFrame, schema: T.StructType | str) -> None:
    """Names, order and types must equal the declared schema."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in declared(schema).fields]
    if got != want:
        raise SchemaMismatchError(f"frame schema {got} differs from declared {want}")


def _qualified(name: str) -> tuple[str, str]:
    namespace, _, table = name.rpartition(".")
    return namespace or "default", table


def write_version(
    df: DataFrame, name: str, root: str, schema: T.StructType | str | None = None, partition_by: Sequence[str] = (),
    dealt: bool = False,
) -> dict:
    """Write ``df`` as a new, not yet visible version of table ``name``.

    ``schema`` is the declared schema without the partition columns. Rows of
    a partition are rebalanced into files of the advisory size first, so a
    partition does not get a file from every task; not where the caller has
    ``dealt`` them so that a task holds few partitions.
    """
    if schema is not None:
        check_schema(df.drop(*partition_by), schema)
    namespace, table = _qualified(name)
    version = dt.datetime.now(dt.timezone.utc).strftime("%Y%m%dT%H%M%S%f") + "-" + uuid.uuid4().hex[:8]
    path = f"{root}/{namespace}/{table}/v={version}"
    obs = Observation(f"publish_{table}_{version}")
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_by and dealt:
        writer = counted.write.partitionBy(*partition_by)
    elif partition_by:
        writer = counted.hint("rebalance", *partition_by).write.partitionBy(*partition_by)
    else:
        writer = counted.write
    writer.mode("errorifexists").parquet(path)
    return {"name": name, "version": version, "path": path, "rows": int(obs.get["rows"])}


def commit(spark: SparkSession, root: str, written: Sequence[dict], views: bool = True) -> None:
    """Make written versions the current ones, together."""
    rows = [(w["name"], w["version"], w["path"], w["rows"]) for w in written]
    log = spark.createDataFrame(rows, "table_name string, version string, path string, rows long")
    stamped = log.withColumn("committed_at", F.current_timestamp()).select(*AUDIT_SCHEMA.fieldNames())
    stamped.coalesce(1).write.mode("append").parquet(_log_path(root))
    for w in written if views else ():
        namespace, table = _qualified(w["name"])
        ensure_namespace(spark, namespace)
        spark.sql(f"CREATE OR REPLACE VIEW `{namespace}`.`{table}` AS SELECT * FROM parquet.`{w['path']}`")


def publish(
    df: DataFrame, name: str, root: str, schema: T.StructType | str | None = None, partition_by: Sequence[str] = (),
) -> dict:
    """Atomic full refresh of table ``name`` (``namespace.table``) under ``root``."""
    written = write_version(df, name, root, schema, partition_by)
    commit(df.sparkSession, root, [written])
    return written


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The committed version of table ``name`` under ``root``."""
    newest = load_history(spark, root, name).first()
    if newest is None:
        raise NoSuchTableError(f"{name} was never published under {root}")
    return spark.read.parquet(newest["path"])


def with_year(df: DataFrame, date_col: str) -> tuple[DataFrame, str]:
    """``df`` with the year to partition by (S6); rows without a date are in the null partition."""
    name = f"{date_col}_year"
    return df.withColumn(name, F.year(F.col(date_col))), name


def within_dates(table: DataFrame, date_col: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows of a table partitioned by year (:func:`with_year`) from ``first``
    to ``last``. The years follow from the dates, so that only their folders
    are read; who asks for dates need not know how the table lies."""
    _, year = with_year(table, date_col)
    return table.where(F.col(date_col).between(first, last) & F.col(year).between(first.year, last.year))


def publish_by_year(df: DataFrame, name: str, root: str, date_col: str, schema: T.StructType | str | None = None) -> dict:
    """Year-partitioned publish: filters on the year column prune directories."""
    with_col, year = with_year(df, date_col)
    return publish(with_col, name, root, schema, partition_by=[year])


def _log_path(root: str) -> str:
    return f"{root}/_load_audit"


def load_history(spark: SparkSession, root: str, name: str | None = None) -> DataFrame:
    """Loads under ``root``, newest first."""
    try:
        log = spark.read.schema(AUDIT_SCHEMA).parquet(_log_path(root))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        log = spark.createDataFrame([], AUDIT_SCHEMA)
    if name:
        log = log.where(F.col("table_name") == name)
    return log.orderBy(F.col("committed_at").desc(), F.col("version").desc())


def declared_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A literal row set under a declared schema."""
    return spark.createDataFrame(list(rows), schema)
