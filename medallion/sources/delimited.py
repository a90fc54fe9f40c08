"""Delimited-file landing into a typed Bronze frame.

Columns are bound by the names in each file's own header, so files whose
columns stand in another order, or that have further columns, land right. What
can't be bound is a reject with a reason and its line as it came: rows with
too few or too many fields, and all rows of a file that lacks a wanted column
or names one twice. Nothing is cut or filled up in passing.
"""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE, LINE, REASONS = "file", "line", "reject_reasons"
_RAW = "_line"
#: headers that are read at the same time
_AT_ONCE = 16


def _names(header: str, sep: str) -> tuple[str, ...]:
    return tuple(name.strip() for name in next(csv.reader([header.removeprefix("﻿")], delimiter=sep), []))


def files_by_header(spark: SparkSession, path: str, sep: str = ",") -> dict[str, list[str]]:
    """The files below ``path`` by the text of their first line; files without one have no rows.

    One line of each file comes to the driver, which lists the files anyway.
    """
    def first(file: str) -> tuple[str, str | None]:
        line = spark.read.text(file).head()
        return file, line and line[0]

    files = sorted(set(spark.read.option("recursiveFileLookup", "true").text(path).inputFiles()))
    with ThreadPool(_AT_ONCE) as pool:
        firsts = pool.map(first, files)
    found: dict[str, list[str]] = defaultdict(list)
    for file, header in firsts:
        if header is not None:
            found[header].append(file)
    return dict(found)


def _against(names: Sequence[str], columns: Sequence[str]) -> str:
    """Why a header can't be bound to the wanted columns, or ''."""
    lacks = [c for c in columns if c not in names]
    twice = sorted({c for c in columns if list(names).count(c) > 1})
    return "; ".join([f"header: lacks {c}" for c in lacks] + [f"header: names {c} twice" for c in twice])


def landed(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", multiline: bool = False) -> DataFrame:
    """All rows below ``path``: the wanted columns as text, the row's file,
    and for rejects (whose columns count for nothing) their line and reasons.

    Quoted separators stay inside their field. A quoted line feed ends its
    row, which makes both parts rejects, unless ``multiline`` is set; files are
    then read whole by one task each.
    """
    nothing = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, FILE, LINE, REASONS]])
    parts = [spark.createDataFrame([], nothing)]
    file = F.col("_metadata.file_path").alias(FILE)
    for header, files in files_by_header(spark, path, sep).items():
        names = _names(header, sep)
        if reasons := _against(names, columns):
            lines = spark.read.text(files).where(F.col("value") != F.lit(header))
            parts.append(lines.select(*[F.lit(None).cast("string").alias(c) for c in columns], file, F.col("value").alias(LINE), F.lit(reasons).alias(REASONS)))
            continue
        # Places instead of names: a header may hold names that differ in case only.
        schema = T.StructType([T.StructField(x, T.StringType()) for x in [*[f"_{k}" for k in range(len(names))], _RAW]])
        rows = (
            spark.read.schema(schema)
            .option("header", "true")
            .option("sep", sep)
            .option("quote", '"')
            .option("escape", '"')
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _RAW)
            .option("columnPruning", "false")  # a row's fields are counted whichever of them is wanted
            .option("multiLine", str(multiline).lower())
            .csv(files)
        )
        # A field is part of the condition, as Spark doesn't read the line of a malformed row by itself.
        line = F.coalesce(F.col(_RAW), F.substring(F.coalesce("_0", F.lit("")), 1, 0))
        against = F.when(line != "", F.lit(f"row: not {len(names)} fields"))
        parts.append(rows.select(*[F.col(f"_{names.index(c)}").alias(c) for c in columns], file, F.col(_RAW).alias(LINE), against.alias(REASONS)))
    return reduce(DataFrame.unionByName, parts[1:]) if len(parts) > 1 else parts[0]


def read_delimited(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",", multiline: bool = False) -> DataFrame:
    """The wanted columns of all rows that their files' headers bind, as text."""
    return accepted(landed(spark, path, columns, sep, multiline), columns)


def accepted(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.where(F.col(REASONS).isNull()).select(*columns)


def rejected(rows: DataFrame) -> DataFrame:
    """file, line and reasons of the rows that could not be bound."""
    return rows.where(F.col(REASONS).isNotNull()).select(FILE, LINE, REASONS)


def write_delimited(df: DataFrame, path: str, sep: str = ",", compression: str = "none") -> None:
    """Text landing of string rows; surrounding spaces are kept verbatim.
    Spark reads compressed files by their ending; gzip ones are one task each."""
    (
        df.write.option("header", "true")
        .option("sep", sep)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("compression", compression)
        .mode("errorifexists")
        .csv(path)
    )


def map_columns(df: DataFrame, mapping: Sequence[tuple[str, str, str]], date_format: str = "yyyy-MM-dd") -> list[Column]:
    """(source, target, type) triples → one projection in target order.

    Text that does not parse becomes null, never an error.
    """
    cols = []
    for source, target, dtype in mapping:
        c = F.col(source)
        if dtype == "date":
            c = F.try_to_date(c, date_format)
        elif dtype != "string":
            c = c.try_cast(dtype)
        cols.append(c.alias(target))
    return cols


def lineage(source: str) -> list[Column]:
    """Constant source tag and load time (C2); the time is fixed per query."""
    return [F.lit(source).alias("source"), F.current_timestamp().alias("ingested_at")]


def typed_landing(raw: DataFrame, mapping: Sequence[tuple[str, str, str]], source: str) -> DataFrame:
    return raw.select(*map_columns(raw, mapping), *lineage(source))
