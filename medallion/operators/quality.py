"""Silver quality contract.

A row is judged once: :func:`judged` adds the casts of the contract columns
as one struct and the reasons against the row as one text. Accepted rows,
the quarantine and the vocabulary report are all read from that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.operators.history import first_of

REASONS = "reject_reasons"
CASTS, VERDICT = "_casts", "_reasons"
#: share of the rows from which on a key's copies are dropped before they move
OFTEN = 0.01


class UnmappedValuesError(ValueError):
    pass


def trim_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Trim spaces on both ends of the listed string columns (C4)."""
    return df.withColumns({c: F.trim(F.col(c)) for c in columns})


def vocabulary_reason(column: str) -> str:
    return f"{column}: not in its vocabulary"


def judged(df: DataFrame, contract: Mapping[str, str], vocabularies: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """``df`` with the casts and the reasons against each row.

    A value that is present but doesn't cast is a reason, and so is one
    outside its column's vocabulary; nulls pass. Reasons stand in contract
    order, vocabularies after casts.
    """
    casts = df.withColumn(CASTS, F.struct(*[F.col(c).try_cast(t).alias(c) for c, t in contract.items()]))
    # Fixed value: the wording of a failed cast.
    against = [
        F.when(F.col(c).isNotNull() & F.col(f"{CASTS}.{c}").isNull(), F.lit(f"{c}: failed cast to {t}")) for c, t in contract.items()
    ]
    against += [
        F.when(~F.col(c).isin(list(allowed)), F.lit(vocabulary_reason(c))) for c, allowed in (vocabularies or {}).items()
    ]
    return casts.withColumn(VERDICT, F.concat_ws("; ", *against))


def lean(rows: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Judged rows without what their verdict makes unread: texts of the
    contract columns of accepted rows, and casts of the others."""
    texts = {c: F.when(~is_accepted(), F.col(c)).alias(c) for c in contract}
    return rows.withColumns({**texts, CASTS: F.when(is_accepted(), F.col(CASTS))})


def is_accepted() -> Column:
    return F.col(VERDICT) == ""


def accepted(rows: DataFrame, contract: Mapping[str, str]) -> DataFrame:
    """Rows without a reason, contract columns as their casts."""
    typed = [F.col(f"{CASTS}.{c}").alias(c) if c in contract else F.col(c) for c in rows.columns if c not in (CASTS, VERDICT)]
    return rows.where(is_accepted()).select(*typed)


def quarantine(rows: DataFrame) -> DataFrame:
    """Rows with a reason, as they came, and the reasons."""
    return rows.where(~is_accepted()).drop(CASTS).withColumnRenamed(VERDICT, REASONS)


def flag_booleans(df: DataFrame, column: str, flags: Mapping[str, str], sep: str = ",") -> DataFrame:
    """Multi-value flag text → one boolean per flag value."""
    parts = F.split(F.col(column), sep)
    return df.withColumns({out: F.array_contains(parts, value) for out, value in flags.items()})


def unmapped_values(df: DataFrame, column: str, vocabulary: Sequence[str]) -> DataFrame:
    """Distinct values outside the vocabulary (C9, A12). Nulls pass the gate."""
    return df.where(~F.col(column).isin(list(vocabulary))).select(column).distinct()


def require_vocabulary(df: DataFrame, column: str, vocabulary: Sequence[str], named: int = 1000) -> None:
    """Abort with the values of ``column`` outside the vocabulary, sorted: the
    first ``named`` of them, and how many more there are. A column that is
    broken in every row brings no more than that to the driver."""
    unknown = unmapped_values(df, column, vocabulary)
    bad = [r[0] for r in unknown.orderBy(column).limit(named + 1).collect()]
    if bad:
        more = f" and {unknown.count() - named} more" if len(bad) > named else ""
        raise UnmappedValuesError(f"unmapped {column} values found in source: {', '.join(bad[:named])}{more}")


def lookup(column: str, mapping: Mapping[str, object]) -> Column:
    """Vocabulary lookup through a literal map; unknown or null keys give null."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value")) for k, v in mapping.items()])
    return F.map_from_entries(entries)[F.col(column)]


def dedup(df: DataFrame, key: Sequence[str], survivor_order: Sequence[str]) -> DataFrame:
    """One row per natural key (nulls equal): the smallest in a total order
    of the other columns, so reruns keep the same row (A13). Each task drops
    the copies it sees before its rows move."""
    return first_of(df, key, survivor_order)


def dedup_in_ranges(df: DataFrame, key: Sequence[str], survivor_order: Sequence[str]) -> DataFrame:
    """:func:`dedup` of a staged table that also deals its rows by ranges of
    the key, all in one shuffle: a table laid out by a leading part of the key
    can be written from it as it is. ``df`` is read once more for the bounds.

    Copies of a key that has more than :data:`OFTEN` of the rows would meet in
    one task, so those keys are reduced to a row each before. Which other keys
    are among them makes no difference.
    """
    place = F.xxhash64(*key)
    often = df.select(place.alias("_key")).stat.freqItems(["_key"], OFTEN).first()[0] or []
    common = place.isin(often)
    thin = df.where(~common).unionByName(first_of(df.where(common), key, survivor_order))
    return first_of(thin.repartitionByRange(*[F.col(c).asc_nulls_first() for c in key]), key, survivor_order)
