"""Per-key history operators over an ordered change log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.functions.ordering import EVENT_ORDER, event_order
from medallion.operators.segments import BUCKET, SEGMENT, with_carry


def first_of(df: DataFrame, key: Sequence[str], order: Sequence[str], descending: bool = False) -> DataFrame:
    """Each key's first row in the order of the columns ``order`` (nulls
    first), or its last one: all columns. Spark limits the numbered rows to
    one a key before the shuffle and again behind it, so a task sends one row
    per key, however many it has, and a row moves once, as it is."""
    ranks = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_first() for c in order]
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*ranks))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def earliest(df: DataFrame, key: str | Sequence[str], columns: Sequence[str], order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """``key`` and ``columns`` of each key's first event (nulls in the order
    come first; events equal in it are told apart by ``columns``)."""
    keys = [key] if isinstance(key, str) else list(key)
    place = dict.fromkeys(c for c in [*order, *columns] if c in df.columns)
    return first_of(df, keys, list(place)).select(*keys, *columns)


def latest(df: DataFrame, key: str, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Each key's last event, all columns."""
    place = [*[c for c in order if c in df.columns], *[c for c in df.columns if c not in order]]
    return first_of(df, [key], place, descending=True)


def change_rows(staged: DataFrame, key: str, hash_col: str, order: Sequence[str] = EVENT_ORDER) -> DataFrame:
    """Events of a log staged by (``key``, ``order``) whose ``hash_col``
    differs from the key's event before (A→B→A gives three rows).

    Inside a segment the event before is the previous row of the key. A key
    that goes on from the segment before finds it in the carry: that
    segment's last row, if it is of the same key.
    """
    rank = F.struct(*[F.col(c) for c in [key, *order, hash_col]])
    joined = with_carry(staged, F.max_by(F.struct(F.col(key).alias("key"), F.col(hash_col).alias("hash")), rank))
    inside = Window.partitionBy(BUCKET, key).orderBy(*event_order(order), F.col(hash_col).asc())
    from_before = F.when(F.col("_carry.key") == F.col(key), F.col("_carry.hash"))
    previous = F.coalesce(F.lag(hash_col).over(inside), from_before)
    return joined.withColumn("_same", F.col(hash_col).eqNullSafe(previous)).where(~F.col("_same")).drop("_same", "_carry", SEGMENT, BUCKET)
