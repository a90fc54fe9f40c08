"""As-of (point-in-time) join.

For each left row: the right row with the same ``by`` key and the greatest
``right_on <= left_on``; among right rows with equal ``right_on`` the one
with the greatest ``tiebreak`` wins, so at most one row matches. Inner joins
drop left rows without a match; left joins keep them with null right
columns. Null keys and null times never match.

Left and right rows are put together in order of key and time, right rows
first at equal times, in row-balanced segments (:mod:`.segments`). A left
row's match is the last right row before it in its segment, or else the
segment's carry: the last right row of the segments before, if it is of the
same key. That is one sort of the rows, never a nested-loop join or a
per-key cross product, and a hot key takes several segments.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medallion.operators.segments import BUCKET, stage_ordered, with_carry

_RIGHT, _LEFT = 0, 1


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str | Sequence[str],
    left_on: str,
    right_on: str,
    tiebreak: Sequence[str] = (),
    how: str = "inner",
    folder: str | None = None,
) -> DataFrame:
    """Point-in-time join; output is the left columns, then the right columns
    except ``by``. Writes one table to the shared folder (or ``folder``)."""
    by = [by] if isinstance(by, str) else list(by)
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    right_cols = [c for c in right.columns if c not in by]
    clash = set(right_cols) & set(left.columns)
    if clash:
        raise ValueError(f"right columns also on the left: {sorted(clash)}")

    keys = [f"_k{i}" for i in range(len(by))]
    time_type = right.schema[right_on].dataType
    ties = F.struct(*[F.col(c) for c in tiebreak]) if tiebreak else F.struct(F.lit(0).alias("none"))

    def usable(on: str):
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, on]])

    lrows = left.where(usable(left_on)).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(left_on).cast(time_type).alias("_t"),
        F.lit(_LEFT).alias("_kind"), F.struct(*left.columns).alias("_l"),
    )
    rrows = right.where(usable(right_on)).select(
        *[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(right_on).alias("_t"),
        F.lit(_RIGHT).alias("_kind"), ties.alias("_tb"), F.struct(*right_cols).alias("_r"),
    )
    both = lrows.unionByName(rrows, allowMissingColumns=True)
    order = ["_t", "_kind", "_tb"]
    staged = stage_ordered(both, keys, order, "asof", folder)
    last_right = F.max_by(
        F.when(F.col("_kind") == _RIGHT, F.struct(F.struct(*keys).alias("key"), F.col("_r").alias("row"))),
        F.when(F.col("_kind") == _RIGHT, F.struct(*keys, *order)),
    )
    joined = with_carry(staged, last_right)
    inside = (
        Window.partitionBy(BUCKET, *keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    from_before = F.when(F.col("_carry.key") == F.struct(*keys), F.col("_carry.row"))
    match = F.coalesce(F.last("_r", ignorenulls=True).over(inside), from_before)
    out = joined.withColumn("_m", match).where(F.col("_kind") == _LEFT)
    if how == "inner":
        out = out.where(F.col("_m").isNotNull())
    named = out.select("_l.*", *[F.col(f"_m.{c}").alias(c) for c in right_cols])
    if how == "left":  # rows that cannot match never meet in one partition
        named = named.unionByName(left.where(~F.coalesce(usable(left_on), F.lit(False))), allowMissingColumns=True)
    return named
