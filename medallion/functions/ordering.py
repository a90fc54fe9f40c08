"""Deterministic change-event order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source commit order first, then commit time and transport position; the
# record source breaks ties between two logs replayed together.
EVENT_ORDER = ("lsn", "source_ts_ms", "offset", "record_source")


def event_order(columns=EVENT_ORDER) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in columns]
