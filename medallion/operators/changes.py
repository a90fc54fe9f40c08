"""Decoding of Bronze change-log rows into typed change rows.

The payload text is parsed once per row with ``from_json`` into a struct of
texts, and each text is then decoded to its declared type, so a number that
was sent quoted reads like one that was not. Business keys come from the
``after`` image, or for deletes from ``before``; attributes come from
``after`` only, so a delete carries nulls.

A row is one of three: a tombstone (no event), a damaged event (an event
without an ``op``, such as a cut envelope), or a live one. Damaged events are
rejects, and so are live ones with a value that is present but does not
decode, positions in the log included; it never turns into a null in passing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions.connect_decimal import decode_connect_decimal
from medallion.functions.keys import business_key

DELETE_OP = "d"
REASONS = "reject_reasons"
DAMAGED = "event: not a change envelope"
#: log columns, the name of their field in the envelope's source, and their type
POSITIONS = {"lsn": "lsn", "source_ts_ms": "ts_ms"}
_EPOCH = "1970-01-01 00:00:00"


def utc_wall_clock(count: Column, unit: str) -> Column:
    """Epoch ``unit``s → timestamp_ntz holding the UTC wall clock, without
    passing through the session time zone."""
    return F.timestamp_add(unit, count, F.lit(_EPOCH).cast("timestamp_ntz"))


def computed_once(value: Column) -> Column:
    """``value``, generated as a row of one: the optimizer copies what a
    projection computes into every filter above that reads it, but moves no
    filter below a generator. A select list holds one of these at most."""
    return F.explode(F.array(value))


@dataclass(frozen=True)
class Field:
    """A row field of a change image.

    kind: ``plain`` (JSON scalar read as ``dtype``), ``decimal`` (Connect
    Decimal text), ``timestamp`` (ISO-8601 text, returned as timestamp_ntz).
    """

    name: str
    dtype: str = "string"
    kind: str = "plain"
    precision: int = 10
    scale: int = 2

    @property
    def wanted(self) -> str:
        return {"decimal": f"decimal({self.precision},{self.scale})", "timestamp": "timestamp"}.get(self.kind, self.dtype)

    def decode(self, raw: Column) -> Column:
        if self.kind == "decimal":
            return decode_connect_decimal(raw, self.precision, self.scale)
        if self.kind == "timestamp":
            return utc_wall_clock(F.unix_micros(raw.try_cast("timestamp")), "MICROSECOND")
        return raw if self.dtype == "string" else raw.try_cast(self.dtype)


@dataclass(frozen=True)
class ChangeSpec:
    """How to decode one source table's change log.

    ``keys`` maps a hash-key column to the business-key field it hashes;
    ``attributes`` are read from the after image only.
    """

    record_source: str
    fields: tuple[Field, ...]
    keys: dict[str, str] = field(default_factory=dict)
    attributes: tuple[str, ...] = ()

    def payload_schema(self) -> T.StructType:
        image = T.StructType([T.StructField(f.name, T.StringType()) for f in self.fields])
        source = T.StructType([T.StructField(name, T.StringType()) for name in POSITIONS.values()])
        return T.StructType([T.StructField("before", image), T.StructField("after", image), T.StructField("source", source)])

    @property
    def key_fields(self) -> list[str]:
        return [f.name for f in self.fields if f.name in self.keys.values()]


def classified(bronze: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Events with ``raw`` and ``value``, the texts and decoded values of the
    keys and attributes, and ``at``, the texts of the positions, beside the
    log's own columns that decoding needs."""
    by_name = {f.name: f for f in spec.fields}
    parsed = bronze.select(
        "op", *POSITIONS, "offset", "payload", computed_once(F.from_json("payload", spec.payload_schema())).alias("image")
    ).withColumn("at", F.col("image.source"))
    texts = {n: F.col(f"image.after.{n}") for n in spec.attributes}
    texts |= {n: F.coalesce(F.col(f"image.after.{n}"), F.col(f"image.before.{n}")) for n in spec.key_fields}
    raw = parsed.withColumn("raw", F.struct(*[c.alias(n) for n, c in texts.items()])).drop("image")
    return raw.withColumn("value", F.struct(*[by_name[n].decode(F.col(f"raw.{n}")).alias(n) for n in texts]))


def _lost(name: str) -> Column:
    return F.col(f"raw.{name}").isNotNull() & F.col(f"value.{name}").isNull()


def _checked(spec: ChangeSpec) -> list[Field]:
    names = [*spec.attributes, *spec.key_fields]
    return [f for f in spec.fields if f.name in names and (f.kind != "plain" or f.dtype != "string")]


def _lost_position(column: str) -> Column:
    return F.col(f"at.{POSITIONS[column]}").isNotNull() & F.col(column).isNull()


def decode_changes(bronze: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Typed change rows of the live events: hash keys, business keys, attributes, delete flag,
    source ordering columns, ``load_dts`` and ``record_source``. Rows that
    :func:`change_rejects` lists are not among them."""
    whole = classified(bronze.where(F.col("op").isNotNull()), spec)
    for against in [*[_lost(f.name) for f in _checked(spec)], *[_lost_position(c) for c in POSITIONS]]:
        whole = whole.where(~against)
    keys = [business_key(F.col(f"value.{name}")).alias(hk) for hk, name in spec.keys.items()]
    return whole.select(
        *keys,
        *[F.col(f"value.{n}").alias(n) for n in [*spec.key_fields, *spec.attributes]],
        (F.col("op") == DELETE_OP).alias("dv_is_deleted"),
        "lsn", "source_ts_ms", "offset",
        utc_wall_clock(F.col("source_ts_ms"), "MILLISECOND").alias("load_dts"),
        F.lit(spec.record_source).alias("record_source"),
    )


def change_rejects(bronze: DataFrame, spec: ChangeSpec) -> DataFrame:
    """Damaged events, and events with a value that is present and does not
    decode: the log position, the payload as it came (of a damaged event, the
    whole of it) and the reasons, those of fields first."""
    reasons = [F.when(F.col("op").isNull(), F.lit(DAMAGED))]
    reasons += [F.when(_lost(f.name), F.lit(f"{f.name}: not a valid {f.wanted}")) for f in _checked(spec)]
    reasons += [F.when(_lost_position(c), F.lit(f"{name}: not a valid bigint")) for c, name in POSITIONS.items()]
    events = bronze.where(F.col("event").isNotNull()).withColumn("payload", F.coalesce("payload", "event"))
    return (
        classified(events, spec)
        .select(
            F.lit(spec.record_source).alias("record_source"), "op", "lsn", "source_ts_ms", "offset", "payload",
            F.concat_ws("; ", *reasons).alias(REASONS),
        )
        .where(F.col(REASONS) != "")
    )
