"""Silver Data Vault from the two Bronze change logs (V1-V6, K1-K3).

Hubs, the link and the satellites are declared as specs and built by one
function each. A full replay decodes each log once and stages it in
row-balanced segments; all six tables are functions of the staged logs. A
replay of all tables takes the hubs and the link from one pass over the logs
(:func:`first_seen`); a table of its own reads only the logs it needs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.keys import attribute_hash, business_key
from medallion.functions.ordering import EVENT_ORDER
from medallion.operators.changes import ChangeSpec, Field, decode_changes
from medallion.operators.history import change_rows, earliest
from medallion.operators.segments import stage_ordered
from medallion.session import work_path

# The fields of the two source tables and their key columns.
PRODUCTS = ChangeSpec(
    record_source="shop.products",
    fields=(
        Field("product_id", "int"),
        Field("name"),
        Field("category"),
        Field("unit_price", kind="decimal", precision=10, scale=2),
        Field("stock_quantity", "int"),
    ),
    keys={"hk_product": "product_id"},
    attributes=("name", "category", "unit_price", "stock_quantity"),
)
ORDERS = ChangeSpec(
    record_source="shop.orders",
    fields=(
        Field("order_id", "int"),
        Field("customer_name"),
        Field("product_id", "int"),
        Field("quantity", "int"),
        Field("order_status"),
        Field("ordered_at", kind="timestamp"),
    ),
    keys={"hk_order": "order_id", "hk_customer": "customer_name", "hk_product": "product_id"},
    attributes=("quantity", "order_status", "ordered_at"),
)
LOGS = {"products": PRODUCTS, "orders": ORDERS}
CLUSTER_KEY = {"products": "hk_product", "orders": "hk_order"}


@dataclass(frozen=True)
class Hub:
    """A business entity: its key column, its business key, and the logs that
    name it. Events without the business key don't count."""

    key: str
    business_key: str
    logs: tuple[str, ...]

    @property
    def per(self) -> str:
        return self.key

    @property
    def parts(self) -> tuple[str, ...]:
        return (self.business_key,)

    def columns(self) -> list[str]:
        return [self.business_key, "load_dts", "record_source"]


@dataclass(frozen=True)
class Link:
    """A relationship between hubs, keyed by their business keys together."""

    key: str
    log: str
    per: str
    parts: tuple[str, ...]
    hubs: tuple[str, ...]

    @property
    def logs(self) -> tuple[str, ...]:
        return (self.log,)

    def columns(self) -> list[str]:
        return [*self.parts, *[h for h in self.hubs if h != self.per], "load_dts", "record_source"]


@dataclass(frozen=True)
class Satellite:
    """The attributes of a hub over time."""

    hub: str
    log: str

    @property
    def attributes(self) -> tuple[str, ...]:
        return LOGS[self.log].attributes


# The tables of the vault and their columns.
HUBS = {
    "hub_product": Hub("hk_product", "product_id", ("products", "orders")),
    "hub_customer": Hub("hk_customer", "customer_name", ("orders",)),
    "hub_order": Hub("hk_order", "order_id", ("orders",)),
}
LINKS = {
    "link_order": Link(
        "hk_link_order", "orders", "hk_order", ("order_id", "customer_name", "product_id"), ("hk_order", "hk_customer", "hk_product")
    ),
}
SATELLITES = {"sat_product": Satellite("hk_product", "products"), "sat_order": Satellite("hk_order", "orders")}
TABLES = (*HUBS, *LINKS, *SATELLITES)

# The published types.
SCHEMAS = {
    "hub_product": "hk_product string, product_id int, load_dts timestamp_ntz, record_source string",
    "hub_customer": "hk_customer string, customer_name string, load_dts timestamp_ntz, record_source string",
    "hub_order": "hk_order string, order_id int, load_dts timestamp_ntz, record_source string",
    "link_order": "hk_link_order string, hk_order string, hk_customer string, hk_product string, load_dts timestamp_ntz, "
    "record_source string",
    "sat_product": "hk_product string, load_dts timestamp_ntz, hashdiff string, name string, category string, "
    "unit_price decimal(10,2), stock_quantity int, dv_is_deleted boolean, record_source string",
    "sat_order": "hk_order string, load_dts timestamp_ntz, hashdiff string, quantity int, order_status string, "
    "ordered_at timestamp_ntz, dv_is_deleted boolean, record_source string",
}


def decoded(bronze: DataFrame, log: str) -> DataFrame:
    return decode_changes(bronze, LOGS[log])


def staged_changes(products_bronze: DataFrame, orders_bronze: DataFrame, folder: str | None = None) -> dict[str, DataFrame]:
    """Decode each log once and stage it by hub key and event order: a lost
    executor does not send the job back to the JSON, and a key with many
    events takes several segments and files."""
    logs = {"products": products_bronze, "orders": orders_bronze}
    return {n: staged_log(b, n, folder) for n, b in logs.items()}


def staged_log(bronze: DataFrame, log: str, folder: str | None = None) -> DataFrame:
    return stage_ordered(decoded(bronze, log), [CLUSTER_KEY[log]], EVENT_ORDER, log, folder)


def hub_rows(staged: dict[str, DataFrame], hub: Hub) -> DataFrame:
    """One row per key, from the first event that names the business key."""
    need = [hub.key, hub.business_key, "load_dts", *EVENT_ORDER]
    named = [staged[log].where(F.col(hub.business_key).isNotNull()).select(*need) for log in hub.logs]
    events = named[0]
    for more in named[1:]:
        events = events.unionByName(more)
    return earliest(events, hub.key, hub.columns())


def link_rows(staged: dict[str, DataFrame], link: Link) -> DataFrame:
    """One row per ``link.per``, from its first event with all parts."""
    whole = staged[link.log].dropna(subset=list(link.parts))
    return linked(earliest(whole, link.per, link.columns()), link)


def linked(first: DataFrame, link: Link) -> DataFrame:
    """The first events of a link's keys as rows of the link."""
    return first.select(business_key(*link.parts).alias(link.key), *link.hubs, "load_dts", "record_source")


def first_seen(staged: dict[str, DataFrame], names: Sequence[str] = (*HUBS, *LINKS)) -> DataFrame:
    """The first events of the keys of all named hubs and links, from one scan
    of each log and one shuffle: ``_table``, ``_key``, and the columns of the
    tables, null where a table has no such column.

    An event gives a row to each table whose business keys it has; rows are
    aggregated by table and key before they move, so neither a key with most
    of the events nor the number of tables counts in the shuffle.
    """
    specs = {n: HUBS.get(n) or LINKS[n] for n in names}
    kept = list(dict.fromkeys(c for s in specs.values() for c in s.columns()))
    rows = []
    for log, events in staged.items():
        named_here = {n: s for n, s in specs.items() if log in s.logs}
        if not named_here:
            continue
        entries = [
            F.when(
                reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in s.parts]),
                F.struct(F.lit(n).alias("table"), F.col(s.per).alias("key")),
            )
            for n, s in named_here.items()
        ]
        users = {c: [n for n, s in named_here.items() if c in s.columns()] for c in kept}
        each = events.select(
            *EVENT_ORDER, *[c for c in kept if users[c] and c not in EVENT_ORDER],
            F.explode(F.array_compact(F.array(*entries))).alias("_of"),
        )
        own = [F.when(F.col("_of.table").isin(users[c]), F.col(c)).alias(c) for c in kept if users[c] and c not in EVENT_ORDER]
        rows.append(each.select(F.col("_of.table").alias("_table"), F.col("_of.key").alias("_key"), *EVENT_ORDER, *own))
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return earliest(together, ["_table", "_key"], kept)


def staged_firsts(staged: dict[str, DataFrame], folder: str | None = None) -> DataFrame:
    """:func:`first_seen` of all hubs and links, written with a directory per table."""
    firsts = first_seen(staged)
    path = work_path(firsts.sparkSession, "firsts", folder)
    firsts.write.partitionBy("_table").parquet(path)
    return firsts.sparkSession.read.schema(firsts.schema).parquet(path)


def from_firsts(firsts: DataFrame, name: str) -> DataFrame:
    """A hub or link from :func:`staged_firsts`; reads its own directory."""
    spec = HUBS.get(name) or LINKS[name]
    own = firsts.where(F.col("_table") == name).select(F.col("_key").alias(spec.per), *spec.columns())
    return linked(own, spec) if name in LINKS else own


def satellite_changes(staged: dict[str, DataFrame], satellite: Satellite) -> DataFrame:
    """Change-detected rows, still with their log position (V5)."""
    described = staged[satellite.log].withColumn("hashdiff", attribute_hash(*satellite.attributes, "dv_is_deleted"))
    return change_rows(described, satellite.hub, "hashdiff")


def satellite_rows(staged: dict[str, DataFrame], satellite: Satellite) -> DataFrame:
    columns = [satellite.hub, "load_dts", "hashdiff", *satellite.attributes, "dv_is_deleted", "record_source"]
    return satellite_changes(staged, satellite).select(*columns)


def vault_table(staged: dict[str, DataFrame], name: str) -> DataFrame:
    for specs, build in ((HUBS, hub_rows), (LINKS, link_rows), (SATELLITES, satellite_rows)):
        if name in specs:
            return build(staged, specs[name])
    raise KeyError(name)


def vault_tables(staged: dict[str, DataFrame], firsts: DataFrame | None = None) -> dict[str, DataFrame]:
    """All six tables; hubs and links from ``firsts`` (:func:`staged_firsts`)
    if given, else each from its logs."""
    return {
        name: vault_table(staged, name) if firsts is None or name in SATELLITES else from_firsts(firsts, name) for name in TABLES
    }


def build_vault(products_bronze: DataFrame, orders_bronze: DataFrame) -> dict[str, DataFrame]:
    """Full replay of both logs into the six vault tables (V6)."""
    return vault_tables(staged_changes(products_bronze, orders_bronze))
