"""What did each order cost at the price current when it was placed (V7).

Order versions join the order hub and the link on the order's hash key, and
the product satellite as of the order time. Order versions that are deletes
are skipped (C17); the value is quantity × unit price × riel per dollar (A15).

Equal times are settled by the log position, so at most one price matches;
published satellites no longer carry it and settle by the hashdiff.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.ordering import EVENT_ORDER
from medallion.operators.asof import asof_join
from medallion.operators.history import latest
from medallion.plans import vault as V

# Fixed value: riel per dollar.
KHR_PER_USD = 4000
VALUE_TYPE = "decimal(18,2)"
LOG_TIES = tuple(c for c in EVENT_ORDER if c != "record_source")
PUBLISHED_TIES = ("hashdiff",)


def order_value(
    order_versions: DataFrame, hub_order: DataFrame, link_order: DataFrame, product_versions: DataFrame, ties: Sequence[str] = LOG_TIES,
) -> DataFrame:
    """One row per non-delete order version, priced as of the order time."""
    live = order_versions.where(~F.col("dv_is_deleted")).select("hk_order", "quantity", "ordered_at")
    lines = live.join(hub_order.select("hk_order", "order_id"), "hk_order").join(link_order.select("hk_order", "hk_product"), "hk_order")
    prices = product_versions.select(
        "hk_product", F.col("load_dts").alias("_priced_at"), "unit_price", *[F.col(c).alias(f"_tie_{c}") for c in ties]
    )
    priced = asof_join(
        lines, prices, by="hk_product", left_on="ordered_at", right_on="_priced_at", tiebreak=[f"_tie_{c}" for c in ties]
    )
    value = (F.col("quantity") * F.col("unit_price") * F.lit(KHR_PER_USD)).cast(VALUE_TYPE)
    return priced.select("order_id", "quantity", "unit_price", value.alias("order_value_khr"))


def order_value_versions(staged: dict[str, DataFrame]) -> DataFrame:
    """From staged change logs: every order version."""
    return _from_logs(staged, V.satellite_changes(staged, V.SATELLITES["sat_order"]))


def order_value_live(staged: dict[str, DataFrame]) -> DataFrame:
    """From staged change logs: the latest version of each order, unless it is a delete."""
    return _from_logs(staged, latest(V.satellite_changes(staged, V.SATELLITES["sat_order"]), "hk_order"))


def _from_logs(staged: dict[str, DataFrame], order_versions: DataFrame) -> DataFrame:
    return order_value(
        order_versions, V.vault_table(staged, "hub_order"), V.vault_table(staged, "link_order"),
        V.satellite_changes(staged, V.SATELLITES["sat_product"]),
    )


def order_value_published(tables: dict[str, DataFrame]) -> DataFrame:
    """From the published vault tables."""
    return order_value(tables["sat_order"], tables["hub_order"], tables["link_order"], tables["sat_product"], PUBLISHED_TIES)
