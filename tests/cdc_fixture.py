"""Hand-written change messages for unit tests (small literal frames)."""

import base64
import datetime as dt
import json
from decimal import Decimal

from medallion.streaming.cdc import MESSAGE_SCHEMA

T0 = 1_700_000_000_000  # epoch ms


def connect_decimal(value: str, scale: int = 2) -> str:
    unscaled = int(Decimal(value).scaleb(scale))
    n = max(1, (unscaled.bit_length() + 8) // 8)
    return base64.b64encode(unscaled.to_bytes(n, "big", signed=True)).decode()


def iso(ms: int) -> str:
    return dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


class Log:
    """Builds one topic's messages; offsets increase by one per message."""

    def __init__(self, topic: str, key_field: str):
        self.topic, self.key_field, self.rows = topic, key_field, []

    def event(self, op, key, before=None, after=None, lsn=None, tx=None, ts=None, raw=None):
        payload = {"op": op, "before": before, "after": after, "source": {"lsn": lsn, "txId": tx, "ts_ms": ts}}
        value = raw if raw is not None else json.dumps({"payload": payload})
        self._add(key, value, ts)

    def tombstone(self, key, ts):
        self._add(key, None, ts)

    def _add(self, key, value, ts):
        k = json.dumps({"payload": {self.key_field: key}}).encode()
        v = value.encode() if value is not None else None
        t = dt.datetime.fromtimestamp((ts or T0) / 1000, dt.timezone.utc).replace(tzinfo=None)
        self.rows.append((k, v, self.topic, 0, len(self.rows), t))

    def frame(self, spark):
        return spark.createDataFrame(self.rows, MESSAGE_SCHEMA)


def product(pid, name, category, price, stock):
    return {"product_id": pid, "name": name, "category": category,
            "unit_price": connect_decimal(price), "stock_quantity": stock}


def order(oid, customer, pid, qty, status, at_ms):
    return {"order_id": oid, "customer_name": customer, "product_id": pid, "quantity": qty,
            "order_status": status, "ordered_at": iso(at_ms)}


SEED_PRODUCTS = [
    (1, "Aluminum wok, 30cm", "Cookware", "8.50", 40),
    (2, "Stone mortar and pestle", "Cookware", "12.00", 25),
    (3, "Clay charcoal stove", "Cookware", "15.00", 15),
    (4, "Non-stick frying pan, imported", "Cookware", "18.00", 20),
    (5, "Bamboo steamer basket", "Cookware", "6.00", 30),
    (6, "Rice cooker, 1.8L", "Appliance", "22.00", 18),
]


def shop_scenario():
    """Snapshot of six products and one order, then: an order placed and
    paid, a stock decrement, an order placed and deleted (delete + tombstone)."""
    products, orders = Log("shop.public.products", "product_id"), Log("shop.public.orders", "order_id")
    snap = 100
    for p in SEED_PRODUCTS:
        products.event("r", p[0], after=product(*p), lsn=snap, tx=1, ts=T0)
    orders.event("r", 1, after=order(1, "Mr. Bunthoeun", 1, 2, "placed", T0 + 1), lsn=snap, tx=1, ts=T0 + 1)
    orders.event("c", 2, after=order(2, "Ms. Chanthy", 1, 2, "placed", T0 + 60_000), lsn=200, tx=2, ts=T0 + 60_000)
    orders.event("u", 2, after=order(2, "Ms. Chanthy", 1, 2, "paid", T0 + 60_000), lsn=300, tx=3, ts=T0 + 120_000)
    products.event("u", 1, after=product(1, "Aluminum wok, 30cm", "Cookware", "8.50", 38), lsn=400, tx=4, ts=T0 + 180_000)
    orders.event("c", 3, after=order(3, "Mr. Sovann", 3, 1, "placed", T0 + 240_000), lsn=500, tx=5, ts=T0 + 240_000)
    orders.event("d", 3, before={"order_id": 3}, lsn=600, tx=6, ts=T0 + 300_000)
    orders.tombstone(3, T0 + 300_000)
    return products, orders
