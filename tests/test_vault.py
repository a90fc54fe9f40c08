from decimal import Decimal

from pyspark.sql import functions as F

from medallion.operators.changes import change_rejects
from medallion.plans import vault as V
from medallion.plans.order_value import order_value_live, order_value_versions
from medallion.streaming.cdc import land_changes
from tests.cdc_fixture import T0, Log, order, product, shop_scenario


def build(spark, products_log, orders_log):
    pb = land_changes(products_log.frame(spark), "products")
    ob = land_changes(orders_log.frame(spark), "orders")
    return pb, ob, V.build_vault(pb, ob)


def _key(t):
    return tuple((0, 0) if v is None else (1, v) for v in t)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)


def test_scenario_counts(spark):
    _, _, vault = build(spark, *shop_scenario())
    counts = {k: v.count() for k, v in vault.items()}
    assert counts == {
        "hub_product": 6, "hub_customer": 3, "hub_order": 3,
        "link_order": 3, "sat_product": 7, "sat_order": 5,
    }


def test_scenario_satellites(spark):
    _, _, vault = build(spark, *shop_scenario())
    sat_order = rows(vault["sat_order"].join(vault["hub_order"], "hk_order"), "order_id", "order_status", "dv_is_deleted")
    assert sat_order == [
        (1, "placed", False), (2, "paid", False), (2, "placed", False), (3, None, True), (3, "placed", False),
    ]
    wok = vault["sat_product"].join(vault["hub_product"], "hk_product").where(F.col("product_id") == 1)
    assert rows(wok, "stock_quantity", "unit_price") == [(38, Decimal("8.50")), (40, Decimal("8.50"))]


def test_tombstone_and_partial_delete_keys(spark):
    pb, ob, vault = build(spark, *shop_scenario())
    assert ob.where(F.col("op").isNull()).count() == 1
    assert vault["hub_customer"].where(F.col("customer_name").isNull()).count() == 0
    assert vault["link_order"].where(F.col("hk_product").isNull()).count() == 0
    assert sorted(r[0] for r in vault["hub_customer"].select("customer_name").collect()) == [
        "Mr. Bunthoeun", "Mr. Sovann", "Ms. Chanthy"]


def test_load_dts_is_source_commit_time(spark):
    _, _, vault = build(spark, *shop_scenario())
    first = vault["hub_order"].where(F.col("order_id") == 2).first()
    assert first["load_dts"].timestamp() * 1000 == T0 + 60_000 or first["load_dts"].replace(
        tzinfo=__import__("datetime").timezone.utc).timestamp() * 1000 == T0 + 60_000


def _order_value(spark, products_log, orders_log, live=False):
    pb = land_changes(products_log.frame(spark), "products")
    ob = land_changes(orders_log.frame(spark), "orders")
    return (order_value_live if live else order_value_versions)(V.staged_changes(pb, ob))


def test_order_value_scenario(spark):
    got = rows(_order_value(spark, *shop_scenario()), "order_id", "quantity", "unit_price", "order_value_khr")
    assert got == [
        (1, 2, Decimal("8.50"), Decimal("68000.00")),
        (2, 2, Decimal("8.50"), Decimal("68000.00")),
        (2, 2, Decimal("8.50"), Decimal("68000.00")),
        (3, 1, Decimal("15.00"), Decimal("60000.00")),
    ]
    assert rows(_order_value(spark, *shop_scenario(), live=True), "order_id") == [(1,), (2,)]


def test_equal_times_are_settled_by_the_log_position(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    for lsn, price in ((10, "8.50"), (20, "9.50"), (20, "7.50")):
        products.event("u", 1, after=product(1, "wok", "Cookware", price, 5), lsn=lsn, ts=T0)
    orders.event("c", 7, after=order(7, "c", 1, 1, "placed", T0), lsn=30, ts=T0)
    orders.event("u", 7, after=order(7, "c", 1, 2, "paid", T0), lsn=30, ts=T0)
    assert rows(_order_value(spark, products, orders), "quantity", "unit_price") == [(1, Decimal("7.50")), (2, Decimal("7.50"))]
    assert rows(_order_value(spark, products, orders, live=True), "quantity") == [(2,)]


def test_quoted_numbers_and_long_decimals_decode(spark):
    import base64
    import json

    products, orders = Log("p", "product_id"), Log("o", "order_id")
    for i, pid in enumerate(["12", 13, " 14 "]):
        after = product(pid, "wok", "Cookware", "8.50", "5")
        after["unit_price"] = base64.b64encode((1250).to_bytes(2 + 7 * i, "big", signed=True)).decode()
        products.event("c", pid, after=after, lsn=10 + i, ts=T0)
    for i, (field, value) in enumerate([("unit_price", "!bad!"), ("unit_price", base64.b64encode(bytes([1] * 9)).decode()),
                                        ("product_id", "x1"), ("stock_quantity", "many"), ("unit_price", "")]):
        products.event("c", 20 + i, after={**product(20 + i, "wok", "Cookware", "1.00", 5), field: value}, lsn=30 + i, ts=T0)
    bronze = land_changes(products.frame(spark), "products")
    assert rows(V.decoded(bronze, "products"), "product_id", "unit_price", "stock_quantity") == [
        (i, Decimal("12.50"), 5) for i in (12, 13, 14)]
    assert V.decoded(bronze, "products").select("hk_product").distinct().count() == 3
    rejects = change_rejects(bronze, V.PRODUCTS).orderBy("lsn").collect()
    assert [r.reject_reasons for r in rejects] == [
        "unit_price: not a valid decimal(10,2)", "unit_price: not a valid decimal(10,2)", "product_id: not a valid int",
        "stock_quantity: not a valid int", "unit_price: not a valid decimal(10,2)"]
    assert json.loads(rejects[0].payload)["after"]["unit_price"] == "!bad!"


def test_price_a_b_a_gives_three_versions_and_asof_picks_each(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    for i, price in enumerate(["8.50", "9.00", "8.50"]):
        products.event("u", 1, after=product(1, "wok", "Cookware", price, 5), lsn=10 * (i + 1), ts=T0 + i * 1000)
    for i, at in enumerate([T0 - 1, T0, T0 + 1500, T0 + 2000, T0 + 9999]):
        orders.event("c", 100 + i, after=order(100 + i, "c", 1, 1, "placed", at), lsn=100 + i, ts=at)
    _, _, vault = build(spark, products, orders)
    assert vault["sat_product"].count() == 3
    got = rows(_order_value(spark, products, orders), "order_id", "unit_price")
    # the order before every version drops out; equal times match the version
    assert got == [(101, Decimal("8.50")), (102, Decimal("9.00")), (103, Decimal("8.50")), (104, Decimal("8.50"))]


def test_deleted_product_prices_null(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    products.event("c", 1, after=product(1, "wok", "Cookware", "8.50", 5), lsn=10, ts=T0)
    products.event("d", 1, before={"product_id": 1}, lsn=20, ts=T0 + 10)
    orders.event("c", 7, after=order(7, "c", 1, 3, "placed", T0 + 20), lsn=30, ts=T0 + 20)
    got = rows(_order_value(spark, products, orders), "order_id", "unit_price", "order_value_khr")
    assert got == [(7, None, None)]


def test_tombstones_damaged_and_live_events(spark):
    products, _ = Log("p", "product_id"), Log("o", "order_id")
    good = product(1, "wok", "Cookware", "8.50", 5)
    products.event("c", 1, after=good, lsn=10, ts=T0)
    products.event("d", 1, before={"product_id": 1}, lsn=11, ts=T0 + 1)
    products.tombstone(1, T0 + 1)
    products.event(None, 2, raw='{"payload": {"op": "u", "after": {"product_id": 1')
    products.event(None, 3, raw='{"payload": {"after": {"product_id": 1}}}')
    products.event("u", 4, after=good, lsn="x9", ts=T0)
    products.event("u", 5, after={**good, "product_id": "many"}, lsn="x9", tx=1)
    products.rows[-1] = (*products.rows[-1][:1], products.rows[-1][1].replace(b'"ts_ms": null', b'"ts_ms": "zz"'), *products.rows[-1][2:])
    pb = land_changes(products.frame(spark), "products")
    assert sorted(r.lsn for r in V.decoded(pb, "products").collect()) == [10, 11]
    rejects = {r.offset: r.reject_reasons for r in change_rejects(pb, V.PRODUCTS).collect()}
    assert rejects == {
        3: "event: not a change envelope", 4: "event: not a change envelope", 5: "lsn: not a valid bigint",
        6: "product_id: not a valid int; lsn: not a valid bigint; ts_ms: not a valid bigint",
    }


def test_one_pass_gives_the_tables_that_each_log_gives(spark):
    products, orders = shop_scenario()
    orders.event("c", 90, after=order(90, None, 1, 1, "placed", T0), lsn=900, ts=T0)  # names an order and a product, no customer
    orders.event("u", 90, after=order(90, " mr. sovann ", None, 1, "paid", T0), lsn=901, ts=T0)
    orders.event("u", 90, after=order(90, "Mr. Sovann", 77, 1, "paid", T0), lsn=902, ts=T0)  # the link's first whole event
    orders.event("u", 90, after=order(90, "Mr. Sovann", 78, 1, "paid", T0), lsn=902, ts=T0)
    orders.event("c", None, after=order(None, "Ms. New", 3, 1, "placed", T0), lsn=5, ts=T0)
    pb, ob = (land_changes(log.frame(spark), n) for n, log in (("products", products), ("orders", orders)))
    staged = V.staged_changes(pb, ob)
    together, apart = V.vault_tables(staged, V.staged_firsts(staged)), V.vault_tables(staged)
    for name, df in apart.items():
        assert together[name].columns == df.columns and together[name].dtypes == df.dtypes
        assert rows(together[name], *df.columns) == rows(df, *df.columns), name
    assert rows(together["link_order"].join(together["hub_product"], "hk_product"), "product_id")[-1] == (77,)
    nothing = {n: df.where("false") for n, df in staged.items()}
    assert {n: df.count() for n, df in V.vault_tables(nothing, V.staged_firsts(nothing)).items()} == dict.fromkeys(V.TABLES, 0)


def test_malformed_event_is_dropped(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    products.event("c", 1, after=product(1, "wok", "Cookware", "8.50", 5), lsn=10, ts=T0)
    products.event(None, 1, raw='{"payload": {"op": "u", "after": {"product_id": 1')
    pb = land_changes(products.frame(spark), "products")
    assert V.decoded(pb, "products").count() == 1


def test_reinsert_after_delete_adds_versions_keeps_one_hub_row(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    products.event("c", 1, after=product(1, "wok", "Cookware", "8.50", 5), lsn=10, ts=T0)
    products.event("d", 1, before={"product_id": 1}, lsn=20, ts=T0 + 10)
    products.event("c", 1, after=product(1, "wok", "Cookware", "8.50", 5), lsn=30, ts=T0 + 20)
    _, _, vault = build(spark, products, orders)
    assert vault["hub_product"].count() == 1
    assert rows(vault["sat_product"], "dv_is_deleted", "unit_price") == [
        (False, Decimal("8.50")), (False, Decimal("8.50")), (True, None)]


def test_same_lsn_snapshot_rows_order_by_offset(spark):
    products, orders = Log("p", "product_id"), Log("o", "order_id")
    products.event("r", 1, after=product(1, "wok", "Cookware", "8.50", 5), lsn=10, ts=T0)
    products.event("u", 1, after=product(1, "wok", "Cookware", "9.00", 5), lsn=10, ts=T0)
    _, _, vault = build(spark, products, orders)
    sat = rows(vault["sat_product"], "unit_price")
    assert sat == [(Decimal("8.50"),), (Decimal("9.00"),)]


def test_decoded_times_do_not_depend_on_session_zone(spark):
    import datetime as dt

    zone = spark.conf.get("spark.sql.session.timeZone")
    products, orders = shop_scenario()
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        o = V.decoded(land_changes(orders.frame(spark), "orders"), "orders")
        got = {(r["order_id"], r["lsn"]): (r["load_dts"], r["ordered_at"]) for r in o.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    utc = dt.datetime.fromtimestamp((T0 + 60_000) / 1000, dt.timezone.utc).replace(tzinfo=None)
    assert got[(2, 200)] == (utc, utc)
