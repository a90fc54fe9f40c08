import os

from medallion.plans import food, jobs, shop
from medallion.plans import prices as P
from medallion.session import checkpoint_root
from medallion.sources.tables import load_history, read_table
from tests.conftest import SF_SMALL


def test_price_jobs_end_to_end(spark, tmp_root):
    csv = food.landed_csv(spark, SF_SMALL)
    b = jobs.bronze_price_job(spark, csv, tmp_root)
    bronze = spark.table("bronze.food_prices")
    assert b["rows"] == bronze.count() and b["unparseable_dates"] > 0
    lost = read_table(spark, tmp_root, "bronze.food_prices_rejects")
    assert b["rejects"]["rows"] == lost.count() > 0 and {r[0] for r in lost.select("reject_reasons").distinct().collect()} == {
        "row: not 16 fields", "header: lacks usdprice",
    }
    assert len(b["preview"]) == 5 and b["first_load"] == b["last_load"]
    s = jobs.silver_price_job(spark, P.as_bronze_text(food.price_rows(spark, SF_SMALL)), tmp_root)
    audit = P.dedup_audit(P.as_bronze_text(food.price_rows(spark, SF_SMALL))).first()
    assert s["bronze_rows"] == audit["bronze_rows"]
    assert s["rows_quarantined"] == audit["rows_quarantined"] == s["rejects"]["rows"]
    assert s["silver_rows"] == audit["silver_rows"] == spark.table("silver.food_prices").count()
    assert s["duplicates_removed"] == audit["duplicates_removed"]
    assert load_history(spark, tmp_root, "silver.food_prices").count() == 1


def test_vault_job_publishes_six_tables(spark, tmp_root):
    b = shop.bronze_changes(spark, SF_SMALL)
    before = {f for _, folders, _ in os.walk(checkpoint_root(spark)) for f in folders}
    out = jobs.vault_job(spark, b["products"], b["orders"], tmp_root, namespace="vault_t")
    out.pop("op_profile")
    profile = {(r.source_table, r.op): r.events for r in read_table(spark, tmp_root, "vault_t.op_profile").collect()}
    assert {op for name, op in profile if name == "orders"} == {None, "c", "u", "d"}
    apart = {r.op: (r.events, r.transactions) for r in shop.P.op_transactions(b["products"]).collect()}
    published = read_table(spark, tmp_root, "vault_t.op_profile").where("source_table = 'products'").collect()
    assert {r.op: (r.events, r.transactions) for r in published} == apart
    empty = b["products"].where("event IS NULL").count()
    assert profile["products", None] > empty > 0  # a tombstone per delete, and events that are cut
    left = {f for _, folders, _ in os.walk(checkpoint_root(spark)) for f in folders} - before
    assert not [f for f in left if f.startswith(("ordered-", "firsts-"))]
    expected = {k: v.count() for k, v in shop.V.build_vault(b["products"], b["orders"]).items()}
    assert {k: v["rows"] for k, v in out.items()} == expected
    assert spark.table("vault_t.sat_product").count() == expected["sat_product"]
