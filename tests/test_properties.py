"""Replay properties of the vault on the sf0.001 change logs."""

from pyspark.sql import functions as F

from medallion.plans import shop
from medallion.plans import vault as V
from tests.conftest import SF_SMALL


def snapshot(vault):
    return {name: sorted(tuple(r) for r in df.collect()) for name, df in vault.items()}


def test_replay_is_idempotent_order_free_and_duplicate_safe(spark):
    b = shop.bronze_changes(spark, SF_SMALL)
    base = snapshot(V.build_vault(b["products"], b["orders"]))
    assert snapshot(V.build_vault(b["products"], b["orders"])) == base

    shuffled = {k: v.orderBy(F.rand(7)).repartition(5) for k, v in b.items()}
    assert snapshot(V.build_vault(shuffled["products"], shuffled["orders"])) == base

    doubled = {k: v.unionByName(v) for k, v in b.items()}
    assert snapshot(V.build_vault(doubled["products"], doubled["orders"])) == base
