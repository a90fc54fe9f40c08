import json
import os
import subprocess
import sys

import pytest

from medallion import cli
from medallion.plans import food, shop
from medallion.sources.tables import read_table
from medallion.session import NoSharedFolderError, checkpoint_root, one_machine
from tests.conftest import SF_SMALL


def start(*args, cwd):
    """One step in a process of its own."""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    env["PYSPARK_SUBMIT_ARGS"] = "--master local[2] --conf spark.sql.shuffle.partitions=4 pyspark-shell"
    command = [sys.executable, "-m", "medallion.cli", *args]
    return subprocess.Popen(command, cwd=cwd, env=env, stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True)


def ended(process):
    out, err = process.communicate(timeout=240)
    assert process.returncode == 0, err[-3000:]
    return json.loads(out.strip().splitlines()[-1])


def test_another_process_reads_what_a_step_published(spark, tmp_root):
    csv = food.landed_csv(spark, SF_SMALL)
    lake = f"{tmp_root}/lake"
    b = cli.main(["bronze-prices", "--csv", csv, "--root", lake], spark)
    for name, df in shop.bronze_changes(spark, SF_SMALL).items():
        df.write.parquet(f"{tmp_root}/bronze/{name}")
    v = cli.main(["vault", "--products", f"{tmp_root}/bronze/products", "--orders", f"{tmp_root}/bronze/orders", "--root", lake], spark)
    assert v["sat_product"]["rows"] > 0
    silver = start("silver-prices", "--root", lake, cwd=tmp_root)
    value = start("order-value", "--root", lake, "--out", f"{tmp_root}/order_value", cwd=tmp_root)
    s = ended(silver)
    ended(value)
    assert s["bronze_rows"] == b["rows"]
    assert s["silver_rows"] + s["rows_quarantined"] + s["duplicates_removed"] == b["rows"]
    assert read_table(spark, lake, "silver.food_prices").count() == s["silver_rows"]
    assert spark.read.parquet(f"{tmp_root}/order_value").count() == shop.order_value_versions_query(spark, SF_SMALL).count()


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        conf = Conf
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getConf": staticmethod(lambda: Conf)})

    with pytest.raises(NoSharedFolderError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)
    assert checkpoint_root(Session, "s3a://lake/work/") == "s3a://lake/work"
    assert one_machine("local[8]") and not one_machine("local-cluster[3,2,1024]")


def test_stream_spec_accepts_uri_paths():
    spec = cli._stream_spec(
        "table=orders,topic=shop.public.orders,target=s3a://lake/bronze/orders,checkpoint=s3a://lake/ckpt/orders")
    assert (spec.source_table, spec.topic, spec.target_path, spec.checkpoint) == (
        "orders", "shop.public.orders", "s3a://lake/bronze/orders", "s3a://lake/ckpt/orders")
    assert spec.source_path is None and spec.target_table is None


def test_cli_stream_changes_from_files(spark, tmp_root):
    from tests.cdc_fixture import shop_scenario

    products, _ = shop_scenario()
    spark.createDataFrame(products.rows, products.frame(spark).schema).write.parquet(f"{tmp_root}/in/p")
    spec = f"table=products,topic=shop.public.products,target={tmp_root}/bronze/p,checkpoint={tmp_root}/ckpt/p,source={tmp_root}/in/p"
    cli.main(["stream-changes", "--spec", spec, "--format", "parquet", "--available-now"], spark)
    assert spark.read.parquet(f"{tmp_root}/bronze/p").count() == len(products.rows)
