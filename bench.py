"""Benchmark of the headline pipeline stages.

Bronze inputs (price text rows, both change logs, message files) are first
materialized as Parquet in the shared work folder, as they would exist in a
real lake; then each stage is timed end to end with all output columns
evaluated (``noop`` sink): one warm-up, median of ``BENCH_RUNS`` (default 5) runs.

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from medallion.plans import prices as P  # noqa: E402
from medallion.plans import vault as V  # noqa: E402
from medallion.plans.order_value import order_value_versions  # noqa: E402
from medallion.session import build_session, work_path  # noqa: E402
from medallion.sources.delimited import read_delimited, write_delimited  # noqa: E402
from medallion.sources.testdata import PRICE_COLUMNS, change_messages, price_rows  # noqa: E402
from medallion.streaming.cdc import ChangeStreamSpec, land_changes, run_to_completion  # noqa: E402


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        app_name="medallion-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
        extra={"spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = work_path(spark, "bench")

    # --- untimed: land the Bronze inputs -----------------------------------
    # A lake table is many files; land each input as 2 files per core so the
    # scans are not limited by the single-file test tables.
    files = int(cpus) * 2
    price_rows(spark, sf_dir).repartition(files).write.parquet(f"{root}/price_text")
    write_delimited(price_rows(spark, sf_dir).repartition(files), f"{root}/price_csv")
    msgs = change_messages(spark, sf_dir)
    for name, m in msgs.items():
        m.repartition(files).write.parquet(f"{root}/messages/{name}")
        land_changes(spark.read.parquet(f"{root}/messages/{name}"), name).write.parquet(f"{root}/bronze/{name}")

    text = P.as_bronze_text(spark.read.parquet(f"{root}/price_text"))
    bronze = {n: spark.read.parquet(f"{root}/bronze/{n}") for n in ("products", "orders")}
    stream_runs = [0]

    def stream_landing() -> None:
        stream_runs[0] += 1
        out = f"{root}/stream/{stream_runs[0]}"
        specs = [
            ChangeStreamSpec(n, f"shop.public.{n}", f"{out}/bronze/{n}", f"{out}/ckpt/{n}", f"{root}/messages/{n}")
            for n in ("products", "orders")
        ]
        run_to_completion(spark, specs, source_format="parquet")

    staged = {}

    def envelope_decode() -> None:
        staged.update(V.staged_changes(bronze["products"], bronze["orders"]))

    def vault_replay() -> None:
        for df in V.vault_tables(staged, V.staged_firsts(staged)).values():
            noop(df)

    def order_value() -> None:
        noop(order_value_versions(staged))

    stages = {
        "bronze_prices_csv": lambda: noop(P.bronze_prices(read_delimited(spark, f"{root}/price_csv", PRICE_COLUMNS))),
        "silver_prices": lambda: noop(P.silver_prices(text)),
        "price_rejects": lambda: noop(P.rejects(text)),
        "envelope_decode": envelope_decode,
        "vault_replay": vault_replay,
        "order_value_asof": order_value,
        "stream_landing": stream_landing,
    }
    results = {}
    for name, fn in stages.items():
        fn()  # warm-up
        times = []
        for _ in range(runs):
            t = time.perf_counter()
            fn()
            times.append(time.perf_counter() - t)
        results[name] = round(statistics.median(times), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "pipeline_total_sec",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
