"""Command-line entry points for the jobs (``spark-submit -m``-style use).

    python -m medallion.cli bronze-prices --csv PATH --root ROOT
    python -m medallion.cli silver-prices --root ROOT [--bronze bronze.food_prices]
    python -m medallion.cli stream-changes \\
        --spec table=products,topic=shop.public.products,target=PATH,checkpoint=PATH[,source=PATH] \\
        [--spec ...] [--format kafka] [--option kafka.bootstrap.servers=HOST:9092] [--available-now]
    python -m medallion.cli vault --products PATH --orders PATH --root ROOT
    python -m medallion.cli order-value --root ROOT --out PATH [--namespace silver]

The master and cluster settings come from ``spark-submit``; ``ROOT`` is the
lake folder on shared storage, and each step reads the tables that the steps
before committed there, also in another process. Counters are printed as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from medallion.plans import jobs
from medallion.session import build_session
from medallion.sources.tables import read_table
from medallion.streaming.cdc import ChangeStreamSpec, await_all, start_change_streams


def _json(obj) -> str:
    return json.dumps(obj, default=str)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="medallion")
    sub = p.add_subparsers(dest="command", required=True)

    b = sub.add_parser("bronze-prices", help="land a price CSV as typed Bronze")
    b.add_argument("--csv", required=True)
    b.add_argument("--root", required=True)
    b.add_argument("--table", default="bronze.food_prices")

    s = sub.add_parser("silver-prices", help="refine Bronze prices into Silver + quarantine")
    s.add_argument("--root", required=True)
    s.add_argument("--bronze", default="bronze.food_prices")
    s.add_argument("--table", default="silver.food_prices")
    s.add_argument("--rejects", default="silver.food_prices_rejects")

    c = sub.add_parser("stream-changes", help="land change streams, one query per table")
    c.add_argument("--spec", action="append", required=True,
                   help="table=NAME,topic=TOPIC,target=PATH,checkpoint=PATH[,source=PATH][,sink_table=NAME]")
    c.add_argument("--format", default="kafka")
    c.add_argument("--option", action="append", default=[], help="key=value source option")
    c.add_argument("--available-now", action="store_true")

    v = sub.add_parser("vault", help="replay both Bronze change logs into the vault")
    v.add_argument("--products", required=True, help="Bronze products change log (path or table)")
    v.add_argument("--orders", required=True)
    v.add_argument("--root", required=True)
    v.add_argument("--namespace", default="silver")

    o = sub.add_parser("order-value", help="order value at the price current when placed")
    o.add_argument("--root", required=True)
    o.add_argument("--namespace", default="silver")
    o.add_argument("--out", required=True)
    return p


def _stream_spec(raw: str) -> ChangeStreamSpec:
    """``key=value`` pairs separated by commas (paths may contain ``:``)."""
    f = dict(part.split("=", 1) for part in raw.split(","))
    return ChangeStreamSpec(
        source_table=f["table"], topic=f["topic"], target_path=f.get("target"),
        checkpoint=f["checkpoint"], source_path=f.get("source"), target_table=f.get("sink_table"),
    )


def _load(spark: SparkSession, ref: str, root: str):
    """A folder of files, or the committed version of a table under ``root``."""
    return spark.read.parquet(ref) if "/" in ref else read_table(spark, root, ref)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or build_session(app_name=f"medallion-{args.command}")
    if args.command == "bronze-prices":
        out = jobs.bronze_price_job(spark, args.csv, args.root, args.table)
    elif args.command == "silver-prices":
        out = jobs.silver_price_job(spark, _load(spark, args.bronze, args.root), args.root, args.table, args.rejects)
    elif args.command == "stream-changes":
        specs = [_stream_spec(raw) for raw in args.spec]
        options = dict(o.split("=", 1) for o in args.option)
        queries = start_change_streams(spark, specs, source_format=args.format, options=options,
                                       available_now=args.available_now)
        out = {"queries": await_all(spark, queries, stop_rest=not args.available_now)}
    elif args.command == "vault":
        logs = [_load(spark, ref, args.root) for ref in (args.products, args.orders)]
        out = jobs.vault_job(spark, *logs, args.root, args.namespace)
    else:
        df = jobs.order_value_report(spark, args.root, args.namespace)
        df.write.mode("errorifexists").parquet(args.out)
        out = {"out": args.out}
    print(_json(out))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
