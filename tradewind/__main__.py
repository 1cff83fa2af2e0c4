"""Command line: ``python -m tradewind silver /data/lake``.

On a cluster: ``spark-submit --py-files tradewind.zip tradewind/__main__.py silver /data/lake``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tradewind.plans.warehouse import SILVER, audit, build_graph, build_silver, sync_prices
from tradewind.sources.files import land, landing_audit, write_table


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tradewind", description="Sales warehouse on Spark")
    steps = parser.add_subparsers(dest="step", required=True)
    landing = steps.add_parser("land", help="raw CSV files to bronze tables")
    landing.add_argument("raw")
    landing.add_argument("lake")
    landing.add_argument("--infer", action="store_true", help="let Spark guess the column types")
    landing.add_argument("--audit", action="store_true", help="count malformed lines, as the table audit/landing")
    silver = steps.add_parser("silver", help="bronze tables to silver tables")
    silver.add_argument("lake")
    silver.add_argument("--tables", nargs="+", choices=SILVER, default=SILVER)
    silver.add_argument("--unmapped-years", choices=("drop", "keep"), default="drop")
    silver.add_argument("--audit", action="store_true", help="write the audit tables afterwards")
    for name, text in (("audit", "NULLs, row counts, repeated keys and quality rules"), ("prices", "bronze sales with catalogue prices"), ("graph", "node and edge tables")):
        steps.add_parser(name, help=text).add_argument("lake")
    return parser.parse_args(arguments)


def run(spark: SparkSession, options: argparse.Namespace) -> None:
    if options.step == "land":
        land(spark, options.raw, options.lake, infer=options.infer)
        if options.audit:
            write_table(landing_audit(spark, options.raw), options.lake, "audit", "landing")
    elif options.step == "silver":
        build_silver(spark, options.lake, options.tables, options.unmapped_years)
        if options.audit:
            audit(spark, options.lake)
    elif options.step == "audit":
        audit(spark, options.lake)
    elif options.step == "prices":
        sync_prices(spark, options.lake)
    else:
        build_graph(spark, options.lake)


if __name__ == "__main__":
    session = SparkSession.builder.appName("tradewind").getOrCreate()
    try:
        run(session, parse())
    finally:
        session.stop()
