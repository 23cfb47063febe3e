"""Command line: ``build`` a warehouse from CSV extracts, ``mount``, ``check``, ``report``, ``sql``, ``prune``.

    python -m starmart build --raw RAW --warehouse ROOT
    python -m starmart check --warehouse ROOT
    python -m starmart check --rows TEST --warehouse ROOT
    python -m starmart report monthly-revenue --warehouse ROOT

``build`` ends with ``mount``, which makes the tables queryable by name in the
session's catalog. ``check`` prints every result and exits with 1 when a check
fails; with ``--rows`` it prints the offending rows of one check. Tables are
printed in full, row by row, or written as CSV with ``--output``.
"""


from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from starmart.plans import pipeline, quality, reports
from starmart.plans.checks import CHECKS
from starmart.plans.layers import MARTS, STAGING, Warehouse

REPORTS = {
    "kpis": (reports.delivered_kpis, ("fact_orders",)),
    "monthly-revenue": (reports.monthly_revenue, ("fact_orders",)),
    "top-categories": (reports.top_categories, ("fact_order_items", "dim_product")),
    "state-revenue": (reports.state_revenue, ("fact_orders", "dim_customer")),
    "installments": (reports.installment_distribution, ("fact_orders",)),
    "top-sellers": (reports.top_sellers, ("fact_order_items", "dim_seller")),
    "status": (reports.status_summary, ("fact_orders",)),
}


def show(table: DataFrame, output: str | None) -> None:
    """All rows, in order: to a folder of CSV files, or printed as they arrive."""
    if output:
        table.write.option("header", True).csv(output)
        return
    print(*table.columns, sep="\t")
    for row in table.toLocalIterator():
        print(*row, sep="\t")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(prog="starmart")
    commands = parser.add_subparsers(dest="command", required=True)
    build = commands.add_parser("build", help="rebuild and publish staging and marts")
    build.add_argument("--raw", required=True, help="folder of the CSV extracts")
    build.add_argument("--pattern", default="{name}.csv", help="file name of a source")
    build.add_argument("--sep", default=",")
    build.add_argument(
        "--file",
        action="append",
        default=[],
        metavar="NAME=FILE",
        help="file of one source, where the pattern does not fit",
    )
    mount = commands.add_parser("mount", help="name the published tables in the catalog")
    check = commands.add_parser("check", help="run all data-quality checks")
    check.add_argument("--rows", metavar="TEST", choices=[c.test for c in CHECKS],
                       help="print the offending rows of this check instead")
    report = commands.add_parser("report", help="print a report over the published marts")
    report.add_argument("name", choices=REPORTS)
    sql = commands.add_parser("sql", help="run SQL over one publication")
    sql.add_argument("query", help="layers in braces, as in {marts}.fact_orders")
    prune = commands.add_parser("prune", help="delete builds older than the newest few")
    prune.add_argument("--keep", type=int, default=2)
    for command in (check, report, sql):
        command.add_argument("--output", help="write rows here as CSV instead of printing them")
    for command in (build, mount, check, report, sql, prune):
        command.add_argument("--warehouse", required=True, help="root folder of the layers")
    options = parser.parse_args(arguments)

    spark = spark or SparkSession.builder.appName("starmart").getOrCreate()
    warehouse = Warehouse(spark, options.warehouse)
    if options.command == "build":
        names = dict(entry.split("=", 1) for entry in options.file)
        raw = pipeline.read_staging_sources(
            warehouse, options.raw, options.pattern, names, options.sep
        )
        pipeline.build(warehouse, raw)
    if options.command in ("build", "mount"):
        pipeline.mount(warehouse)
        return 0
    if options.command == "check" and options.rows:
        chosen = next(c for c in CHECKS if c.test == options.rows)
        show(quality.failures(chosen, pipeline.published(warehouse)), options.output)
        return 0
    if options.command == "check":
        # One row per check, however large the tables.
        results = pipeline.check(warehouse).orderBy("passed", "test").collect()
        for row in results:
            print("PASS" if row["passed"] else f"FAIL {row['failures']}", row["test"])
        return 0 if all(row["passed"] for row in results) else 1
    if options.command == "sql":
        show(pipeline.query(warehouse, options.query), options.output)
        return 0
    if options.command == "prune":
        for layer in (STAGING, MARTS):
            for version in warehouse.prune(layer, options.keep):
                print("deleted", layer, version)
        return 0
    function, names = REPORTS[options.name]
    published = warehouse.snapshot()
    show(function(*[published.read(MARTS, name) for name in names]), options.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
