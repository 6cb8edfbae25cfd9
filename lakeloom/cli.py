"""Jobs for spark-submit.

    spark-submit --py-files lakeloom.zip lakeloom/cli.py \\
        silver orders --root s3://bucket/lake --run_date 2026-01-31
    spark-submit --py-files lakeloom.zip lakeloom/cli.py gold --root s3://bucket/lake
    spark-submit --py-files lakeloom.zip lakeloom/cli.py \\
        ingest --root s3://bucket/lake --run_date 2026-01-31 \\
        --jdbc_url jdbc:sqlserver://host --jdbc_option user=loader --split orders:order_id:1:9000000:64
    spark-submit --py-files lakeloom.zip lakeloom/cli.py \\
        csv s3://bucket/drop/prices.csv supplier_price_list --root s3://bucket/lake

Jobs find each other's tables through the session's metastore.
"""

from __future__ import annotations

import argparse
from functools import partial

from pyspark.sql import SparkSession

from lakeloom.plans.audit import AuditRecord, AuditSink, compact, jdbc_sink
from lakeloom.plans.ingest import ingest, land_csv
from lakeloom.plans.jobs import build_gold, run_silver
from lakeloom.plans.lakehouse import Lakehouse
from lakeloom.plans.silver import SILVER
from lakeloom.session import tune
from lakeloom.sinks.tables import Ranges
from lakeloom.sources import JdbcSource, Split
from lakeloom.sources.bronze import has_copy, read_full
from lakeloom.sources.delimited import CSV_COLUMNS
from lakeloom.sources.splits import even_splits

RUN_IDS = (
    "pipeline_name", "pipeline_run_id", "job_name", "job_run_id", "task_name", "task_run_id",
)


def parser() -> argparse.ArgumentParser:
    shared = argparse.ArgumentParser(add_help=False)
    shared.add_argument("--root", required=True, help="folder of the lakehouse")
    shared.add_argument("--silver_schema", default="silver")
    shared.add_argument("--gold_schema", default="gold")
    shared.add_argument(
        "--ranges", action="append", default=[], metavar="SCHEMA.TABLE:COLUMN:WIDTH",
        help="how a new table is partitioned; one that exists knows it",
    )
    shared.add_argument("--format", default="parquet", help="of new tables, such as delta or iceberg")
    shared.add_argument("--audit_jdbc_url", help="a database that gets the audit rows")
    shared.add_argument("--audit_table", default="etl.audit_log")
    shared.add_argument("--audit_jdbc_option", action="append", default=[], metavar="NAME=VALUE")
    shared.add_argument(
        "--in_memory_catalog", action="store_true", help="go on without a metastore: no other job finds the tables"
    )
    for name in RUN_IDS:
        shared.add_argument(f"--{name}")
    top = argparse.ArgumentParser(prog="lakeloom")
    jobs = top.add_subparsers(dest="job", required=True)
    silver = jobs.add_parser("silver", parents=[shared])
    silver.add_argument("table", choices=sorted(SILVER))
    silver.add_argument("--run_date")
    silver.add_argument("--strict", action="store_true")
    ingestion = jobs.add_parser("ingest", parents=[shared])
    ingestion.add_argument("--run_date", required=True)
    ingestion.add_argument("--jdbc_url", required=True)
    ingestion.add_argument("--jdbc_option", action="append", default=[], metavar="NAME=VALUE")
    ingestion.add_argument(
        "--split", action="append", default=[], metavar="TABLE:COLUMN:LOWER:UPPER:PARTS"
    )
    ingestion.add_argument(
        "--even_split", action="append", default=[], metavar="TABLE:COLUMN:PARTS",
        help="readers of about the same number of rows, by the quantiles of the last copy; the first copy has --split",
    )
    gold = jobs.add_parser("gold", parents=[shared])
    gold.add_argument("--as_of")
    gold.add_argument("--every_price", action="store_true")
    gold.add_argument("--changed_only", action="store_true", help="leave out items later than their order")
    gold.add_argument("--lookback", help="with --changed_only: how far to go back behind the mark, as '7 days'")
    gold.add_argument("--first_day")
    gold.add_argument("--last_day")
    landing = jobs.add_parser("csv", parents=[shared])
    landing.add_argument("file")
    landing.add_argument("table", choices=sorted(CSV_COLUMNS))
    jobs.add_parser("seed", parents=[shared])
    jobs.add_parser("compact", parents=[shared], help="join the audit log's records into a partition a month")
    return top


def named(options: list[str]) -> dict[str, str]:
    return dict(o.split("=", 1) for o in options)


def table_ranges(args: argparse.Namespace) -> dict[str, Ranges]:
    parts = (text.split(":") for text in args.ranges)
    return {table: Ranges(column, int(width)) for table, column, width in parts}


def audit_sink(args: argparse.Namespace, spark: SparkSession) -> AuditSink | None:
    """The database to audit to, if one is named; else the job uses the lakehouse's table."""
    if not args.audit_jdbc_url:
        return None
    return jdbc_sink(spark, JdbcSource(args.audit_jdbc_url, named(args.audit_jdbc_option)), args.audit_table)


def even_conditions(args: argparse.Namespace, spark: SparkSession, bronze: str) -> dict[str, list[str]]:
    """The readers' conditions of the tables that have been copied before."""
    parts = (text.split(":") for text in args.even_split)
    return {
        table: even_splits(read_full(spark, bronze, table), column, int(n))
        for table, column, n in parts
        if has_copy(spark, bronze, table)
    }


def jdbc_source(args: argparse.Namespace, conditions: dict[str, list[str]] | None = None) -> JdbcSource:
    splits = {}
    for text in args.split:
        table, column, lower, upper, parts = text.split(":")
        splits[table] = Split(column, lower, upper, int(parts))
    return JdbcSource(args.jdbc_url, named(args.jdbc_option), splits, conditions=conditions or {})


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = tune(SparkSession.builder.appName(args.task_name or "lakeloom").getOrCreate())
    in_memory = spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory"
    if in_memory and not args.in_memory_catalog:
        raise SystemExit("no metastore: other jobs would not find the tables of this one")
    lakehouse = Lakehouse(
        args.root, silver=args.silver_schema, gold=args.gold_schema, ranges=table_ranges(args),
        format=args.format,
    )
    lakehouse.create_schemas(spark)
    ids = {name: getattr(args, name) for name in RUN_IDS}
    record = AuditRecord("", "", "", orchestrator="spark-submit", **ids)
    sink = audit_sink(args, spark)
    match args.job:
        case "gold":
            results = build_gold(
                spark, lakehouse, as_of=args.as_of, every_price=args.every_price,
                catch_up=not args.changed_only, first_day=args.first_day, last_day=args.last_day,
                lookback=args.lookback,
            )
            results.show(50, False)
        case "seed":
            lakehouse.seed_control(spark)
        case "compact":
            print(compact(spark, lakehouse.audit_table()))
        case "csv":
            folder, _, name = args.file.rpartition("/")
            print(land_csv(spark, lakehouse, folder or ".", name, args.table, record, sink))
        case "ingest":
            source = jdbc_source(args, even_conditions(args, spark, lakehouse.bronze))
            reader = partial(source.read, spark)
            print(ingest(spark, lakehouse, reader, args.run_date, record, sink))
        case "silver":
            print(run_silver(spark, lakehouse, args.table, args.run_date, record, sink, args.strict))


if __name__ == "__main__":
    main()
