"""Command line: run the continuous job, reconcile.

    spark-submit -m rowtide ...   or   python -m rowtide run|reconcile --help
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from rowtide.operators.digest import reconcile_by_digest
from rowtide.operators.reconcile import SAMPLE_SIZE, run_until_converged
from rowtide.schemas import ORDERS
from rowtide.session import configure
from rowtide.sources.feed import read_feed_files, read_log
from rowtide.sources.tables import read_jdbc_table
from rowtide.streaming import pipeline as job


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.servers:
        feed = read_log(spark, args.servers, [args.topic])
    else:
        feed = read_feed_files(spark, args.feed, streaming=True)
    tables = job.Pipeline(args.root, order_by=args.order_by, on_bad_record=args.on_bad_record)
    if args.drain:
        job.drain(feed, tables)
    else:
        job.start(feed, tables, args.every)
        spark.streams.awaitAnyTermination()  # raises the failure of the query that failed
    return 0


def _source(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The source table: Parquet, or a database over JDBC (needs its driver; untested here)."""
    if args.source:
        return spark.read.parquet(args.source)
    return read_jdbc_table(spark, ORDERS, args.source_jdbc, ORDERS.table, args.lower, args.upper, args.partitions)


def run_reconcile(spark: SparkSession, args: argparse.Namespace) -> int:
    tables = job.Pipeline(args.root, order_by=args.order_by)

    def check():
        valid = {"valid_target_count": job.read_output(spark, tables, job.VALID)}
        counted = job.event_counts(spark, tables)
        replica = job.read_output(spark, tables, job.CURRENT)
        findings = tables.dir("pipeline_findings")
        return reconcile_by_digest(_source(spark, args), replica, ORDERS, valid, findings, args.sample_size, counted)

    result = run_until_converged(
        check,
        tables.dir("pipeline_reconciliation"),
        timeout_seconds=args.timeout,
        poll_seconds=args.poll,
    )
    passed = result["status"] == "PASS"
    report = {**result.asDict(), "details": json.loads(result["details"])}
    print(json.dumps(report, indent=2), file=sys.stdout if passed else sys.stderr)
    return 0 if passed else 1


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="rowtide", description=__doc__)
    commands = top.add_subparsers(required=True)

    p = commands.add_parser("run", help="maintain the five tables")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="Kafka bootstrap servers")
    source.add_argument("--feed", help="folder of feed records as Parquet")
    p.add_argument("--topic", default=ORDERS.topic)
    p.add_argument("--root", required=True, help="folder of the tables")
    p.add_argument("--every", default="10 seconds")
    p.add_argument("--drain", action="store_true", help="process what is there, then stop")
    p.add_argument("--order-by", choices=["position", "source"], default="position")
    p.add_argument("--on-bad-record", choices=["fail", "skip"], default="fail")
    p.set_defaults(command=run)

    p = commands.add_parser("reconcile", help="compare the source table with the replica")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--source", help="source table as Parquet")
    source.add_argument("--source-jdbc", help="URL of the source database")
    p.add_argument("--lower", type=int, default=0, help="smallest key, to split a JDBC scan")
    p.add_argument("--upper", type=int, default=1 << 31, help="largest key, to split a JDBC scan")
    p.add_argument("--partitions", type=int, default=32, help="parts of a JDBC scan")
    p.add_argument("--sample-size", type=int, default=SAMPLE_SIZE, help="ids of each finding in the report")
    p.add_argument("--root", required=True)
    p.add_argument("--order-by", choices=["position", "source"], default="position")
    p.add_argument("--timeout", type=float, default=90)
    p.add_argument("--poll", type=float, default=3)
    p.set_defaults(command=run_reconcile)
    return top


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    spark = configure(SparkSession.builder.appName("rowtide").getOrCreate())
    return args.command(spark, args)
