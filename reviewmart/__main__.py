"""Command line of the batch jobs, for spark-submit or ``python -m reviewmart``."""

from __future__ import annotations

import argparse
from datetime import datetime

from reviewmart import jobs
from reviewmart.plans.staging import DEFAULT_KEYWORD
from reviewmart.session import build_session


def _pair(text: str) -> tuple[str, str]:
    key, _, value = text.partition("=")
    return key, value


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reviewmart")
    top.add_argument("--master")
    top.add_argument("--conf", action="append", type=_pair, default=[], metavar="K=V")
    commands = top.add_subparsers(dest="command", required=True)

    cmd = commands.add_parser("load-purchases", help="CSV files into a table")
    cmd.add_argument("--input", nargs="+", required=True)
    cmd.add_argument("--table", required=True)
    cmd.add_argument("--location")
    cmd.add_argument("--multi-line", action="store_true")
    cmd.add_argument("--timestamp-format")

    cmd = commands.add_parser("export-purchases", help="table into CSV files")
    cmd.add_argument("--table", required=True)
    cmd.add_argument("--output", required=True)
    cmd.add_argument("--format", help="connector that has the table")
    cmd.add_argument("--option", action="append", type=_pair, default=[], metavar="K=V")

    cmd = commands.add_parser("stage-reviews", help="flag reviews by a keyword")
    cmd.add_argument("--input", nargs="+", required=True)
    cmd.add_argument("--output", required=True)
    cmd.add_argument("--keyword", default=DEFAULT_KEYWORD)
    cmd.add_argument("--multi-line", action="store_true")

    cmd = commands.add_parser("stage-logs", help="parse XML log records")
    cmd.add_argument("--input", nargs="+", required=True)
    cmd.add_argument("--output", required=True)
    cmd.add_argument("--layout", choices=("csv", "text", "xml", "xml-document"), default="csv")
    cmd.add_argument("--row-tag", default="log")
    cmd.add_argument("--multi-line", action="store_true")

    for name, text in (
        ("build-dims", "five dimension tables"),
        ("build-facts", "two fact tables"),
    ):
        cmd = commands.add_parser(name, help=text)
        cmd.add_argument("--logs", required=True)
        cmd.add_argument("--database")
        cmd.add_argument("--format", default="parquet")
        cmd.add_argument("--location")
        cmd.add_argument(
            "--option", action="append", type=_pair, default=[], metavar="K=V"
        )
        if name == "build-facts":
            cmd.add_argument("--purchases", nargs="+", required=True)
            cmd.add_argument("--reviews", nargs="+", required=True)
            cmd.add_argument("--load-ts", type=datetime.fromisoformat)
            cmd.add_argument(
                "--purchases-format", choices=("csv", "parquet", "table"), default="csv"
            )
            cmd.add_argument("--multi-line", action="store_true")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"reviewmart {args.command}", args.master, **dict(args.conf))
    if args.command == "load-purchases":
        jobs.load_purchases(
            spark,
            args.input,
            args.table,
            args.location,
            args.multi_line,
            args.timestamp_format,
        )
    elif args.command == "export-purchases":
        jobs.export_purchases(
            spark, args.table, args.output, args.format, dict(args.option)
        )
    elif args.command == "stage-reviews":
        jobs.stage_reviews(
            spark, args.input, args.output, args.keyword, args.multi_line
        )
    elif args.command == "stage-logs":
        jobs.stage_logs(
            spark, args.input, args.output, args.layout, args.row_tag, args.multi_line
        )
    else:
        warehouse = jobs.Warehouse(
            args.database, args.format, args.location, dict(args.option)
        )
        if args.command == "build-dims":
            jobs.build_dims(spark, args.logs, warehouse)
        else:
            table = args.purchases_format == "table"
            jobs.build_facts(
                spark,
                args.purchases[0] if table else args.purchases,
                args.reviews,
                args.logs,
                warehouse,
                args.load_ts,
                args.purchases_format,
                args.multi_line,
            )


if __name__ == "__main__":
    main()
