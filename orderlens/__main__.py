"""Command line for spark-submit or ``python -m orderlens``: one job per call.

Schedule ``ingest`` and ``process`` (or ``refresh``, or ``stream``) one run at a time; a step that
fails ends the process with an error, so the scheduler's own retry applies.
"""

from __future__ import annotations

import argparse
import ast
import csv
import sys

from pyspark.sql import DataFrame, SparkSession

from orderlens.plans import REPORTS, check_lake, ingest_documents, process_lake, run, run_refresh
from orderlens.session import tune
from orderlens.sinks import read_tables
from orderlens.streaming import stream_refresh


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="orderlens", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *places: str, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        for place in places:
            sub.add_argument(f"--{place}", required=True)
        return sub

    ingest = job("ingest", "documents", "lake", help="flatten fetched documents into a lake batch")
    refresh = job("refresh", "documents", "lake", "warehouse", help="ingest, then process")
    for sub in (ingest, refresh):
        sub.add_argument("--whole-files", action="store_true", help="each file is one document, not each line")
        sub.add_argument("--split", action="store_true", help="each file is one document, large ones are cut between orders")
        sub.add_argument("--rejects", help="folder for documents that do not parse, instead of failing")
    process = job("process", "lake", "warehouse", help="load the lake into the tables and empty it")
    for sub in (process, refresh):
        sub.add_argument("--dedupe", action="store_true", help="drop rows that a later landing repeats")
        sub.add_argument("--check", action="store_true", help="fail if a row breaks a rule or would lose a value")
        sub.add_argument("--quarantine", help="folder for rows that break a rule or would lose a value; the others load")
    stream = job("stream", "lake", "warehouse", "checkpoint", help="load new lake batches with a streaming query")
    for sub in (process, refresh, stream):
        sub.add_argument("--database", help="keep this catalog database's tables on the newest refresh")
        sub.add_argument("--cluster", action="store_true", help="give each file its own range of keys")
    job("check", "lake", help="count the rows of the lake that break a rule or would lose a value")
    report = job("report", "warehouse", help="print or write one report, all rows")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--param", action="append", default=[], metavar="NAME=VALUE", help="a threshold of the report")
    report.add_argument("--output", help="folder to write the result to instead of printing it")
    report.add_argument("--format", default="csv", choices=("csv", "json", "parquet"), help="of the output")
    return parser


def _params(given: list[str]) -> dict:
    """Thresholds from NAME=VALUE; values are Python literals, or else text."""
    params = {}
    for item in given:
        name, _, value = item.partition("=")
        try:
            params[name] = ast.literal_eval(value)
        except (SyntaxError, ValueError):
            params[name] = value
    return params


def _print(df: DataFrame) -> None:
    """All rows as tab-separated text, one partition at a time."""
    out = csv.writer(sys.stdout, delimiter="\t", lineterminator="\n")
    out.writerow(df.columns)
    out.writerows(df.toLocalIterator())


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = tune(SparkSession.builder.appName(f"orderlens-{args.job}").getOrCreate())
    match args.job:
        case "ingest":
            print(
                ingest_documents(
                    spark,
                    args.documents,
                    args.lake,
                    multi_line=args.whole_files,
                    rejects=args.rejects,
                    split=args.split,
                )
            )
        case "check":
            _print(check_lake(spark, args.lake))
        case "process":
            _print(
                process_lake(
                    spark,
                    args.lake,
                    args.warehouse,
                    args.dedupe,
                    args.database,
                    args.cluster,
                    args.check,
                    args.quarantine,
                )
            )
        case "refresh":
            _print(
                run_refresh(
                    spark,
                    args.documents,
                    args.lake,
                    args.warehouse,
                    multi_line=args.whole_files,
                    dedupe=args.dedupe,
                    database=args.database,
                    rejects=args.rejects,
                    cluster=args.cluster,
                    check=args.check,
                    quarantine=args.quarantine,
                    split=args.split,
                )
            )
        case "stream":
            _print(
                stream_refresh(
                    spark, args.lake, args.warehouse, args.checkpoint, database=args.database, cluster=args.cluster
                )
            )
        case "report":
            result = run(args.name, read_tables(spark, args.warehouse), **_params(args.param))
            if args.output:
                result.write.format(args.format).option("header", True).save(args.output)
            else:
                _print(result)


if __name__ == "__main__":
    main()
