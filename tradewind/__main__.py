"""Batch flows from the command line.

    python -m tradewind build   <raw csv folder> <new folder>
    python -m tradewind refresh <raw csv folder> <folder of an earlier build> <new folder>
    python -m tradewind report  <folder of a build> <new folder>
"""

from __future__ import annotations

import argparse

from tradewind.plans.batch import refresh_from_csv, run_from_csv, run_reports
from tradewind.schemas import RAW
from tradewind.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tradewind")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, folders in {
        "build": ("raw", "out"),
        "refresh": ("raw", "built", "out"),
        "report": ("built", "out"),
    }.items():
        command = commands.add_parser(name)
        for folder in folders:
            command.add_argument(folder)
        if "raw" in folders:
            command.add_argument(
                "--file",
                action="append",
                default=[],
                metavar="TABLE=NAME",
                help="file or folder of a table, if it is not TABLE.csv",
            )
    args = parser.parse_args()
    spark = build_session()
    if args.command == "report":
        run_reports(spark, args.built, args.out)
    else:
        files = {name: f"{name}.csv" for name in RAW} | dict(f.split("=", 1) for f in args.file)
        if args.command == "build":
            run_from_csv(spark, args.raw, files, args.out)
        else:
            refresh_from_csv(spark, args.raw, files, args.built, args.out)
    spark.stop()


if __name__ == "__main__":
    main()
