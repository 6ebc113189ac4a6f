"""Command line: land raw files, run the flow, show a report.

python -m shoplake land  --source DIR --bronze DIR [--layout lines]
python -m shoplake run   --bronze DIR --out DIR [--layout lines] [--as-of DATE] [--jdbc] [--resume]
python -m shoplake report NAME --out DIR (--to DIR | --rows N)
"""

import argparse
import datetime as dt

from shoplake.plans.pipeline import run_all
from shoplake.plans.reports import REPORTS
from shoplake.sources.bronze import LAYOUTS, MALFORMED, land
from shoplake.sources.jdbc import jdbc_config
from shoplake.sources.session import create_spark
from shoplake.sources.tables import BUCKETS, SILVER, read_layer

ENTITIES = ("products", "users", "carts")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="shoplake")
    commands = parser.add_subparsers(dest="command", required=True)
    landing = commands.add_parser("land")
    landing.add_argument("--source", required=True, help="folder with one folder per entity")
    running = commands.add_parser("run")
    running.add_argument("--out", required=True)
    running.add_argument("--as-of", type=dt.date.fromisoformat)
    running.add_argument("--jdbc", action="store_true", help="load the gold tables as well")
    running.add_argument(
        "--malformed", choices=MALFORMED, default="fail", help="stop at it, or set it aside"
    )
    running.add_argument("--user-buckets", type=int, default=BUCKETS)
    running.add_argument("--resume", action="store_true", help="leave tables that are up to date")
    for command in (landing, running):
        command.add_argument("--bronze", required=True)
        command.add_argument("--layout", choices=LAYOUTS, default="documents")
    report = commands.add_parser("report")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--out", required=True)
    shown = report.add_mutually_exclusive_group(required=True)
    shown.add_argument("--to", help="write all rows to this folder, as CSV with a header")
    shown.add_argument("--rows", type=int, help="print so many rows at most")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = create_spark()
    if args.command == "land":
        sources = {entity: f"{args.source.rstrip('/')}/{entity}" for entity in ENTITIES}
        land(spark, sources, args.bronze, args.layout).show(truncate=False)
    elif args.command == "run":
        jdbc = jdbc_config() if args.jdbc else None
        run_all(
            spark,
            args.bronze,
            args.out,
            args.layout,
            args.as_of,
            jdbc=jdbc,
            malformed=args.malformed,
            user_buckets=args.user_buckets,
            resume=args.resume,
        )
    else:
        report = REPORTS[args.name](read_layer(spark, args.out, SILVER))
        if args.to:
            report.write.mode("overwrite").csv(args.to, header=True)
        else:
            report.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
