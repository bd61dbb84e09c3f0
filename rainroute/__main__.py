"""Command line: load the default datasets of one run date and rebuild the layers (see ``submit.py``)."""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import SparkSession

from rainroute.contracts import CONTRACTS, DEFAULT_DATASETS
from rainroute.plans.jobs import Dataset, Lake, SilverOptions, run
from rainroute.session import SETTINGS


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="rainroute")
    parser.add_argument("--lake", required=True, help="folder that holds the four layers")
    parser.add_argument("--run-date", required=True, type=date.fromisoformat)
    parser.add_argument("--source", action="append", default=[], metavar="DATASET=FOLDER")
    parser.add_argument("--lenient", action="store_true", help="keep bad rows aside instead of failing")
    parser.add_argument("--deduplicate", action="store_true", help="one row per key over all run dates")
    parser.add_argument("--scope", nargs=2, type=date.fromisoformat, metavar=("FIRST", "LAST"))
    parser.add_argument("--minutes", nargs=2, type=int, metavar=("SHORTEST", "LONGEST"))
    parser.add_argument("--tidy-names", action="store_true", help="standardise consortium names")
    args = parser.parse_args(argv)

    sources = dict(s.split("=", 1) for s in args.source)
    unknown = set(sources) - set(CONTRACTS)
    if unknown:
        parser.error(f"unknown datasets: {', '.join(sorted(unknown))}")
    names = [*DEFAULT_DATASETS, *[n for n in CONTRACTS if n in sources and n not in DEFAULT_DATASETS]]
    mode = "lenient" if args.lenient else "strict"

    builder = SparkSession.builder.appName("rainroute")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    lake = Lake.under(builder.getOrCreate(), args.lake.rstrip("/"))
    datasets = [Dataset(name, sources.get(name), mode) for name in names]
    options = SilverOptions(
        args.deduplicate,
        tuple(args.scope) if args.scope else None,
        tuple(args.minutes) if args.minutes else None,
        {} if args.tidy_names else None,
    )
    for result in run(lake, datasets, args.run_date, options):
        print(result)


if __name__ == "__main__":
    main()
