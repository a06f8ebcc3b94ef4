"""Command line: ``python -m marigold <job> --base <URI> [options]``, or this file submitted with the zipped package as
``--py-files``. ``python -m marigold <job> --base <URI> --help`` lists the options; one that a job does not take is an error.

Cluster, storage credentials and shuffle settings belong to the submit command, not to this code.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from datetime import date
from inspect import signature

from pyspark.sql import SparkSession

from marigold.plans.exploration import EXPLORATION, OPTIONS
from marigold.plans.jobs import JOBS, Layout, csv_to_parquet, inspect
from marigold.plans.refresh import FOLLOWED, refresh

REFRESH = "refresh_"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="marigold")
    jobs = [*JOBS, *[f"{REFRESH}{name}" for name in FOLLOWED], "csv_to_parquet", "inspect", *EXPLORATION]
    parser.add_argument("job", choices=jobs)
    parser.add_argument("--base", required=True, help="URI below which raw and processed tables lie")
    parser.add_argument("--source", action="append", default=None, help="raw file, glob, folder or table below the base")
    parser.add_argument("--target", help="output below the base")
    parser.add_argument("--names", help="CSV list of cities, for weather_daily")
    parser.add_argument("--zone", help="zone that cuts the days, for weather_daily")
    parser.add_argument("--headers", choices=["same", "any"], help="whether city files may have other headers than the first one")
    parser.add_argument("--pattern", help="where the key sits in a file's path")
    parser.add_argument("--depth", type=int, help="how many folders below the source the chosen files lie")
    parser.add_argument("--underscore-as-space", action="store_true", default=None, help="write blanks for underscores in keys of file names")
    parser.add_argument("--fmt", help="format of days in text, such as dd-MM-yyyy")
    parser.add_argument("--strict", action="store_true", default=None, help="make the first value that does not fit an error")
    parser.add_argument("--decimals", action="store_true", default=None, help="infer decimals instead of doubles")
    parser.add_argument("--digits", type=int, help="decimal digits of readings, for exact sums")
    parser.add_argument("--start", type=date.fromisoformat, help="first day of the period to read")
    parser.add_argument("--end", type=date.fromisoformat, help="last day of the period to read")
    parser.add_argument("--ties", choices=["all", "first", "bounded"], help="what happens to products and categories of equal revenue")
    parser.add_argument("--unknown-label", help="band of missing temperatures and humidities")
    parser.add_argument("--shown", type=int, help="rows to show")
    parser.add_argument("--x", help="column along the chart, or names of the slices")
    parser.add_argument("--y", help="column of the heights or values")
    parser.add_argument("--color", help="column that tells stacks, lines or points apart")
    parser.add_argument("--points", type=int, help="most points of a colour")
    parser.add_argument("--column", help="column to filter by")
    parser.add_argument("--values", action="append", default=None, help="value to keep; 'null' for a missing one")
    return parser


def _accepted(job: str) -> tuple[Callable, set[str], set[str]]:
    """What to call, which options it takes, and which of them it needs."""
    if job == "inspect":
        return inspect, {"source", "shown"}, {"source"}
    if job in OPTIONS:
        needed = {"source"} | ({"x", "y"} & OPTIONS[job]) | ({"column"} & OPTIONS[job])
        written = set() if job in ("preview", "metric_cards") else {"target"}
        return EXPLORATION[job], OPTIONS[job] | needed | written, needed | written
    if job.startswith(REFRESH):
        name = job.removeprefix(REFRESH)
        return lambda spark, layout, **period: refresh(spark, layout, name, **period), {"start", "end"}, set()
    if job == "csv_to_parquet":
        return csv_to_parquet, set(signature(csv_to_parquet).parameters), {"source", "target"}
    return JOBS[job], set(signature(JOBS[job]).parameters), set()


def main(argv: list[str] | None = None) -> None:
    parser = _parser()
    args = vars(parser.parse_args(argv))
    job, base = args.pop("job"), args.pop("base")
    run, accepted, needed = _accepted(job)
    given = {name: value for name, value in args.items() if value is not None}
    for name in given:
        if name not in accepted:
            parser.error(f"{job} takes no --{name.replace('_', '-')}")
    for name in sorted(needed - set(given)):
        parser.error(f"{job} needs --{name}")

    spark = SparkSession.builder.appName(f"marigold {job}").getOrCreate()
    layout, sources = Layout(base), given.pop("source", [])
    if job == "inspect":
        result = run(spark, layout, *sources, **given)
    else:
        result = run(spark, layout, **({"source": sources[0]} if sources else {}), **given)
    reports = result if isinstance(result, list) else [result]
    print(json.dumps([report.as_dict() for report in reports], indent=2, default=str))


if __name__ == "__main__":
    main()
