"""Run steps of the chain:

    python -m collarlake --root s3://lake --landing s3://landing --registry s3://registry

Steps run in order; without --steps all of them do. Without --days and --new they rebuild
everything.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date

from collarlake.plans import lake
from collarlake.session import build_session

STEPS = ("bronze", "silver", "staging", "marts", "check")


UNDATED = "undated"


def _day(text: str) -> date | None:
    return None if text == UNDATED else date.fromisoformat(text)


def parse(arguments: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="collarlake", description="Build the lake's tables.")
    for name in ("root", "landing", "registry"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--archive", help="folder that ingested files are moved to")
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=STEPS)
    which = parser.add_mutually_exclusive_group()
    which.add_argument("--days", nargs="+", type=_day, help=f"rebuild only these, or {UNDATED}")
    which.add_argument(
        "--new", action="store_true", help="rebuild what changed since the last finished run"
    )
    parser.add_argument(
        "--stop-at-bad-files",
        action="store_true",
        help="fail where a file of the load is damaged, instead of leaving it out by name",
    )
    parser.add_argument(
        "--compact", action="store_true", help="join the folders of bronze's batches first"
    )
    parser.add_argument("--as-of", type=date.fromisoformat, help="day ages refer to")
    parser.add_argument("--max-files-per-batch", type=int)
    return parser.parse_args(arguments)


def main(arguments: Sequence[str] | None = None) -> None:
    args = parse(arguments)
    spark = build_session()
    place = lake.Lake(
        args.root, args.landing, args.registry, args.archive, not args.stop_at_bad_files
    )
    days = args.days
    if "bronze" in args.steps:
        lake.build_bronze(spark, place, args.max_files_per_batch)
    if args.compact:
        lake.compact_bronze(spark, place)
    batch = lake.newest_batch(spark, place)
    if args.new:
        days = lake.days_to_build(spark, place, args.as_of)
    jobs = {
        "silver": lambda: lake.build_silver(spark, place, days),
        "staging": lambda: lake.build_staging(spark, place, days),
        "marts": lambda: lake.build_marts(spark, place, args.as_of, days),
        "check": lambda: lake.require_checks(spark, place, days),
    }
    for step in STEPS[1:]:
        if step in args.steps:
            jobs[step]()
    if set(STEPS[1:]) <= set(args.steps) and args.days is None:
        lake.commit(spark, place, batch)


if __name__ == "__main__":
    main()
