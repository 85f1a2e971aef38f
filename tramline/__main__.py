"""Run one scheduled job: ``python -m tramline <job> --instant 2025-04-16T17:00 …``."""

from __future__ import annotations

import argparse
import datetime as dt

from tramline.plans import jobs
from tramline.session import build_session, drop_stages
from tramline.streaming.landings import append_landings

FROM_LANDING = {
    "stations": jobs.load_stations,
    "daily": jobs.load_daily,
    "last-month": jobs.load_last_month,
    "last-year": jobs.load_last_year,
    "weather": jobs.load_weather,
}

TOLERANT = ("daily", "last-month", "draft-events")


def parser() -> argparse.ArgumentParser:
    main_parser = argparse.ArgumentParser(prog="tramline", description=__doc__)
    jobs_of = main_parser.add_subparsers(dest="job", required=True)

    def add(name, *options):
        job = jobs_of.add_parser(name)
        job.add_argument("--schema", default="default", help="catalog schema of the tables")
        for option in options:
            job.add_argument(f"--{option}", required=True)
        return job

    def add_timed(name, *options):
        job = add(name, *options)
        job.add_argument(
            "--instant", type=dt.datetime.fromisoformat, required=True, help="batch time, UTC"
        )

    for name in FROM_LANDING:
        add_timed(name, "landing")
    jobs_of.choices["last-year"].add_argument("--suffix", default="NOPE", help="end of the hour columns' names")
    add_timed("predict")
    add_timed("draft-events", "landing", "pages")
    add_timed("publish-events", "responses")
    for name in TOLERANT:
        jobs_of.choices[name].add_argument("--rejected", help="side table for bad lines and rows, which else fail the job")
        jobs_of.choices[name].add_argument("--most-rejected", type=float, default=0.01, help="share of bad records that fails the job")
    add("follow-daily", "landing", "path", "name")
    return main_parser


def run(spark, args) -> object:
    if args.job == "last-year":
        return jobs.load_last_year(spark, args.landing, args.instant, suffix=args.suffix)
    tolerant = {"rejected": args.rejected, "most_rejected": args.most_rejected} if args.job in TOLERANT else {}
    if args.job in FROM_LANDING:
        return FROM_LANDING[args.job](spark, args.landing, args.instant, **tolerant)
    if args.job == "predict":
        return jobs.predict_hours(spark, args.instant)
    if args.job == "draft-events":
        return jobs.draft_events(spark, args.landing, args.pages, args.instant, **tolerant)
    if args.job == "publish-events":
        return jobs.publish_events(spark, args.responses, args.instant)
    return append_landings(spark, args.landing, args.path, args.name)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"tramline-{args.job}")
    spark.catalog.setCurrentDatabase(args.schema)
    try:
        print(f"{args.job}: {run(spark, args)}")
    finally:
        drop_stages(spark)


if __name__ == "__main__":
    main()
