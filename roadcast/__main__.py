"""Run a scheduled job: ``python -m roadcast <job> ...`` (or through spark-submit)."""

from __future__ import annotations

import argparse
import datetime as dt

from roadcast.plans import jobs
from roadcast.plans.refresh import total_rows
from roadcast.plans.training import ISOTONIC, PLATT, Settings
from roadcast.session import build_session


def _now(text: str | None) -> dt.datetime:
    if text:
        return dt.datetime.fromisoformat(text)
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="roadcast")
    parser.add_argument("--shuffle-gb", type=int, help="largest shuffle to expect")
    commands = parser.add_subparsers(dest="job", required=True)
    for name in ("daily", "backfill"):
        ingest = commands.add_parser(name)
        ingest.add_argument("--landing", required=True)
        ingest.add_argument("--locations")
        ingest.add_argument("--json-lines", action="store_true")
        ingest.add_argument("--quarantine", help="folder for what had to be rejected")
        if name == "daily":
            ingest.add_argument("--ledger", help="what was taken in before; else beside the tables")
    train = commands.add_parser("train")
    train.add_argument("--models", required=True)
    train.add_argument("--members", type=int, default=Settings.members)
    train.add_argument("--trees", type=int, default=Settings.trees)
    train.add_argument("--method", choices=(PLATT, ISOTONIC), default=PLATT)
    train.add_argument("--incremental", action="store_true", help="keep the training rows between runs")
    train.add_argument("--test-days", type=int, default=Settings.test_days)
    train.add_argument("--calibration-days", type=int, default=Settings.calibration_days)
    score = commands.add_parser("score")
    score.add_argument("--models", required=True)
    score.add_argument("--now", help="naive UTC time; the clock if absent")
    score.add_argument("--fallback-csv")
    serve = commands.add_parser("serve")
    serve.add_argument("--now")
    serve.add_argument("--horizon", type=int)
    serve.add_argument("--locations")
    for command in commands.choices.values():
        command.add_argument("--tables", help="folder of the tables; else the catalog's")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = vars(_parser().parse_args(argv))
    job, gigabytes = args.pop("job"), args.pop("shuffle_gb")
    spark = build_session(
        f"roadcast-{job}", shuffle_bytes=gigabytes << 30 if gigabytes is not None else None
    )
    if job in ("daily", "backfill"):
        report = getattr(jobs, job)(spark, args.pop("landing"), **args)
        report.show(truncate=False)
        if job == "backfill":
            total_rows(report).show()
    elif job == "train":
        models, tables, incremental = args.pop("models"), args.pop("tables"), args.pop("incremental")
        trained = jobs.train(spark, models, Settings(**args), tables=tables, incremental=incremental)
        for horizon, ensemble in trained.items():
            print(horizon, ensemble.metrics)
    elif job == "score":
        counts = jobs.score(spark, args.pop("models"), _now(args.pop("now")), **args)
        print("no models or forecasts") if counts is None else counts.show()
    else:
        shown = jobs.serve(spark, _now(args.pop("now")), **args)
        for name, frame in shown.items():
            print(name)
            frame.show(truncate=False)


if __name__ == "__main__":
    main()
