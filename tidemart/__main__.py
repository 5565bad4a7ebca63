"""``python -m tidemart refresh|report|export``; submit with ``spark-submit`` on a cluster."""
from __future__ import annotations

import argparse

from tidemart.operators.quality import report
from tidemart.plans import contracts as C
from tidemart.plans import suites
from tidemart.plans.export import export_points
from tidemart.plans.refresh import Config, refresh
from tidemart.session import build, tune


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemart")
    sub = p.add_subparsers(dest="command", required=True)
    r = sub.add_parser("refresh", help="load all layers")
    r.add_argument("--landing", required=True)
    r.add_argument("--years", required=True, help="first-last, such as 2021-2026")
    r.add_argument("--force-refresh", action="store_true")
    q = sub.add_parser("report", help="run the quality suites and print the report")
    q.add_argument("--scale", type=float, default=1.0, help="share of the expected row counts")
    e = sub.add_parser("export", help="append new weather points to a sink table")
    e.add_argument("--sink", default="weather_points")
    for s in (r, q, e):
        s.add_argument("--database", required=True)
    return p


def run(args: argparse.Namespace, spark) -> str:
    if args.command == "refresh":
        first, _, last = args.years.partition("-")
        done = refresh(spark, Config(args.database, args.landing, int(first), int(last or first), args.force_refresh))
        return "\n".join(f"{t}: {n:,} rows" for t, n in done.items())
    if args.command == "report":
        return report(suites.run_all(spark, args.database, args.scale))
    weather = spark.table(f"{args.database}.{C.WEATHER.name}")
    return f"{export_points(weather, f'{args.database}.{args.sink}'):,} points"


if __name__ == "__main__":
    print(run(parser().parse_args(), tune(build())))
