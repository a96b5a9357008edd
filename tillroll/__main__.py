"""Command line: ``python -m tillroll run ...`` and ``python -m tillroll show <view>``.

Loads the three landing files, builds every layer, publishes the run under
``--root`` (default: ``<spark.checkpoint.dir>/tillroll``) and prints the step
results.  ``--tolerant`` keeps loading past bad values and lands the
rejected rows as ``bronze/<table>_rejected``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
import uuid

from tillroll.plans import views
from tillroll.plans.pipeline import default_root, open_published, prune_runs, run_pipeline
from tillroll.rules import DEFAULT_DATE_RANGE
from tillroll.session import get_session
from tillroll.sources.readers import read_landing, split_tagged, to_be_split, tolerant_tagged
from tillroll.sources.sinks import write_table


def _date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tillroll")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="land, clean and model the three input tables")
    run.add_argument("--orders", required=True)
    run.add_argument("--people", required=True)
    run.add_argument("--returns", required=True)
    run.add_argument("--format", default="csv", choices=["csv", "parquet", "json", "orc"])
    run.add_argument("--root", default=None)
    run.add_argument("--start", type=_date, default=DEFAULT_DATE_RANGE[0])
    run.add_argument("--end", type=_date, default=DEFAULT_DATE_RANGE[1])
    run.add_argument("--dedupe", default="distinct", choices=["distinct", "first"])
    run.add_argument("--on-unmatched", default="fail", choices=["fail", "warn", "quarantine"])
    run.add_argument("--on-error", default="fail", choices=["fail", "continue"])
    run.add_argument("--on-overlong", default="warn", choices=["warn", "fail", "ignore"])
    run.add_argument("--collation", default=None)
    run.add_argument("--date-format", default=None, help="dates of text sources, e.g. M/d/yyyy (default: ISO)")
    run.add_argument("--multiline", action="store_true", help="quoted CSV cells may hold line breaks (one task per file)")
    run.add_argument("--tolerant", action="store_true")
    run.add_argument("--truncate-overlong", action="store_true",
                     help="with --tolerant: cut text to its declared length instead of keeping it whole")
    run.add_argument("--master", default=None)
    show = sub.add_parser("show", help="print a view of the newest published run")
    show.add_argument("view", choices=sorted(n[len("vw_"):] for n in views.VIEWS))
    show.add_argument("--root", default=None)
    show.add_argument("--rows", type=int, default=20)
    show.add_argument("--master", default=None)
    prune = sub.add_parser("prune", help="delete old runs, never the published one")
    prune.add_argument("--root", default=None)
    prune.add_argument("--keep", type=int, default=3)
    prune.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    if args.command == "prune":
        for run in prune_runs(get_session(args.master), args.root, args.keep):
            print(run)
        return 0
    if args.command == "show":
        spark = get_session(args.master)
        df = views.VIEWS["vw_" + args.view](open_published(spark, args.root))
        order = [c for c in ("year", "month", "region", "state", "city", "ship_mode", "product_id",
                             "customer_id", "order_id") if c in df.columns]
        df.orderBy(*order).show(args.rows, truncate=False)
        return 0

    logging.basicConfig(level=logging.INFO)
    spark = get_session(args.master)
    sources = {"orders": args.orders, "people": args.people, "returns_order": args.returns}
    bronze = {}
    staging = f"{(args.root or default_root(spark)).rstrip('/')}/_landing/{uuid.uuid4().hex}"
    for table, path in sources.items():
        if args.tolerant:
            # Parse the source once: write the tagged rows, split the written copy.
            tagged = tolerant_tagged(spark, table, path, args.format,
                                     truncate_overlong=args.truncate_overlong, date_format=args.date_format,
                                     multiline=args.multiline)
            write_table(to_be_split(tagged, table), f"{staging}/{table}")
            good, rejected = split_tagged(spark.read.parquet(f"{staging}/{table}"), table)
            bronze[table] = good
            bronze[f"{table}_rejected"] = rejected
        else:
            bronze[table] = read_landing(spark, table, path, args.format, date_format=args.date_format,
                                         multiline=args.multiline)
    wh = run_pipeline(spark, bronze, root=args.root, date_range=(args.start, args.end),
                      dedupe=args.dedupe, on_unmatched=args.on_unmatched, on_error=args.on_error,
                      collation=args.collation, on_overlong=args.on_overlong, publish=True)
    wh.step_results(spark).show(truncate=False)
    for warning in wh.warnings:
        logging.warning(warning)
    return 0 if all(s.status == "ok" for s in wh.steps) else 1


if __name__ == "__main__":
    sys.exit(main())
