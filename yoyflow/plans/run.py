"""Command-line runner for the two jobs.

    python -m yoyflow.plans.run extract --input program_lines=db.lines ... \\
        --control-year 2024 --as-of now --output /data/extract
    python -m yoyflow.plans.run pool --input cpq_subscriptions=/data/subs ... \\
        --control-year 2024 --as-of "2024-06-30 00:00:00" --pool-years 2023,2024 --output /data/pool

Every input is ``name=table`` or ``name=path``; the names are those of
``sources.schemas.REQUIRED``.  The session's own settings are kept; only unset
recommended ones are filled in (``session.configure``).  ``--as-of`` has no
default, since lines signed later are left out: give an instant, or ``now`` for
the current time (UTC), which is printed.
"""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import SparkSession

from yoyflow.params import RunParams
from yoyflow.plans import renewal_pool as rp
from yoyflow.plans import revenue_extract as rx
from yoyflow.session import configure, drop_stages
from yoyflow.sources.io import read_inputs, write_extract, write_pool


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="yoyflow")
    ap.add_argument("job", choices=["extract", "pool"])
    ap.add_argument("--input", action="append", default=[], help="name=table-or-path")
    ap.add_argument("--output", required=True)
    ap.add_argument("--control-year", type=int, required=True)
    ap.add_argument("--as-of", required=True, help="cut-off instant (yyyy-mm-dd hh:mm:ss), or 'now'")
    ap.add_argument("--pool-years", default=",".join(map(str, RunParams().pool_years)), help="comma list")
    ap.add_argument("--pool-classes", default=",".join(RunParams().pool_classes), help="comma list")
    ap.add_argument("--on-duplicate", choices=["fail", "keep", "smallest"], default="fail",
                    help="a doubled snapshot row (extract: fail or keep), a doubled contract (pool: fail or smallest)")
    ap.add_argument("--format", default="parquet")
    args = ap.parse_args(argv)
    if args.on_duplicate not in {"extract": ("fail", "keep"), "pool": ("fail", "smallest")}[args.job]:
        ap.error(f"--on-duplicate {args.on_duplicate} is not for {args.job}")
    as_of = args.as_of
    if as_of == "now":
        as_of = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    print(f"as of {as_of}; control year {args.control_year}; pool years {args.pool_years}; pool classes {args.pool_classes}")

    spark = configure(SparkSession.builder.appName(f"yoyflow-{args.job}").getOrCreate())
    frames = read_inputs(spark, dict(kv.split("=", 1) for kv in args.input), args.format)
    params = RunParams(
        control_year=args.control_year,
        as_of=as_of,
        pool_years=tuple(int(y) for y in args.pool_years.split(",")),
        pool_classes=tuple(args.pool_classes.split(",")),
    )
    if args.job == "extract":
        write_extract(rx.revenue_extract(rx.ExtractInputs(**frames), params, on_duplicate=args.on_duplicate), args.output, scope=[params.control_year])
    else:
        write_pool(rp.renewal_pool(rp.RenewalInputs(**frames), params, on_duplicate=args.on_duplicate), args.output, scope=params.pool_years)
    drop_stages(spark)  # the result is written; the intermediate stage tables can go


if __name__ == "__main__":
    main()
