"""Command line: the pipeline steps as Spark jobs.

    python -m strata inspect      --raw PATH
    python -m strata profile      --raw PATH
    python -m strata check-raw    --raw PATH --start TS --end TS
    python -m strata bronze       --raw PATH --start TS --end TS [--source-file NAME]
    python -m strata silver       --start TS --end TS
    python -m strata check-silver --start TS --end TS
    python -m strata gold         --start TS --end TS
    python -m strata run          --raw PATH --start TS --end TS [--landing GLOB]

Tables and the audit live under ``--root`` (default: a folder under the
session's ``spark.checkpoint.dir``); steps of one pipeline share ``--run-id``.
A failed check exits with status 1; every result is printed as rows.
"""

from __future__ import annotations

import argparse
import os
import sys


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("strata").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="python -m strata")
    parser.add_argument("command", choices=["inspect", "profile", "check-raw", "bronze", "silver",
                                            "check-silver", "gold", "run"])
    parser.add_argument("--raw")
    parser.add_argument("--start")
    parser.add_argument("--end")
    parser.add_argument("--source-file")
    parser.add_argument("--root")
    parser.add_argument("--run-id")
    parser.add_argument("--landing")
    parser.add_argument("--raw-gate", choices=["block", "report"], default="block")
    args = parser.parse_args(argv)

    from strata.operators import checks, profile
    from strata.plans import jobs as J
    from strata.sources import inspect as I
    from strata.sources import raw as R

    spark = _session()

    def cfg() -> J.PipelineConfig:
        if not (args.start and args.end):
            parser.error("--start and --end are required")
        extra = {"run_id": args.run_id} if args.run_id else {}
        if args.root:
            extra["root"] = args.root
        source = args.source_file or (os.path.basename(args.raw) if args.raw else "unknown")
        return J.default_config(spark, period_start=args.start, period_end=args.end,
                                source_file=source, raw_gate=args.raw_gate, **extra)

    def layers() -> J.PipelineConfig:
        """The configuration, with the tables of earlier processes under its root resolved."""
        c = cfg()
        J.resolve_tables(spark, c)
        return c

    def raw():
        if not args.raw:
            parser.error("--raw is required")
        return R.read_raw(spark, args.raw)

    if args.command == "inspect":
        I.inspect(spark, args.raw).show(200, truncate=False)
        return 0
    if args.command == "profile":
        df = raw()
        profile.overview(df).show(truncate=False)
        profile.null_profile(df).show(200, truncate=False)
        profile.rule_profile(df).show(truncate=False)
        return 0
    if args.command == "check-raw":
        c = cfg()
        report = checks.check_raw(raw(), c.period_start, c.period_end)
        report.show(200, truncate=False)
        return 0 if checks.verdict(report).first()["passed"] else 1
    if args.command == "bronze":
        print(J.job_bronze(spark, raw, cfg()))
        return 0
    if args.command == "silver":
        print(J.job_silver(spark, layers()))
        return 0
    if args.command == "check-silver":
        c = layers()
        report = checks.check_silver(spark.table(c.bronze_table), spark.table(c.silver_table),
                                     spark.table(c.quarantine_table), c.period_start, c.period_end)
        report.show(truncate=False)
        return 0 if checks.silver_verdict(report).first()["passed"] else 1
    if args.command == "gold":
        for rec in J.job_gold(spark, layers()):
            print(rec)
        return 0
    if args.command == "run":
        try:
            J.run_pipeline(spark, raw, cfg(), landing_glob=args.landing).show(truncate=False)
        except J.GateClosed as err:
            print(f"pipeline stopped: {err}", file=sys.stderr)
            return 1
        return 0
    return 2


if __name__ == "__main__":
    raise SystemExit(main())
