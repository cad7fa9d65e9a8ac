"""Run lake stages from the command line (``spark-submit`` or ``python -m tierlake``).

    python -m tierlake --raw <raw> --lake <lake> [--stages bronze,silver,gold]
                       [--mode skip|overwrite] [--raw-format csv|zip] [--incremental]
                       [--spec exam | --spec-file <source.json>] [--versioned]

The session comes from the environment (``spark-submit`` settings, or a local
session when run directly); the spec is the exam source's, or that of a file (see
``tierlake.specfile``).
"""

from __future__ import annotations

import argparse
import json
import sys

from tierlake.plans.lake import STAGES, build_lake
from tierlake.specfile import BASES as SPECS
from tierlake.specfile import read_spec


def main(argv: list[str] | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="tierlake", description="Build lake stages.")
    parser.add_argument("--raw", required=True, help="raw folder (yearly CSV folders or zip archives)")
    parser.add_argument("--lake", required=True, help="lake root: <lake>/<layer>/<spec name>")
    parser.add_argument("--spec", default="exam", choices=sorted(SPECS))
    parser.add_argument("--spec-file", help="JSON file of the source's spec, in place of --spec")
    parser.add_argument("--stages", default=",".join(STAGES), help="comma list of bronze,silver,gold")
    parser.add_argument("--mode", default="skip", choices=["skip", "overwrite"])
    parser.add_argument("--raw-format", default="csv", choices=["csv", "zip"])
    parser.add_argument("--incremental", action="store_true", help="rebuild silver/gold only for new years")
    parser.add_argument("--versioned", action="store_true", help="gold tables change together, by commits")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("tierlake").getOrCreate()
    stages = [s.strip() for s in args.stages.split(",") if s.strip()]
    spec = read_spec(spark, args.spec_file) if args.spec_file else SPECS[args.spec]
    out = build_lake(
        spark, args.raw, args.lake, spec, stages=stages, mode=args.mode,
        raw_format=args.raw_format, incremental=args.incremental, versioned=args.versioned,
    )
    summary = {stage: [(r.table, r.year, r.action, r.rows) for r in reps] for stage, reps in out.items()}
    print(json.dumps(summary))
    return summary


if __name__ == "__main__":
    main(sys.argv[1:])
