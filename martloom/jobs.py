"""The batch steps as commands, for spark-submit.

    jobs.py create    --mart ROOT
    jobs.py load      --org ail --file-type basic --batch-date 2026-03-31
                      --contract PATH --input PATH --staging ROOT [--salt TEXT] [--literal]
                      [--max-rejects N]
    jobs.py arrivals  as load, with a folder as input, and --progress FOLDER
    jobs.py transform --batch-date 2026-03-31 --staging ROOT --mart ROOT [--contract PATH]
    jobs.py check     --mart ROOT
    jobs.py expire    --mart ROOT [--keep 2]
    jobs.py truncate  [--staging ROOT] [--mart ROOT]

The exit status is 1 if `check` finds faults, or if `load` rejects or quarantines more rows than
--max-rejects (by default any number passes).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import SparkSession

from martloom.plans.checks import mart_faults
from martloom.plans.mart import (
    NAMED_BY,
    create_mart,
    expire_slices,
    fallback_columns,
    read_mart_tables,
    seed_organizations,
    truncate_mart,
)
from martloom.plans.pipeline import transform_batch
from martloom.plans.policy_mart import CONTRACTS, STAGING
from martloom.plans.staging import REJECTS, load_file
from martloom.sources.contract import load_contract
from martloom.sources.tables import truncate_table
from martloom.streaming.arrivals import MAX_FILE_AGE, load_arrivals


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    steps = parser.add_subparsers(dest="step", required=True)

    create = steps.add_parser("create")
    create.add_argument("--mart", required=True)

    load, arrivals = steps.add_parser("load"), steps.add_parser("arrivals")
    for step in (load, arrivals):
        step.add_argument("--org", required=True)
        step.add_argument("--file-type", required=True)
        step.add_argument("--batch-date", required=True, type=date.fromisoformat)
        step.add_argument("--contract", help="JSON document; by default the shipped contract")
        step.add_argument("--input", required=True)
        step.add_argument("--staging", required=True)
        step.add_argument("--literal", action="store_true", help="unreadable values load as NULL")
        step.add_argument("--salt")
    load.add_argument("--reject-format", choices=["parquet", "csv"], default="parquet")
    load.add_argument("--max-rejects", type=int)
    arrivals.add_argument("--progress", required=True, help="folder of the stream's checkpoint")
    arrivals.add_argument("--max-file-age", default=MAX_FILE_AGE)

    transform = steps.add_parser("transform")
    transform.add_argument("--batch-date", required=True, type=date.fromisoformat)
    transform.add_argument("--staging", required=True)
    transform.add_argument("--mart", required=True)
    transform.add_argument("--contract", help="of basic files: its match_fallback tells people apart")

    expire = steps.add_parser("expire")
    expire.add_argument("--mart", required=True)
    expire.add_argument("--keep", type=int, default=2)

    check = steps.add_parser("check")
    check.add_argument("--mart", required=True)

    truncate = steps.add_parser("truncate")
    truncate.add_argument("--staging")
    truncate.add_argument("--mart")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace, now: datetime) -> int:
    """Returns how many rows were rejected, or faults found; 0 for the other steps."""
    if args.step in ("load", "arrivals"):
        contract = load_contract(spark, args.contract) if args.contract else CONTRACTS[args.file_type]
        contract = contract.for_org(args.org)
        options = {"strict": not args.literal, "salt": args.salt}
    if args.step == "create":
        create_mart(spark, args.mart)
        seed_organizations(spark, args.mart, now.date())
    elif args.step == "load":
        counts = load_file(
            spark, args.input, contract, args.staging, args.batch_date, now,
            reject_format=args.reject_format, **options,
        )
        print(f"{args.org}/{args.file_type} {args.batch_date}: {counts}")
        return counts.rejected + counts.quarantined
    elif args.step == "arrivals":
        streams = load_arrivals(
            spark, args.input, contract, args.staging, args.batch_date, now, args.progress,
            max_file_age=args.max_file_age, **options,
        )
        for stream in streams:
            stream.awaitTermination()
    elif args.step == "transform":
        fallback = fallback_columns(load_contract(spark, args.contract)) if args.contract else NAMED_BY
        transform_batch(spark, args.staging, args.mart, args.batch_date, now.date(), fallback)
    elif args.step == "expire":
        expire_slices(spark, args.mart, args.keep)
    elif args.step == "check":
        faults = mart_faults(read_mart_tables(spark, args.mart)).collect()
        for row in faults:
            print(f"{row.table_name} {row.check_name}: {row.n_faults}")
        return sum(row.n_faults for row in faults)
    elif args.step == "truncate":
        if args.staging:
            for table in (*STAGING.values(), REJECTS):
                truncate_table(spark, table, args.staging)
        if args.mart:
            truncate_mart(spark, args.mart)
    return 0


def exit_status(args: argparse.Namespace, found: int) -> int:
    if args.step == "load":
        return int(args.max_rejects is not None and found > args.max_rejects)
    return int(found > 0)


def main(argv: Sequence[str] | None = None) -> int:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"martloom-{args.step}").getOrCreate()
    return exit_status(args, run(spark, args, datetime.now().replace(microsecond=0)))


if __name__ == "__main__":
    sys.exit(main())
