"""Command line: ``python -m tiffin load | enrich | check-batch | daily``.

The exit code is 0 only if everything asked for succeeded.
"""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tiffin.operators import enrich, quality
from tiffin.plans import daily
from tiffin.session import configure
from tiffin.sources.control import LoadGateFailed
from tiffin.sources.landing import SOURCE_COLUMNS, load_sources
from tiffin.sources.tables import LayerTable


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tiffin")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, landing: bool) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        sub.add_argument("--warehouse", required=True)
        if landing:
            sub.add_argument("--landing", required=True)
            sub.add_argument("--run-id", default=None)
        return sub

    load = command("load", landing=True)
    load.add_argument("--source", default="all", choices=["all", *SOURCE_COLUMNS])
    batch = command("enrich", landing=False)
    batch.add_argument("--batch-id", default=None)
    batch.add_argument("--batch-size", type=int, default=enrich.BATCH_SIZE)
    batch.add_argument("--reprocess-failed", action="store_true")
    check = command("check-batch", landing=False)
    check.add_argument("--batch-id", required=True)
    run = command("daily", landing=True)
    run.add_argument("--lookback", default=None)
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("tiffin").getOrCreate())
    try:
        if args.command == "load":
            sources = None if args.source == "all" else [args.source]
            outcome = load_sources(spark, args.landing, args.warehouse, args.run_id, sources)
            print(outcome)
            return outcome.exit_code
        if args.command == "enrich":
            reviews = LayerTable(spark, f"{args.warehouse}/staging/stg_reviews").read()
            batch_id = args.batch_id or str(uuid.uuid4())
            print(
                enrich.run_batch(
                    spark, args.warehouse, reviews, batch_id, batch_size=args.batch_size,
                    reprocess_failed=args.reprocess_failed,
                )
            )
        elif args.command == "check-batch":
            log = enrich.enrichment_log(spark, args.warehouse).read()
            print(quality.check_failure_share(log, args.batch_id))
        else:
            run_id = args.run_id or str(uuid.uuid4())
            config = daily.DailyConfig(args.landing, args.warehouse, run_id, lookback=args.lookback)
            print(daily.run(spark, config))
    except (quality.QualityGateFailed, LoadGateFailed) as exc:
        print(exc, file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())
