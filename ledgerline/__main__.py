"""Command line: ``python -m ledgerline run --source DIR --out DIR --warehouse DIR``."""

from __future__ import annotations

import argparse
import json

from ledgerline.plans.pipeline import run
from ledgerline.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ledgerline")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("run", help="run the batch pipeline once")
    r.add_argument("--source", required=True, help="directory holding the raw CSV files")
    r.add_argument("--out", required=True, help="directory for quality files, CSV copies and the report")
    r.add_argument("--warehouse", required=True, help="root of the versioned warehouse")
    r.add_argument("--mode", choices=["full", "merge"], default="merge")
    r.add_argument("--master", default=None, help="Spark master; omit under spark-submit")
    args = parser.parse_args(argv)

    if args.master:
        spark = build_session(master=args.master)
    else:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("ledgerline").getOrCreate()
    result = run(spark, args.source, args.out, args.warehouse, mode=args.mode)
    print(json.dumps({"run_id": result.run_id, "load_summary": result.load_summary,
                      "metrics": result.metrics}, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
