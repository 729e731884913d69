"""Command line: ``python -m stintwise build <source_dir> <out_dir>``.

On a cluster: ``spark-submit --py-files stintwise.zip stintwise/__main__.py build <src> <out>``.

Runs the whole chain - YAML folders -> flat tables -> career tables -> graph -
as Spark jobs in the session that spark-submit configures.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from stintwise.plans.build import build_all


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stintwise")
    sub = parser.add_subparsers(dest="command", required=True)
    build = sub.add_parser("build", help="ingest YAML folders and derive career tables and graph")
    build.add_argument("source_dir")
    build.add_argument("out_dir")
    build.add_argument("--strict", action="store_true",
                       help="fail on a document that lacks a key other documents have")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("stintwise").getOrCreate()
    written = build_all(spark, args.source_dir, args.out_dir, strict=args.strict)
    print(json.dumps(written, indent=2, sort_keys=True))


if __name__ == "__main__":
    main()
