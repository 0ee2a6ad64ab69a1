"""Command line: list the queries, or run some over a folder of tables and write what they give.

python -m rillstone list
python -m rillstone run q01_region_rollup q45_published --data DIR --out DIR [--format parquet|csv|json] [--master local[*]]
"""

from __future__ import annotations

import argparse
import sys
import time


def main(argv: list[str] | None = None) -> int:
    from rillstone.plans import catalogue

    parser = argparse.ArgumentParser(prog="rillstone", description="Queries of the registry engine.")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("list", help="names and what they show")
    run = commands.add_parser("run", help="run queries and write their rows")
    run.add_argument("names", nargs="+")
    run.add_argument("--data", required=True)
    run.add_argument("--out", required=True)
    run.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    run.add_argument("--master")
    given = parser.parse_args(argv)
    if given.command == "list":
        for name, query in sorted(catalogue.QUERIES.items()):
            print(f"{name}: {(query.__doc__ or '').strip()}")
        return 0
    unknown = [n for n in given.names if n not in catalogue.QUERIES]
    if unknown:
        print(f"no such query: {', '.join(unknown)}", file=sys.stderr)
        return 2
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.appName("rillstone")
    spark = (builder.master(given.master) if given.master else builder).getOrCreate()
    for name in given.names:
        began = time.perf_counter()
        catalogue.QUERIES[name](spark, given.data).write.format(given.format).mode("overwrite").option("header", True).save(f"{given.out}/{name}")
        print(f"{name}: {time.perf_counter() - began:.1f} s")
    return 0


if __name__ == "__main__":
    sys.exit(main())
