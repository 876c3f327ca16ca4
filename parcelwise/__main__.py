"""Command line: partition and/or refresh tables, print the report as JSON lines.

    python -m parcelwise \\
        --table orders=/data/orders.parquet,/shared/orders_by_quarter \\
        --partitions-config '[{"table":"orders","first_date":"19950215",
                               "partition_by":"o_orderdate","interval":"QUARTER",
                               "refresh_from":"TODAY","number_of_intervals":"4"}]' \\
        --as-of 2001-08-01

Each ``--table NAME=SOURCE,TARGET`` binds a table to its source (Parquet)
and its partitioned target: a folder, or ``catalog:NAME`` for a table of the session catalog; the date column comes from the spec, else from what was recorded when the
partitions were created.
Parameters mirror the original entry points: ``--partitions-config``,
``--tables-to-refresh``, ``--partitions-to-refresh``, ``--commit-mode``,
``--max-parallelism``, ``--no-partition`` / ``--no-refresh``; both JSON parameters may name a .json file.  ``--vacuum-hours`` removes
what no kept version of a folder names and was written longer ago.  ``--edges`` and ``--direction`` add related
tables to the scope.  ``--as-of``
defaults to today's date (the only place the clock is read).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from .plans.orchestrate import run
from .plans.partition import TableBinding
from .sources.control import read_spec
from .sources.storage import vacuum


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m parcelwise", description=__doc__.split("\n")[0])
    p.add_argument("--table", action="append", default=[], metavar="NAME=SOURCE,TARGET",
                   help="bind a table to its Parquet source and partitioned target (repeatable)")
    p.add_argument("--partitions-config", default="", help="JSON spec array")
    p.add_argument("--tables-to-refresh", default="", help="comma-separated table names")
    p.add_argument("--partitions-to-refresh", default="", help="JSON selection array")
    p.add_argument("--commit-mode", default="transactional", choices=["transactional", "partialBatch"])
    p.add_argument("--max-parallelism", type=int, default=4)
    p.add_argument("--as-of", default=None, help="yyyy-MM-dd; defaults to today")
    p.add_argument("--edges", default="", help="related tables as comma-separated SRC:DST pairs")
    p.add_argument("--direction", default="both", choices=["both", "out"])
    p.add_argument("--no-partition", action="store_true")
    p.add_argument("--no-refresh", action="store_true")
    p.add_argument("--vacuum-hours", type=float, default=None, help="afterwards remove replaced rows older than this")
    p.add_argument("--mode", default="documented", choices=["documented", "selected_only"])
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    if args.max_parallelism < 1:
        raise SystemExit("--max-parallelism must be a positive integer")
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("parcelwise").getOrCreate()
    as_of = args.as_of or dt.date.today().isoformat()
    spec_dates = {}
    if args.partitions_config.strip():
        spec_dates = {r["table"]: r["partition_by"]
                      for r in read_spec(spark, args.partitions_config).collect()}
    bindings = {}
    for item in args.table:
        name, _, paths = item.partition("=")
        source, _, target = paths.partition(",")
        if not (name and source and target):
            raise SystemExit(f"--table expects NAME=SOURCE,TARGET, got {item!r}")
        place = {"catalog_table": target[8:]} if target.startswith("catalog:") else {"root": target}
        bindings[name] = TableBinding(spark.read.parquet(source), date_col=spec_dates.get(name), **place)
    edges = [tuple(x.strip().split(":")) for x in args.edges.split(",") if x.strip()]
    if any(len(e) != 2 or not all(e) for e in edges):
        raise SystemExit(f"--edges expects SRC:DST pairs, got {args.edges!r}")
    report = run(spark, bindings, as_of, edges=edges or None, direction=args.direction,
                 partitions_config=args.partitions_config or None,
                 enable_partition=not args.no_partition, enable_refresh=not args.no_refresh,
                 tables_to_refresh=args.tables_to_refresh or None,
                 partitions_to_refresh=args.partitions_to_refresh or None,
                 refresh_commit_mode=args.commit_mode,
                 refresh_max_parallelism=args.max_parallelism, mode=args.mode)
    if report is not None:
        for row in report.collect():
            print(json.dumps(row.asDict(), default=str))
    if args.vacuum_hours is not None:
        for binding in bindings.values():
            if binding.root is not None:
                vacuum(spark, binding.root, older_than=dt.timedelta(hours=args.vacuum_hours))
    return 0


if __name__ == "__main__":
    sys.exit(main())
