"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of warm medians, sec), "unit",
"queries" {name: sec}, "sf", ...}.  Row-level operators are forced to run
whole with the ``noop`` sink (no collect to the driver); writers write to
fresh folders under the session's shared checkpoint folder.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from parcelwise.operators.assign import (  # noqa: E402
    assign_by_ranges,
    assign_partition,
    calendar_profile,
    slice_partition,
    uncovered_rows,
)
from parcelwise.operators.ranges import period_ranges  # noqa: E402
from parcelwise.plans.partition import TableBinding, partition_tables  # noqa: E402
from parcelwise.plans.refresh import refresh  # noqa: E402
from parcelwise.queries import AS_OF, FIRST_DATE, QUERIES  # noqa: E402
from parcelwise.session import build_session, drop_folder, scratch_path  # noqa: E402
from parcelwise.sources.control import read_spec  # noqa: E402
from parcelwise.sources.storage import read_manifest  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEAT = int(os.environ.get("BENCH_REPEAT", "3"))
COPIES = int(os.environ.get("BENCH_COPIES", "1"))  # so many copies of lineitem, to see what grows with the rows

SPEC = [{"table": "lineitem", "first_date": FIRST_DATE, "partition_by": "l_shipdate",
         "interval": "QUARTER"}]


def timed(fn, repeat=REPEAT):
    fn()  # warm-up (JIT, file listing cache, python worker start)
    runs = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        runs.append(time.perf_counter() - t0)
    return round(statistics.median(runs), 3)


def main():
    spark = build_session(master=f"local[{CPUS}]", shuffle_partitions=max(8, CPUS), driver_memory="8g")
    lineitem = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    if COPIES > 1:
        copies = scratch_path(spark, "bench-copies")
        for _ in range(COPIES):
            lineitem.write.mode("append").parquet(copies)
        lineitem = spark.read.parquet(copies)
    ranges = period_ranges(read_spec(spark, SPEC), AS_OF).cache()
    ranges.count()

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    results = {}
    results["w3_assign_partition"] = timed(lambda: noop(
        assign_partition(lineitem, "lineitem", "l_shipdate", "QUARTER", FIRST_DATE, AS_OF)))
    results["w4_assign_by_ranges"] = timed(lambda: noop(
        assign_by_ranges(lineitem, "l_shipdate", ranges, "lineitem")))
    results["w5_slice_partition"] = timed(lambda: noop(
        slice_partition(lineitem, "l_shipdate", "2000-01-01", "2000-03-31")))
    results["w6_partition_profile"] = timed(lambda: calendar_profile(
        lineitem, "lineitem", "l_shipdate", "QUARTER", FIRST_DATE, AS_OF).collect())
    results["w8_uncovered_rows"] = timed(lambda: noop(
        uncovered_rows(lineitem, "l_shipdate", ranges, "lineitem")))

    # Full partitioned write of lineitem by quarter.
    def materialize():
        root = scratch_path(spark, "bench-lineitem")
        partition_tables(spark, SPEC, {"lineitem": TableBinding(lineitem, root, "l_shipdate")}, AS_OF)
        return root

    made = []
    results["w13_materialize_all"] = timed(lambda: made.append(materialize()))
    for path in made:
        drop_folder(spark, path)

    # W14 / W15 on one materialised target.
    root = materialize()
    binding = {"lineitem": TableBinding(lineitem, root, "l_shipdate")}
    names = [r.partition_name for r in read_manifest(spark, root).orderBy("range_start").collect()]

    def sel(ns):
        return json.dumps([{"table": "lineitem", "selected_partitions": ",".join(ns)}])

    for label, ns in (("1q", names[-1:]), ("4q", names[-4:]), ("all", names)):
        results[f"w14_refresh_{label}"] = timed(
            lambda ns=ns: refresh(spark, binding, "lineitem", sel(ns), "transactional"))
    results["w15_partial_4q"] = timed(
        lambda: refresh(spark, binding, "lineitem", sel(names[-4:]), "partialBatch", 4))

    for key in ("related_closure", "refresh_set_documented", "orders_quarter_profile"):
        results[f"q_{key}"] = timed(lambda key=key: QUERIES[key](spark, SF_DIR).collect())

    m = re.search(r"sf([0-9.]+)", SF_DIR)
    out = {
        "metric": "sum_of_warm_median_seconds",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": float(m.group(1)) if m else SF_DIR,
        "cpus": CPUS,
        "copies": COPIES,
        "refresh_1q_over_full_write": round(results["w14_refresh_1q"] / results["w13_materialize_all"], 3),
    }
    print(json.dumps(out))
    drop_folder(spark, root)
    if COPIES > 1:
        drop_folder(spark, copies)
    spark.stop()


if __name__ == "__main__":
    main()
