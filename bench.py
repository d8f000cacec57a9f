"""Benchmark the headline jobs at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Each query is forced to completion with the ``noop`` sink (full computation, no collect)
and run ``$BENCH_RUNS`` times (default 3, as in the reference's experiment suites);
the per-query number is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from sensorlytics.operators import outliers as O  # noqa: E402
from sensorlytics.operators import reductions as R  # noqa: E402
from sensorlytics.operators.cells import with_window  # noqa: E402
from sensorlytics.plans import jobs as J  # noqa: E402
from sensorlytics.session import get_session, scratch_path  # noqa: E402
from sensorlytics.sources import fixtures as X  # noqa: E402
from sensorlytics.sources import ingest as I  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# JOB10 and JOB1 are the reference's benchmarked / flagship jobs; widths per FIXTURES.md §3.
HEADLINE = {
    "job10_reductions_events": lambda s: J.batch_reductions(X.readings(s, SF_DIR), 60),
    "job10_reductions_parts": lambda s: J.batch_reductions(X.readings_parts(s, SF_DIR), 60),
    "job10_outlier_values_events": lambda s: J.batch_outlier_values(X.readings(s, SF_DIR), 60),
    "job10_outlier_values_parts": lambda s: J.batch_outlier_values(X.readings_parts(s, SF_DIR), 60),
    "job1_outliers_events_60min": lambda s: J.outliers_level1(X.readings(s, SF_DIR), "60 minutes"),
    "job1_outliers_parts_30d": lambda s: J.outliers_level1(X.readings_parts(s, SF_DIR), "30 days"),
    "job2_two_level": lambda s: J.outliers_two_level(X.readings(s, SF_DIR), "6 hours", "3 days"),
    "job3_iqr_raw_vs_clean": lambda s: J.iqr_summary_raw_vs_clean(X.readings(s, SF_DIR), "1 day"),
    "job4_std_raw_vs_clean": lambda s: J.std_summary_raw_vs_clean(X.readings(s, SF_DIR), "1 day"),
    "job8_pairwise_avg_parts": lambda s: R.pairwise_avg(X.readings_parts(s, SF_DIR), "30 days"),
    "iqr_keep_parts": lambda s: O.iqr_keep_inside(with_window(X.readings_parts(s, SF_DIR), "30 days")),
    "ingest_strict": lambda s: I.parse_readings(I.read_text_lines(s, _LINES[0]), "uvt")[0],
    "distinct_counts_parts": lambda s: R.distinct_counts(X.readings_parts(s, SF_DIR), 1),
}


_LINES: list[str] = []


def stage_lines(spark) -> None:
    """Raw text input for the ingest job: ``lines_bad`` written once as text files."""
    path = scratch_path(spark, "bench-lines")
    X.lines_bad(spark, SF_DIR).select("line").repartition(CPUS).write.text(path)
    _LINES.append(path)


def run_once(spark, build) -> float:
    t0 = time.perf_counter()
    build(spark).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    spark = get_session(f"local[{CPUS}]", app_name="sensorlytics-bench", shuffle_partitions=CPUS * 2,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    only = set(sys.argv[1:])
    stage_lines(spark)
    # warm-up: JVM, parquet footers, codegen caches
    run_once(spark, lambda s: X.readings(s, SF_DIR).agg(F.count(F.lit(1))))
    per_query, spread = {}, {}
    for name, build in HEADLINE.items():
        if only and name not in only:
            continue
        times = [run_once(spark, build) for _ in range(RUNS)]
        per_query[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(per_query.values()), 3),
                      "unit": "sec", "queries": per_query, "min_max": spread, "runs": RUNS, "cpus": CPUS,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
