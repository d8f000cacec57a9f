"""Write PLANS.md: the physical plans of the headline jobs at sf0.01 (``python tools/show_plans.py``)."""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorlytics.operators import outliers as O  # noqa: E402
from sensorlytics.operators import reductions as R  # noqa: E402
from sensorlytics.operators.cells import with_window  # noqa: E402
from sensorlytics.plans import jobs as J  # noqa: E402
from sensorlytics.session import get_session  # noqa: E402
from sensorlytics.sources import fixtures as X  # noqa: E402

SF = "/root/testdata/sf0.01"

CASES = [
    ("JOB10 reductions (one aggregate, one exchange)", lambda s: J.batch_reductions(X.readings_parts(s, SF), 60)),
    ("JOB1 outlier counts, dense cells: broadcast of the frozen cell statistics",
     lambda s: J.outliers_level1(X.readings(s, SF), "1 day")),
    ("JOB1 outlier counts, tiny cells: window aggregates over the cell, no join",
     lambda s: J.outliers_level1(X.readings_parts(s, SF), "30 days")),
    ("JOB1 with a hot sensor (forced): hot-cell salted sort-merge join", "salted"),
    ("IQR keep, bounded cells: ranks and quartiles as window functions",
     lambda s: O.iqr_keep_inside(with_window(X.readings(s, SF), "1 day"))),
    ("Pairwise running average: ranks + partial aggregate on the same partitioning",
     lambda s: R.pairwise_avg(X.readings(s, SF), "1 day")),
    ("Distinct counts: pairs deduplicated before the Expand", lambda s: R.distinct_counts(X.readings_parts(s, SF), 1)),
]


def _salted(spark):
    from pyspark.sql import functions as F
    spark.conf.set("sensorlytics.broadcast.maxBytes", "6000")
    spark.conf.set("sensorlytics.skew.rowsPerTask", "40")
    try:
        r = X.readings(spark, SF)
        r = r.withColumn("urn", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("urn")))
        df = J.outliers_level1(r, "1 day")
        return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    finally:
        spark.conf.unset("sensorlytics.broadcast.maxBytes")
        spark.conf.unset("sensorlytics.skew.rowsPerTask")


def main() -> None:
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of the headline jobs", "",
           "Generated by `python tools/show_plans.py` at sf0.01 on `local[8]` (shuffle partitions 8).",
           "Plans are taken after the operators' planning actions (frozen cell tables appear as",
           "`Scan ExistingRDD`). Expression ids and paths are shortened.", ""]
    for title, build in CASES:
        txt = _salted(spark) if build == "salted" else spark._jvm.PythonSQLUtils.explainString(
            build(spark)._jdf.queryExecution(), "simple")
        txt = re.sub(r"#\d+L?", "", txt)
        txt = re.sub(r"file:/[^\],]*", "file:…", txt)
        txt = re.sub(r"MapPartitionsRDD\[\d+\] at [^,\]]*", "frozen table", txt)
        out += [f"## {title}", "", "```", txt.strip(), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
