"""Run the skew-path operators with one injected task failure per stage (used by
test_failures.py in its own process: it needs a local[N, retries] master)."""

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from sensorlytics.operators import outliers as O  # noqa: E402
from sensorlytics.operators import reductions as R  # noqa: E402
from sensorlytics.operators.cells import CELL, with_window  # noqa: E402
from sensorlytics.session import get_session  # noqa: E402
from sensorlytics.sources import fixtures as X  # noqa: E402


def flaky_value(v):
    """Identity, except that the first attempt of partition 0 fails (test-only Python UDF)."""
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() == 0:
        raise RuntimeError("injected task failure")
    return v


def main(inject: bool) -> None:
    spark = get_session("local[4, 3]", shuffle_partitions=4,
                        extra={"sensorlytics.broadcast.maxBytes": "6000", "sensorlytics.skew.rowsPerTask": "40"})
    spark.sparkContext.setLogLevel("OFF")
    r = X.readings(spark, "/root/testdata/sf0.01").repartition(4, "seq")
    r = r.withColumn("urn", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("urn")))
    if inject:
        r = r.withColumn("value", F.udf(flaky_value, "double")("value"))
    cells = with_window(r, "1 day")
    flags = sorted(tuple(x) for x in O.std_flag(cells).select("seq", "is_outlier").collect())
    kept = sorted(x.seq for x in O.iqr_keep_inside(cells).select("seq").collect())
    fold = sorted((x.urn, x.timestamp, round(x.value, 9)) for x in R.pairwise_avg(cells, keys=CELL).collect())
    print(json.dumps({"flags": flags, "kept": kept, "fold": fold}))


if __name__ == "__main__":
    main(sys.argv[1] == "inject")
