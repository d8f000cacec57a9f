"""Skew paths: one sensor holds a third of all readings. Every join shape of ``attach``
and the range-based ranking must give the brute-force (single-task window) answer."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from sensorlytics.operators import outliers as O
from sensorlytics.operators import reductions as R
from sensorlytics.operators.cells import CELL, with_window
from sensorlytics.plans.ranking import rank_in_cells
from sensorlytics.sources import fixtures as X


def hot_readings(spark):
    r = X.readings(spark, SF01)
    return with_window(r.withColumn("urn", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("urn"))),
                       "1 day")


def brute_flags(df):
    w = Window.partitionBy(*CELL)
    const = F.min("value").over(w) == F.max("value").over(w)
    mean = F.when(const, F.min("value").over(w)).otherwise(F.avg("value").over(w))
    sd = F.when(const, F.lit(0.0)).otherwise(F.coalesce(F.stddev_samp("value").over(w), F.lit(0.0)))
    return df.select("seq", ((F.col("value") < mean - 2 * sd) | (F.col("value") > mean + 2 * sd)).alias("f"))


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


SHAPES = {
    "broadcast": {},
    # 150 one-day cells (~8 kB) exceed 6 kB; the hot list (<= 10000 * 52 / 6000 cells) fits
    "shuffle": {"sensorlytics.broadcast.maxBytes": "6000", "sensorlytics.skew.rowsPerTask": "1000000"},
    "salted": {"sensorlytics.broadcast.maxBytes": "6000", "sensorlytics.skew.rowsPerTask": "40"},
}


@pytest.mark.parametrize("shape", list(SHAPES))
def test_flags_every_join_shape(spark, conf, shape):
    df = hot_readings(spark)
    want = as_set(brute_flags(df), "seq", "f")
    assert sum(1 for _, f in want if f) > 0
    for k, v in SHAPES[shape].items():
        conf(k, v)
    got = O.std_flag(df).select("seq", F.col("is_outlier").alias("f"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    if shape == "salted":
        assert "_salt" in plan
    elif shape == "broadcast":
        assert "BroadcastHashJoin" in plan
    else:  # many cells, none hot: the same frozen thresholds by a plain shuffle join
        assert "_salt" not in plan and "SortMergeJoin" in plan and "Window" not in plan
    assert as_set(got, "seq", "f") == want


@pytest.mark.parametrize("force_range", [True, False])
def test_rank_in_cells_hot(spark, conf, force_range):
    df = hot_readings(spark)
    w = Window.partitionBy(*CELL).orderBy("timestamp", "seq")
    want = as_set(df.select("seq", F.row_number().over(w).alias("rn"),
                            F.count("*").over(Window.partitionBy(*CELL)).alias("n")), "seq", "rn", "n")
    conf("sensorlytics.skew.rowsPerTask", "40")      # hot cells exist: the range path is chosen
    got = rank_in_cells(df.select(*CELL, "timestamp", "seq"), CELL, ["timestamp", "seq"], partitions=16,
                        force_range=force_range)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_pid" in plan and "Window" not in plan  # frozen range-sorted rows + offsets
    assert as_set(got, "seq", "rn", "n") == want


def test_rank_in_cells_bounded_uses_window(spark):
    df = hot_readings(spark)
    got = rank_in_cells(df.select(*CELL, "timestamp", "seq"), CELL, ["timestamp", "seq"])
    assert "Window" in got._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("shape", ["broadcast", "shuffle", "salted"])
def test_iqr_and_pairwise_hot(spark, conf, shape):
    df = hot_readings(spark)
    for k, v in SHAPES[shape].items():
        conf(k, v)
    kept = as_set(O.iqr_keep_inside(df), "seq")
    # brute force: collected sorted values per cell, type-6 quartiles
    cells = df.groupBy(*CELL).agg(F.sort_array(F.collect_list("value")).alias("x")).collect()
    bounds = {}
    for c in cells:
        x, n = c.x, len(c.x)

        def q(p):
            pos = p * (n + 1)
            if pos < 1:
                return x[0]
            if pos >= n:
                return x[-1]
            k = int(pos)
            return x[k - 1] + (pos - k) * (x[k] - x[k - 1])
        bounds[(c.urn, c.win)] = (q(0.25), q(0.75))
    want = {(r.seq,) for r in df.collect() if bounds[(r.urn, r.win)][0] < r.value < bounds[(r.urn, r.win)][1]}
    assert kept == want
    # pairwise fold vs a sequential fold
    got = {(r.urn, r.timestamp): r.value for r in R.pairwise_avg(df, keys=CELL).collect()}
    seqs = df.groupBy(*CELL).agg(F.sort_array(F.collect_list(F.struct("timestamp", "seq", "value"))).alias("xs"))
    for c in seqs.collect():
        acc = None
        for item in c.xs:
            acc = item.value if acc is None else (acc + item.value) / 2
        assert got[(c.urn, c.win)] == pytest.approx(acc, rel=1e-12)


@pytest.mark.parametrize("shape", list(SHAPES))
def test_multi_flags_every_shape(spark, conf, shape):
    df = hot_readings(spark).withColumn("neg", -F.col("value") * 3)
    want_v = as_set(brute_flags(df), "seq", "f")
    want_n = as_set(brute_flags(df.withColumn("value", F.col("neg"))), "seq", "f")
    for k, v in SHAPES[shape].items():
        conf(k, v)
    got = O.std_flags(df, {"fv": "value", "fn": "neg"})
    assert as_set(got.select("seq", F.col("fv").alias("f")), "seq", "f") == want_v
    assert as_set(got.select("seq", F.col("fn").alias("f")), "seq", "f") == want_n


def test_constant_hot_sensor_salted(spark, conf):
    # a third of the readings: one sensor repeating the same value (salts must still spread
    # it, via seq), the constant-cell guard must flag none of it
    df = hot_readings(spark).withColumn("value", F.when(F.col("urn") == "hot", F.lit(5.0)).otherwise(F.col("value")))
    for k, v in SHAPES["salted"].items():
        conf(k, v)
    from sensorlytics.plans import jobs as J
    got = {(r.urn, r.timestamp): (r.values_count, r.outliers_count)
           for r in J.outliers_level1(df.drop("win"), "1 day").collect()}
    want = {(r.urn, r.win): (r.n, r.o) for r in brute_flags(df).join(df.select("seq", "urn", "win"), "seq")
            .groupBy("urn", "win").agg(F.count("*").alias("n"), F.count_if("f").alias("o")).collect()}
    assert got == want
    assert all(o == 0 for (u, _), (_, o) in got.items() if u == "hot")
    salted = F.pmod(F.xxhash64("urn", "win", "value", "seq"), F.lit(3))
    assert df.where("urn = 'hot'").select(salted).distinct().count() == 3


def test_null_keys_and_thresholds_agree_in_every_shape(spark, conf):
    """Readings of no sensor are in no cell, and on-threshold readings get one verdict, in all shapes."""
    from pyspark.sql import functions as F
    from sensorlytics.operators import outliers as O
    from sensorlytics.operators import reductions as R

    rows = spark.range(0, 1200, 1, 5).select(
        F.when(F.col("id") % 10 != 0, F.concat(F.lit("u"), (F.col("id") % 3).cast("string"))).alias("urn"),
        ((F.col("id") * 7919) % 101).cast("double").alias("value"), F.col("id").alias("timestamp"),
        F.col("id").alias("seq"), F.lit(0).cast("long").alias("win"))
    found = []
    for threshold, per_task in (("10485760", "1000000"), ("-1", "1000000"), ("-1", "50"), ("10485760", "50")):
        conf("spark.sql.autoBroadcastJoinThreshold", threshold)
        conf("sensorlytics.skew.rowsPerTask", per_task)
        flags = sorted(map(tuple, O.std_flag(rows).select("seq", "is_outlier").collect()))
        kept = sorted(r.seq for r in O.iqr_keep_inside(rows).collect())
        means = sorted((r.urn, round(r.value, 9)) for r in R.pairwise_avg(rows).collect())
        found.append((flags, kept, means))
    assert len(found[0][0]) == 1080 and len(found[0][2]) == 3
    assert all(x == found[0] for x in found)
