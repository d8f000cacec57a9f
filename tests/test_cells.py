"""Hand-made cells (FIXTURES.md §4) and the quirk ledger rows they pin down."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import cell
from sensorlytics.functions.timecols import slot_floor_ms, window_start_ms
from sensorlytics.operators import outliers as O
from sensorlytics.operators import reductions as R
from sensorlytics.operators.cells import CELL, cell_stats


def values(df, col="value"):
    return sorted(r[col] for r in df.select(col).collect())


def test_single_reading(spark):
    c = cell(spark, [7.0])
    st = cell_stats(c, CELL).first()
    assert st.sd == 0.0 and st.mean == 7.0
    assert O.std_keep_inside(c).count() == 0
    assert O.std_remove_outliers(c).count() == 1
    assert O.iqr_keep_inside(c).count() == 0


def test_constant_cell_guard(spark):
    c = cell(spark, [0.1, 0.1, 0.1])
    st = cell_stats(c, CELL).first()
    assert st.mean == 0.1 and st.sd == 0.0
    assert O.std_flag(c).where("is_outlier").count() == 0
    assert O.std_keep_inside(c).count() == 0
    assert O.std_remove_outliers(c).count() == 3
    assert O.iqr_keep_inside(c).count() == 0


def test_type6_quartiles(spark):
    q = O.quartiles(cell(spark, [16, 1, 8, 2, 4])).first()
    assert (q.q1, q.q3) == (1.5, 12.0)
    assert values(O.iqr_keep_inside(cell(spark, [1, 2, 4, 8, 16]))) == [2.0, 4.0, 8.0]
    q3 = O.quartiles(cell(spark, [1, 2, 3])).first()
    assert (q3.q1, q3.q3) == (1.0, 3.0)
    assert values(O.iqr_keep_inside(cell(spark, [1, 2, 3]))) == [2.0]
    assert O.iqr_keep_inside(cell(spark, [1, 2])).count() == 0


def test_quartiles_with_ties(spark):
    q = O.quartiles(cell(spark, [5, 5, 5, 1, 9, 5, 5])).first()
    assert (q.q1, q.q3) == (5.0, 5.0)
    assert O.iqr_keep_inside(cell(spark, [5, 5, 5, 1, 9, 5, 5])).count() == 0


def test_pairwise_fold(spark):
    c = cell(spark, [1, 2, 4, 8])
    assert R.pairwise_avg(c, keys=CELL).first().value == pytest.approx(5.375)
    assert R.window_mean(c.drop("win"), "1 day").first().value == pytest.approx(3.75)
    assert R.pairwise_avg(cell(spark, [3.0]), keys=CELL).first().value == 3.0


def test_pairwise_fold_uses_time_order(spark):
    rows = [("u", 8.0, 4000, 3, 0), ("u", 1.0, 1000, 0, 0), ("u", 4.0, 3000, 2, 0), ("u", 2.0, 2000, 1, 0)]
    df = spark.createDataFrame(rows, "urn string, value double, timestamp long, seq long, win long")
    assert R.pairwise_avg(df, keys=CELL).first().value == pytest.approx(5.375)


def test_five_readings_never_flag(spark):
    assert O.std_flag(cell(spark, [0, 0, 0, 0, 100])).where("is_outlier").count() == 0


def test_six_readings_flag_spike(spark):
    flagged = O.std_flag(cell(spark, [0, 0, 0, 0, 0, 100])).where("is_outlier")
    assert values(flagged) == [100.0]


def test_threshold_strictness(spark):
    # mean 0, sample sd exactly 1: -2 and 2 sit on the thresholds
    c = cell(spark, [2, -2, 0, 0, 0, 0, 0, 0, 0])
    assert values(O.std_keep_inside(c)) == [0.0] * 7
    assert O.std_remove_outliers(c).count() == 9
    assert O.std_removed(c).count() == 0
    assert O.std_flag(c).where("is_outlier").count() == 0


def test_seeded_min_max(spark):
    pos = R.slot_reductions(cell(spark, [3, 5]).drop("win"), 60).first()
    assert (pos.min_seed0, pos.min, pos.max_seed0, pos.max) == (0.0, 3.0, 5.0, 5.0)
    neg = R.slot_reductions(cell(spark, [-3, -5]).drop("win"), 60).first()
    assert (neg.min_seed0, neg.min, neg.max_seed0, neg.max) == (-5.0, -5.0, 0.0, -3.0)


def _ms(h, m, s):
    return int(datetime(2024, 1, 1, h, m, s, tzinfo=timezone.utc).timestamp() * 1000)


def test_slot_floor(spark):
    df = spark.createDataFrame([(_ms(10, 59, 31),)], "t long")
    r = df.select(slot_floor_ms("t", 5).alias("s5"), slot_floor_ms("t", 7).alias("s7"),
                  slot_floor_ms("t", 90).alias("s90"), window_start_ms("t", "5 minutes").alias("w5")).first()
    assert r.s5 == _ms(10, 55, 0) == r.w5
    assert r.s7 == _ms(10, 56, 0)
    assert r.s90 == _ms(10, 0, 0)


def test_int_mean_truncates(spark):
    df = cell(spark, [1.5, 2.5]).drop("win")
    assert R.window_int_mean(df, "1 day").first().value == 1.0
    df = cell(spark, [-1.5, -2.5]).drop("win")
    assert R.window_int_mean(df, "1 day").first().value == -1.0
    # mixed signs follow the ordered fold: 0 -> 5 -> -2 -> 0
    df = cell(spark, [5.5, -7.2, 1.9]).drop("win")
    assert R.window_int_mean(df, "1 day").first().value == 0.0


def test_summary_columns(spark):
    s = R.window_summary(cell(spark, [1, 2, 6]).drop("win"), "1 day").first()
    assert (s["count"], s["sum"], s["min"], s["max"], s["average"]) == (3, 9.0, 1.0, 6.0, 3.0)


def test_distinct_counts(spark):
    df = cell(spark, [1, 2, 3], step=61_000).drop("win").unionByName(cell(spark, [4], urn="v").drop("win"))
    r = R.distinct_counts(df, 1).first()
    assert (r.urns, r.slots, r.pairs) == (2, 3, 4)


def test_multi_flags_match_single(spark):
    df = cell(spark, [0, 0, 0, 0, 0, 100]).withColumn("other", F.col("value") * -1)
    both = O.std_flags(df, {"a": "value", "b": "other"}).where("a AND b").count()
    assert both == 1


def test_int_mean_streamed_path_matches_array_fold(spark, conf):
    from conftest import SF001
    from sensorlytics.sources import fixtures as X
    r = X.readings_signed(spark, SF001)
    want = {(x.urn, x.timestamp): x.value for x in R.window_int_mean(r, "1 day").collect()}
    conf("sensorlytics.skew.rowsPerTask", "5")   # every mixed-sign cell takes the streamed fold
    got = {(x.urn, x.timestamp): x.value for x in R.window_int_mean(r, "1 day").collect()}
    assert got == want and len(got) > 0
