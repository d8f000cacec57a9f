"""Quartiles of large cells by selection: same answers as sorting, and no reading sorted, shuffled or copied."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from sensorlytics.operators import outliers as O
from sensorlytics.operators.cells import CELL, with_window
from sensorlytics.plans import jobs as J
from sensorlytics.plans import ranking, selection
from sensorlytics.sources import fixtures as X

INF = float("inf")


def shapes():
    rng = random.Random(11)
    return {
        "even": [rng.random() for _ in range(700)],
        "ties": [float(rng.randrange(3)) for _ in range(500)],
        "one value": [4.25] * 300,
        "signs": [rng.gauss(0, 5) for _ in range(401)],
        "magnitudes": [rng.choice((-1, 1)) * 2.0 ** rng.randrange(-1070, 1020) for _ in range(350)],
        "widest": [-1.7e308, 1.7e308] * 60 + [0.0, 5e-324, 1e-323, -5e-324] * 60,
        "infinite": [-INF] * 90 + [INF] * 90 + [rng.random() for _ in range(60)],
        "nan": [float("nan")] * 80 + [INF] * 3 + [rng.random() for _ in range(217)],
        "nulls": [None] * 90 + [rng.random() for _ in range(130)],
        "all null": [None] * 200,
        "small": [1.0, 2.0, 9.0],
    }


def placed(x):
    """Sort place of a value: NULL first, NaN last."""
    return (0, 0.0) if x is None else (2, 0.0) if math.isnan(x) else (1, x)


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


@pytest.mark.parametrize("buckets,per_task", [(1024, 100), (16, 100), (1024, 1)])
def test_selected_ranks_are_those_of_the_sorted_cell(spark, monkeypatch, buckets, per_task):
    monkeypatch.setattr(selection, "BUCKETS", buckets)
    cells = shapes()
    if buckets < 1024:  # more passes
        cells = {k: cells[k] for k in ("even", "ties", "infinite")}
    rows = [(name, v, i) for name, values in cells.items() for i, v in enumerate(values)]
    random.Random(5).shuffle(rows)
    df = spark.createDataFrame(rows, "urn string, value double, seq long").repartition(5)
    ranks = {"a": F.lit(1), "b": F.floor(F.col("n") / 4), "c": F.floor(F.col("n") / 4) + 1, "d": F.col("n")}
    large = selection.large_cells(df, ["urn"], "value", per_task)
    narrowed, passes = selection._narrowed, []
    monkeypatch.setattr(selection, "_narrowed", lambda *a, **k: passes.append(k) or narrowed(*a, **k))
    got = {r.urn: r for r in selection.select_ranks(df, large, ["urn"], "value", ranks, per_task).collect()}
    assert len(passes) <= 10
    assert set(got) == {k for k, x in cells.items() if len(x) > per_task}
    for name, r in got.items():
        x = sorted(cells[name], key=placed)
        n = len(x)
        assert r.n == n
        for want, have in zip((x[0], x[max(n // 4, 1) - 1] if n >= 4 else None, x[n // 4], x[-1]), (r.a, r.b, r.c, r.d)):
            assert same(want, have), (name, want, have)


def test_selected_ranks_of_integers_beyond_doubles(spark):
    base = 2 ** 60
    df = spark.range(0, 900, 1, 4).select(F.lit("u").alias("urn"), (F.lit(base) + (F.col("id") * 7) % 900).alias("value"))
    large = selection.large_cells(df, ["urn"], "value", 10)
    ranks = {"a": F.lit(1), "m": F.lit(450), "z": F.col("n")}
    r = selection.select_ranks(df, large, ["urn"], "value", ranks, 10).first()
    assert (r.a, r.m, r.z) == (base, base + 449, base + 899)
    cents = df.select("urn", (F.col("value") / 100).cast("decimal(30,2)").alias("value"))
    large = selection.large_cells(cents, ["urn"], "value", 10)
    want = [r.value for r in cents.orderBy("value").collect()]
    r = selection.select_ranks(cents, large, ["urn"], "value", ranks, 10).first()
    assert (r.a, r.m, r.z) == (want[0], want[449], want[899])


def hot_day(spark):
    r = X.readings(spark, SF01)
    return with_window(r.withColumn("urn", F.when(F.col("seq") % 3 == 0, F.lit("hot")).otherwise(F.col("urn"))), "30 days")


@pytest.mark.parametrize("per_task", [1, 40, 300])
def test_hot_cells_keep_the_same_readings_without_a_sort(spark, conf, monkeypatch, per_task):
    df = hot_day(spark)
    want = sorted(r.seq for r in O.iqr_keep_inside(df).collect())
    pairs = sorted(map(tuple, J.iqr_summary_raw_vs_clean(df.drop("win"), "30 days").select("urn", "start", "kind", "count", "min", "max").collect()))
    frozen = []

    def recorded(table, *a, **k):
        out = keep(table, *a, **k)
        frozen.append(out.count())
        return out

    keep = selection.freeze
    monkeypatch.setattr(selection, "freeze", recorded)
    monkeypatch.setattr(ranking, "_rank_by_range", None)  # the sort of all readings must not be reached
    conf("sensorlytics.skew.rowsPerTask", per_task)
    got = O.iqr_keep_inside(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "BroadcastHashJoin" in plan
    assert sorted(r.seq for r in got.collect()) == want
    assert sorted(map(tuple, J.iqr_summary_raw_vs_clean(df.drop("win"), "30 days").select(
        "urn", "start", "kind", "count", "min", "max").collect())) == pairs
    cells = df.select(*CELL).distinct().count()
    assert frozen and max(frozen) <= 4 * cells  # four ranks a cell, never the readings
