"""Experiment reports: runtimes per grid point and power per run.

Inputs are two small relational tables, ``experiment(id, name, suite)`` and
``experiment_run(experiment_id, run, time)`` (time in ms), and power samples
``(run, node, watts)``. The run table is joined to the experiment table with a plain
equi-join; Catalyst broadcasts the experiment side when its statistics say it is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _runs(experiments: DataFrame, runs: DataFrame, suite: str | None) -> DataFrame:
    e = experiments if suite is None else experiments.where(F.col("suite") == F.lit(suite))
    return e.join(runs, e.id == runs.experiment_id, "inner").drop("experiment_id")


def runtimes_summary(experiments: DataFrame, runs: DataFrame, suite: str) -> DataFrame:
    """Per (suite, name): min, max and ``sum - min - max`` (the middle run of three) as
    ``median_time``, plus the true ``median``; ordered by suite, name."""
    g = (_runs(experiments, runs, suite).groupBy("suite", "name")
         .agg(F.min("time").alias("min_time"), F.max("time").alias("max_time"),
              F.sum("time").alias("_sum"), F.median("time").alias("median")))
    return (g.select("suite", "name", "min_time", "max_time",
                     (F.col("_sum") - F.col("min_time") - F.col("max_time")).alias("median_time"), "median")
            .orderBy("suite", "name"))


def runtimes_stats(experiments: DataFrame, runs: DataFrame) -> DataFrame:
    """Per (suite, name), in seconds: average (2 dp, DECIMAL(18,2)), median, max, min and the
    number of runs; ordered by name, suite."""
    t = F.col("time")
    return (_runs(experiments, runs, None).groupBy("suite", "name")
            .agg(F.round(F.avg(t) / 1000.0, 2).cast("decimal(18,2)").alias("average"),
                 (F.median(t) / 1000.0).alias("median"), (F.max(t) / 1000.0).alias("max"),
                 (F.min(t) / 1000.0).alias("min"), F.count(F.lit(1)).alias("number_of_runs"))
            .select("name", "suite", "average", "median", "max", "min", "number_of_runs")
            .orderBy("name", "suite"))


def runtimes_runs(experiments: DataFrame, runs: DataFrame) -> DataFrame:
    """Every run: name, suite, runtime (ms), run."""
    return _runs(experiments, runs, None).select("name", "suite", F.col("time").alias("runtime"), "run")


def grid_point(name_col: str = "name") -> tuple:
    """Worker count and task slots from an experiment name such as ``gb.top008-4``."""
    parts = F.split(F.col(name_col), "-")
    workers = F.regexp_replace(F.regexp_replace(F.get(parts, 0), "[^0-9]", ""), "^0+(?!$)", "")
    slots = F.regexp_replace(F.get(parts, 1), "^0+(?!$)", "")
    return workers, slots


def runtimes_csv(experiments: DataFrame, runs: DataFrame, suite: str) -> DataFrame:
    """CSV rows ``Worker, TaskSlots, Run, Runtime_ms`` of a suite, ordered by suite, name."""
    workers, slots = grid_point()
    return (_runs(experiments, runs, suite).orderBy("suite", "name")
            .select(workers.alias("worker"), slots.alias("task_slots"), "run", F.col("time").alias("runtime_ms")))


def power_by_run(samples: DataFrame) -> DataFrame:
    """Average watts per node over a run, then their sum per run (two partial aggregates)."""
    per_node = samples.groupBy("run", "node").agg(F.avg("watts").alias("avg_watts"))
    return per_node.groupBy("run").agg(F.count(F.lit(1)).alias("nodes"),
                                       F.sum("avg_watts").alias("total_avg_watts"))
