"""Cells: one sensor (``urn``) × one time bucket (``win``), and their statistics.

Statistics follow the reference semantics: sample standard deviation, 0 for a single
reading; a constant cell has mean = its value and sd = 0 exactly (plain ``avg`` of three
0.1's is 0.10000000000000002, which would flag every reading of the cell).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlytics.functions.timecols import slot_floor_ms, window_start_ms

CELL = ["urn", "win"]


def with_window(rows: DataFrame, width: str | int, ts: str = "timestamp", out: str = "win") -> DataFrame:
    """Add the epoch-aligned tumbling window start (epoch ms) of each reading."""
    return rows.withColumn(out, window_start_ms(ts, width))


def id_columns(rows: DataFrame) -> list[str]:
    """The unique ``seq`` of a reading, where its source has one (text readings have none)."""
    return ["seq"] if "seq" in rows.columns else []


def time_order(rows: DataFrame, value: str = "value") -> list[str]:
    """Time order of readings. Ties follow ``seq``; without it they follow the value, so only
    equal readings are left, which no operator tells apart."""
    return ["timestamp", *(id_columns(rows) or [value])]


def with_slot(rows: DataFrame, minutes: int, ts: str = "timestamp", out: str = "win") -> DataFrame:
    """Add the calendar slot (minute-of-hour floor) of each reading."""
    return rows.withColumn(out, slot_floor_ms(ts, minutes))


def stat_aggs(value: str = "value") -> list[Column]:
    """Partial-aggregatable statistics of a cell (count, mean, sd, min, max)."""
    v = F.col(value)
    return [F.count(v).alias("n"), F.avg(v).alias("_avg"), F.stddev_samp(v).alias("_sd"),
            F.min(v).alias("vmin"), F.max(v).alias("vmax")]


def guarded(stats: DataFrame, k: float = 2.0) -> DataFrame:
    """Turn raw aggregates into guarded ``mean``, ``sd`` and thresholds ``lo``/``hi``."""
    const = F.col("vmin") == F.col("vmax")
    mean = F.when(const, F.col("vmin")).otherwise(F.col("_avg"))
    sd = F.when(const, F.lit(0.0)).otherwise(F.coalesce(F.col("_sd"), F.lit(0.0)))
    return (stats.withColumn("mean", mean).withColumn("sd", sd).drop("_avg", "_sd")
            .withColumn("lo", F.col("mean") - F.lit(k) * F.col("sd"))
            .withColumn("hi", F.col("mean") + F.lit(k) * F.col("sd")))


def cell_stats(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0) -> DataFrame:
    """One row per cell: keys, n, vmin, vmax, mean, sd, lo, hi (partial + final aggregate)."""
    return guarded(rows.groupBy(*keys).agg(*stat_aggs(value)), k)


def keyed(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Readings of a cell: those without a NULL in ``keys`` (a reading of no sensor, or without a
    timestamp, is in no cell). Applied before any plan shape is chosen, so that all shapes agree."""
    return rows.dropna(subset=list(keys))
