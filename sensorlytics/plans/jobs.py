"""The eleven jobs of the reference as DataFrame pipelines (batch form).

Each function takes readings ``(urn, value, timestamp)``, with a unique ``seq`` where the
source has one — or a previous job's output — plus its parameters, and returns a lazy DataFrame. Window widths are
parameters: the reference's defaults (5 minutes, 60 minutes) are kept as defaults.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.operators import outliers as O
from sensorlytics.operators import reductions as R
from sensorlytics.functions.timecols import window_start_ms
from sensorlytics.operators.cells import CELL, id_columns, with_slot, with_window
from sensorlytics.plans.attach import freeze

# The reference's default widths and 2-sigma factor.
LEVEL1_WIDTH = "5 minutes"
LEVEL2_WIDTH = "60 minutes"
BATCH_SLOT_MINUTES = 5
DISTINCT_SLOT_MINUTES = 1
PROC_TIME_WIDTH = "10 seconds"
K_SIGMA = 2.0


def _cell_rows(cells: DataFrame) -> DataFrame:
    """The columns the 2-sigma flag needs, plus the unique ``seq`` when there is one: salts
    hash a row's columns, and ``seq`` keeps repeated values of a hot cell apart."""
    return cells.select("urn", "win", "value", *(["seq"] if "seq" in cells.columns else []))


def outliers_level1(rows: DataFrame, width: str | int = LEVEL1_WIDTH, k: float = K_SIGMA) -> DataFrame:
    """JOB1: per (urn, window) the number of readings and of 2-sigma outliers."""
    flagged = O.std_flag(_cell_rows(with_window(rows, width)), CELL, "value", k)
    return (O.outlier_counts(flagged, CELL)
            .select("urn", F.col("win").alias("timestamp"), "values_count", "outliers_count"))


def _level1_cells(level1: DataFrame, width: str | int) -> DataFrame:
    """Level-1 counts keyed by their level-2 window, frozen: the second level reads them
    twice (statistics, then flags), and recomputing them would rescan all readings."""
    return freeze(with_window(level1, width, ts="timestamp", out="win2"))


def _level2(level1: DataFrame, width: str | int, k: float) -> DataFrame:
    cells = _level1_cells(level1, width)
    flagged = O.std_flags(cells, {"f_v": "values_count", "f_o": "outliers_count"}, ["urn", "win2"], k)
    return (flagged.groupBy("urn", "win2")
            .agg(F.count(F.lit(1)).alias("intervals"), F.count_if("f_v").alias("outliers_on_values_count"),
                 F.count_if("f_o").alias("outliers_on_outliers_count"))
            .withColumnRenamed("win2", "timestamp"))


def outliers_on_values(level1: DataFrame, width: str | int = LEVEL2_WIDTH, k: float = K_SIGMA) -> DataFrame:
    """JOB2, first branch: level-1 intervals per level-2 window and how many have an
    outlying ``values_count``."""
    cells = _level1_cells(level1, width)
    flagged = O.std_flag(cells, ["urn", "win2"], "values_count", k, flag="f")
    return (flagged.groupBy("urn", "win2")
            .agg(F.count(F.lit(1)).alias("values_count"), F.count_if("f").alias("outliers_on_values_count"))
            .select("urn", F.col("win2").alias("timestamp"), "values_count", "outliers_on_values_count"))


def outliers_on_outliers(level1: DataFrame, width: str | int = LEVEL2_WIDTH, k: float = K_SIGMA) -> DataFrame:
    """JOB2, second branch: same on ``outliers_count``."""
    cells = _level1_cells(level1, width)
    flagged = O.std_flag(cells, ["urn", "win2"], "outliers_count", k, flag="f")
    return (flagged.groupBy("urn", "win2")
            .agg(F.count(F.lit(1)).alias("outliers_count"), F.count_if("f").alias("outliers_on_outliers_count"))
            .select("urn", F.col("win2").alias("timestamp"), "outliers_count", "outliers_on_outliers_count"))


def outliers_two_level(rows: DataFrame, width1: str | int = LEVEL1_WIDTH, width2: str | int = LEVEL2_WIDTH,
                       k: float = K_SIGMA) -> DataFrame:
    """JOB1 → JOB2 in one plan: both second-level branches share one attach."""
    return _level2(outliers_level1(rows, width1, k), width2, k).select(
        "urn", "timestamp", "intervals", "outliers_on_values_count", "outliers_on_outliers_count")


def _summary_pair(marked: DataFrame) -> DataFrame:
    """Summaries of all readings of a cell (raw) and of those marked ``inside`` (clean), one aggregate for both."""
    v = F.col("value")
    kept = F.when(F.col("inside"), v)
    cells = marked.groupBy("urn", "win").agg(*[f(x).alias(f"{name}_{kind}") for kind, x in (("raw", v), ("clean", kept))
                                               for name, f in (("sum", F.sum), ("count", F.count), ("min", F.min), ("max", F.max))])
    kinds = [F.struct(F.lit(kind).alias("kind"), *[F.col(f"{name}_{kind}").alias(name) for name in ("sum", "count", "min", "max")])
             for kind in ("raw", "clean")]
    rows = cells.select("urn", "win", F.explode(F.array(*kinds)).alias("s")).where("s.count > 0")
    return rows.select("urn", F.col("win").alias("start"), (F.col("s.sum") / F.col("s.count")).alias("average"),
                       "s.min", "s.max", "s.count", "s.sum", "s.kind")


def iqr_summary_raw_vs_clean(rows: DataFrame, width: str | int = LEVEL1_WIDTH) -> DataFrame:
    """JOB3: window summaries of the raw readings and of the IQR-cleaned readings."""
    return _summary_pair(O.iqr_mark_inside(_cell_rows(with_window(rows, width)), CELL))


def std_summary_raw_vs_clean(rows: DataFrame, width: str | int = LEVEL1_WIDTH, k: float = K_SIGMA) -> DataFrame:
    """JOB4: window summaries of the raw readings and of the 2-sigma strict-inside readings."""
    return _summary_pair(O.std_mark_inside(_cell_rows(with_window(rows, width)), CELL, "value", k))


def std_removed_summary(rows: DataFrame, width: str | int = LEVEL1_WIDTH, k: float = K_SIGMA) -> DataFrame:
    """JOB5: remove 2-sigma outliers (on-threshold readings stay), then summarise."""
    kept = O.std_remove_outliers(with_window(rows, width), CELL, "value", k).drop("win")
    return R.window_summary(kept, width)


def proc_time_pairwise_avg(rows: DataFrame, arrival_col: str = "arrival_ms",
                           width: str | int = PROC_TIME_WIDTH) -> DataFrame:
    """JOB7 (batch form): pairwise fold per (urn, arrival-time window); timestamp = the
    earliest reading's timestamp. ``arrival_col`` holds arrival epoch ms."""
    cells = rows.withColumn("win", window_start_ms(arrival_col, width))
    folded = R.pairwise_avg(cells, None, "value", CELL,
                          [arrival_col, *(id_columns(rows) or ["timestamp", "value"])], first_ts=True)
    return folded.select("urn", F.col("first_ts").alias("timestamp"), "value")


def batch_reductions(rows: DataFrame, slot_minutes: int = BATCH_SLOT_MINUTES) -> DataFrame:
    """JOB10: sum, average, seeded/plain min and max per (urn, slot) in one aggregate."""
    return R.slot_reductions(rows, slot_minutes)


def batch_outlier_values(rows: DataFrame, slot_minutes: int = BATCH_SLOT_MINUTES, k: float = K_SIGMA) -> DataFrame:
    """JOB10: the 2-sigma outlier readings of each (urn, slot)."""
    flagged = O.std_flag(with_slot(rows, slot_minutes), CELL, "value", k)
    return flagged.where("is_outlier").select("urn", F.col("win").alias("slot"), "value", "timestamp")


def batch_report(rows: DataFrame, slot_minutes: int = BATCH_SLOT_MINUTES, k: float = K_SIGMA) -> DataFrame:
    """JOB10's printed numbers: result rows of each reduction (one per (urn, slot) group) and
    the number of outlier readings, both from one per-group count of the flagged readings."""
    flagged = O.std_flag(_cell_rows(with_slot(rows, slot_minutes)), CELL, "value", k)
    per_group = O.outlier_counts(flagged, CELL)
    totals = per_group.agg(F.count(F.lit(1)).alias("groups"), F.sum("outliers_count").alias("outliers"))
    names = F.array(*[F.lit(x) for x in ("min", "max", "sum", "average")])
    g = totals.select(F.explode(names).alias("reduction"), F.col("groups").alias("result_rows"))
    o = totals.select(F.lit("outliers").alias("reduction"), F.col("outliers").cast("long").alias("result_rows"))
    return g.unionByName(o)
