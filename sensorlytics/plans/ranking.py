"""Rank readings inside their cell without sending a whole cell to one task.

``Window.partitionBy(cell).orderBy(...)`` puts every reading of a cell in one task; a hot
cell then serialises the job. Instead:

1. range-partition and sort on ``cell keys + order keys`` (the order keys must make the
   order total, e.g. end with a unique ``seq``), so a hot cell is spread over many
   partitions by the sampled range bounds;
2. tag each row with ``monotonically_increasing_id`` (partition id in the upper bits,
   position in the lower bits) and freeze the result, which fixes the order for every
   later action and recomputation;
3. count rows per (partition, cell) — at most ``cells + partitions`` rows — and turn them
   into offsets with a running sum per cell (a cell spans at most all partitions);
4. join the offsets back on (partition, cell): balanced, as no partition holds more
   than its share of rows.

When one aggregate over the cell sizes proves that no cell exceeds one task's share
(``plans.attach.probe``), ``row_number`` over the cell is bounded and cheaper (one shuffle
and sort, nothing frozen), and is used instead.

Returns the rows with ``rn`` (1-based rank in the cell) and ``n`` (cell size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorlytics.plans import tuning
from sensorlytics.plans.attach import freeze, probe

_LOW_BITS = (1 << 33) - 1


def size_probe(rows: DataFrame, keys: list[str]) -> dict:
    """One aggregate over the cell sizes (:func:`plans.attach.probe`): ``bounded`` and ``per_task``."""
    return probe(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)


def cells_bounded(rows: DataFrame, keys: list[str]) -> bool:
    """Does every cell fit one task's share?"""
    return size_probe(rows, keys)["bounded"]


def rank_by_window(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``rn`` / ``n`` with window functions; only for cells known to be bounded."""
    w = Window.partitionBy(*keys)
    return rows.select("*", F.row_number().over(w.orderBy(*order)).alias("rn"), F.count(F.lit(1)).over(w).alias("n"))


def rank_in_cells(rows: DataFrame, keys: list[str], order: list[str],
                  partitions: int | None = None, force_range: bool = False) -> DataFrame:
    if not force_range and cells_bounded(rows, keys):
        return rank_by_window(rows, keys, order)
    return _rank_by_range(rows, keys, order, partitions)


def _rank_by_range(rows: DataFrame, keys: list[str], order: list[str], partitions: int | None) -> DataFrame:
    spark = rows.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort_cols = [*keys, *order]
    tagged = (rows.repartitionByRange(p, *sort_cols)
              .sortWithinPartitions(*sort_cols)
              .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = freeze(tagged, adaptive=False)
    tagged = tagged.select("*", F.shiftright("_mid", 33).alias("_pid"),
                           F.col("_mid").bitwiseAND(F.lit(_LOW_BITS)).alias("_pos"))
    parts = (tagged.groupBy("_pid", *keys)
             .agg(F.count(F.lit(1)).alias("_np"), F.min("_pos").alias("_first")))
    by_cell = Window.partitionBy(*keys)
    running = by_cell.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_pid", *keys, "_first",
                         F.coalesce(F.sum("_np").over(running), F.lit(0)).alias("_before"),
                         F.sum("_np").over(by_cell).alias("n"))
    parts = freeze(parts)
    small = parts.count() * tuning.row_bytes(parts.schema) <= tuning.broadcast_limit(spark)
    # (partition, cell) keys are balanced by construction, so the non-broadcast case is a
    # plain shuffle join
    side = F.broadcast(parts) if small else parts.hint("merge")
    out = tagged.join(side, ["_pid", *keys], "inner")
    return out.withColumn("rn", F.col("_before") + F.col("_pos") - F.col("_first") + 1) \
              .drop("_mid", "_pid", "_pos", "_first", "_before")
