"""Attach a per-cell table (one row per cell) to the readings of those cells.

The per-cell table is always built with partial aggregation, so it is skew-proof. The
join back to the readings is where one hot cell (say a third of all readings) would land
in a single task under a plain shuffle join. Two shapes avoid that:

* the cell table is small (rows counted by an action × row width from the schema, checked
  against ``sensorlytics.broadcast.maxBytes``, default ``spark.sql.autoBroadcastJoinThreshold``)
  and its cells average at least ``sensorlytics.broadcast.minRowsPerCell`` readings:
  broadcast hash join, the readings are never shuffled;
* no cell holds more than ``rowsPerTask`` readings: a plain shuffle join is balanced;
* otherwise a shuffle join on ``(cell, salt)``: cells with more than ``rowsPerTask``
  readings are fanned out over ``ceil(n / rowsPerTask)`` salts. The list of hot cells
  is itself bounded by ``total / rowsPerTask`` rows (rowsPerTask is raised until that
  bound fits the broadcast limit), so broadcasting it is safe. Salts come from a hash of
  the reading's own columns, so a recomputed task sends every row to the same place.
"""

from __future__ import annotations

import atexit
import math
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlytics.plans import tuning
from sensorlytics.session import ensure_checkpoint_dir, scratch_path


def freeze(df: DataFrame, adaptive: bool = True) -> DataFrame:
    """Materialise a table that several actions read, cutting its lineage.

    ``sensorlytics.freeze``: ``checkpoint`` (default) uses a reliable RDD checkpoint in
    ``spark.checkpoint.dir``; ``table`` writes compressed parquet to a fresh folder there and
    reads it back (removed when the driver exits); ``persist`` caches (recomputed from
    lineage if an executor is lost).

    ``adaptive=False`` runs the materialising action with AQE off: for a range-partitioned
    input AQE re-plans the exchange and samples the input a second time, while a fixed
    partition count leaves it nothing to adapt.
    """
    spark = df.sparkSession
    mode = tuning.get_str(spark, tuning.FREEZE_MODE)
    if mode == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        with _adaptive(spark, adaptive):
            out.count()
        return out
    if mode == "checkpoint":
        ensure_checkpoint_dir(spark)
        with _adaptive(spark, adaptive):
            return df.checkpoint(eager=True)
    path = scratch_path(spark, "frozen")
    with _adaptive(spark, adaptive):
        df.write.parquet(path)
    _remove_at_exit(spark, path)
    return spark.read.parquet(path)


_TO_REMOVE: list[str] = []


def _remove_at_exit(spark, path: str) -> None:
    """Delete frozen tables when the driver exits (Hadoop FS, so any shared store works)."""
    if not _TO_REMOVE:
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

        def cleanup() -> None:
            for p in _TO_REMOVE:
                try:
                    jp = jvm.org.apache.hadoop.fs.Path(p)
                    jp.getFileSystem(conf).delete(jp, True)
                except Exception:  # the JVM may already be gone; the folder is scratch
                    pass

        atexit.register(cleanup)
    _TO_REMOVE.append(path)


@contextmanager
def _adaptive(spark, enabled: bool):
    key = "spark.sql.adaptive.enabled"
    if enabled:
        yield
        return
    old = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, old)


def probe(table: DataFrame, keys: list[str], count_col: str = "n") -> dict:
    """Decide the join shape for a frozen cell table with one small action.

    Returns ``{"shape": "broadcast" | "shuffle" | "salted", "per_task": int, "bounded": bool}``:
    ``bounded`` (always true for ``shuffle``) means no cell holds more than ``per_task``
    readings, so any plan that puts a whole cell in one task is bounded by ``per_task`` rows.
    """
    spark = table.sparkSession
    limit = tuning.broadcast_limit(spark)
    # one small global aggregate; without AQE it is one job instead of a map job + a result job
    with _adaptive(spark, False):
        n_cells, total, biggest = table.agg(F.count(F.lit(1)), F.sum(count_col), F.max(count_col)).first()
    total, biggest = total or 0, biggest or 0
    hot_row = tuning.row_bytes(table.select(*keys).schema) + 8  # a hot-list row: keys + fan
    # the hot list has a bound of its own: salting must work where broadcasts are switched off
    max_hot = max(tuning.HOT_LIST_BYTES // hot_row, 1)
    per_task = max(tuning.get_int(spark, tuning.ROWS_PER_TASK), math.ceil(total / max_hot), 1)
    dense = total >= n_cells * tuning.get_int(spark, tuning.MIN_ROWS_PER_CELL)
    if limit > 0 and n_cells * tuning.row_bytes(table.schema) <= limit and dense:
        shape = "broadcast"
    elif biggest <= per_task:
        shape = "shuffle"
    else:
        shape = "salted"
    return {"shape": shape, "per_task": per_task, "bounded": biggest <= per_task}


def attach(rows: DataFrame, table: DataFrame, keys: list[str], count_col: str = "n",
           salt_cols: list[str] | None = None, decided: dict | None = None) -> DataFrame:
    """Inner-join ``table`` (unique on ``keys``, with a reading count ``count_col``) to ``rows``.

    Salts hash ``salt_cols`` (default: all columns of ``rows``); include a unique column so
    that identical readings of a hot cell are spread too.

    ``table`` should be frozen (:func:`freeze`): :func:`probe` reads its row count, total
    and largest cell with one small action.
    """
    d = decided or probe(table, keys, count_col)
    if d["shape"] == "broadcast":
        return rows.join(F.broadcast(table), keys, "inner")
    if d["shape"] == "shuffle":
        # no cell exceeds one task's share: a plain shuffle join is balanced
        return rows.join(table.hint("merge"), keys, "inner")
    per_task = d["per_task"]
    # at most total / per_task cells qualify (per_task was raised until that many fit), so this broadcast is bounded by tuning.HOT_LIST_BYTES
    hot = (table.where(F.col(count_col) > per_task)
           .select(*keys, F.ceil(F.col(count_col) / F.lit(per_task)).cast("int").alias("_fan")))
    fan = F.coalesce(F.col("_fan"), F.lit(1))
    salt_src = F.xxhash64(*[F.col(c) for c in (salt_cols or rows.columns)])
    salted_rows = (rows.join(F.broadcast(hot), keys, "left")
                   .withColumn("_salt", F.pmod(salt_src, fan).cast("int")).drop("_fan"))
    salted_table = (table.join(F.broadcast(hot), keys, "left")
                    .withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan"))
    return salted_rows.join(salted_table.hint("merge"), keys + ["_salt"], "inner").drop("_salt")
