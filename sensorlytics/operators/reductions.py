"""Reductions per cell: summaries, means, seeded min/max, distinct counts, ordered fold.

All of them are hash aggregates with a partial (map-side) step, so a hot cell is reduced
on every input partition before the shuffle. The order-dependent pairwise fold merges
summaries of chunks of the time order, so no cell is sorted or folded in one task.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlytics.functions import intfold, pairfold
from sensorlytics.operators.cells import CELL, keyed, time_order, with_slot, with_window
from sensorlytics.plans import tuning
from sensorlytics.plans.attach import freeze

INT_MAX = 2**31 - 1
INT_MIN = -(2**31)


def window_summary(rows: DataFrame, width: str | int, value: str = "value") -> DataFrame:
    """Per (urn, window): urn, start, average, min, max, count, sum."""
    v = F.col(value)
    return (with_window(rows, width).groupBy("urn", "win")
            .agg(F.sum(v).alias("sum"), F.count(v).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"))
            .select("urn", F.col("win").alias("start"), (F.col("sum") / F.col("count")).alias("average"),
                    "min", "max", "count", "sum"))


def window_mean(rows: DataFrame, width: str | int, value: str = "value") -> DataFrame:
    """Per (urn, window): mean of the readings, stamped with the window start."""
    return (with_window(rows, width).groupBy("urn", "win").agg(F.avg(value).alias("value"))
            .select("urn", F.col("win").alias("timestamp"), "value"))


def window_int_mean(rows: DataFrame, width: str | int, value: str = "value") -> DataFrame:
    """Mean with a running 32-bit integer sum that truncates toward zero at every step.

    For a cell whose readings are all >= 0 the running sum only ever adds ``floor(v)``
    and saturates at 2^31-1; all <= 0 adds ``ceil(v)`` and saturates at -2^31. That closed
    form is one partial aggregate. A cell with mixed signs depends on the arrival order;
    its answer is the ordered fold over (timestamp, seq), or (timestamp, value) where readings
    have no ``seq``. NULL readings count in no cell, in every form. Cells of at most
    ``sensorlytics.skew.rowsPerTask`` readings fold a sorted array JVM-side; larger ones
    stream their sorted readings through a carried accumulator (``functions.intfold``),
    one task per such cell because the fold is sequential, but without holding the cell.
    """
    v = F.col(value)
    if "seq" not in rows.columns:
        rows = rows.withColumn("seq", F.lit(0).cast("long"))
    cells = with_window(rows.where(v.isNotNull()), width)
    # per-cell aggregate, frozen: it feeds the closed form and both mixed-sign branches
    agg = freeze(cells.groupBy("urn", "win").agg(
        F.count(v).alias("n"), F.min(v).alias("vmin"), F.max(v).alias("vmax"),
        F.sum(F.floor(v)).alias("sfloor"), F.sum(F.ceil(v)).alias("sceil")))
    pos = F.least(F.col("sfloor"), F.lit(INT_MAX))
    neg = F.greatest(F.col("sceil"), F.lit(INT_MIN))
    acc = F.when(F.col("vmin") >= 0, pos).when(F.col("vmax") <= 0, neg)
    # Java int division truncates toward zero
    q = F.when(acc >= 0, F.floor(acc / F.col("n"))).otherwise(-F.floor(-acc / F.col("n")))
    closed = agg.where(acc.isNotNull()).select("urn", F.col("win").alias("timestamp"),
                                               q.cast("double").alias("value"))
    limit = tuning.get_int(rows.sparkSession, tuning.ROWS_PER_TASK)
    mixed = agg.where(acc.isNull())
    small = mixed.where(F.col("n") <= limit).select("urn", "win")
    out = closed.unionByName(_mixed_sign_int_mean(cells.join(small, ["urn", "win"], "left_semi"), value))
    large = mixed.where(F.col("n") > limit).select("urn", "win")
    if large.limit(1).count():
        # at most total / rowsPerTask cells can be this large: a bounded broadcast
        out = out.unionByName(_streamed_int_mean(cells.join(F.broadcast(large), ["urn", "win"], "left_semi"),
                                                 value))
    return out


def _streamed_int_mean(cells: DataFrame, value: str) -> DataFrame:
    """Large mixed-sign cells: sequential fold over the time-sorted readings, streamed."""
    # ship the small fold module with the function itself, so executors need no install
    cloudpickle.register_pickle_by_value(intfold)
    ordered = (cells.select("urn", "win", "timestamp", "seq", F.col(value).alias("value"))
               .repartition("urn", "win").sortWithinPartitions("urn", "win", "timestamp", "seq", "value"))
    return ordered.mapInPandas(intfold.fold_sorted_cells, "urn string, timestamp long, value double")


def _mixed_sign_int_mean(cells: DataFrame, value: str) -> DataFrame:
    """Ordered truncating fold for mixed-sign cells of at most ``rowsPerTask`` readings:
    a time-sorted array per cell, folded with ``aggregate`` (JVM-side)."""
    def step(acc, x):
        t = acc + x.getField("v")
        return (F.when(F.isnan(t), F.lit(0)).when(t >= F.lit(INT_MAX), F.lit(INT_MAX))
                .when(t <= F.lit(INT_MIN), F.lit(INT_MIN)).otherwise(t.cast("long")).cast("long"))

    ordered = F.array_sort(F.collect_list(F.struct(F.col("timestamp").alias("t"), F.col("seq").alias("s"),
                                                   F.col(value).alias("v"))))
    g = cells.groupBy("urn", "win").agg(ordered.alias("xs"), F.count(F.lit(1)).alias("n"))
    total = F.aggregate("xs", F.lit(0).cast("long"), step)
    q = F.when(total >= 0, F.floor(total / F.col("n"))).otherwise(-F.floor(-total / F.col("n")))
    return g.select("urn", F.col("win").alias("timestamp"), q.cast("double").alias("value"))


def slot_reductions(rows: DataFrame, slot_minutes: int, value: str = "value") -> DataFrame:
    """JOB10's reductions per (urn, slot) in one aggregate: sum, average, min/max seeded
    with 0.0 and plain min/max."""
    v = F.col(value)
    return (with_slot(rows, slot_minutes).groupBy("urn", "win")
            .agg(F.sum(v).alias("sum"), F.avg(v).alias("average"), F.min(v).alias("min"), F.max(v).alias("max"))
            .select("urn", F.col("win").alias("timestamp"), "sum", "average",
                    F.least(F.lit(0.0), F.col("min")).alias("min_seed0"), "min",
                    F.greatest(F.lit(0.0), F.col("max")).alias("max_seed0"), "max"))


def batch_group_mean(rows: DataFrame, slot_minutes: int, value: str = "value") -> DataFrame:
    """Mean per (urn, slot), stamped with the slot."""
    return (with_slot(rows, slot_minutes).groupBy("urn", "win").agg(F.avg(value).alias("value"))
            .select("urn", F.col("win").alias("timestamp"), "value"))


def distinct_counts(rows: DataFrame, slot_minutes: int) -> DataFrame:
    """Number of distinct urns, slots and (urn, slot) pairs: one row.

    The pairs are deduplicated first (a hash aggregate with a map-side partial step, so
    only distinct pairs per partition are shuffled); the two remaining distinct counts run
    over the pairs, which are far fewer than the readings.
    """
    pairs = with_slot(rows.select("urn", "timestamp"), slot_minutes).select("urn", "win").distinct()
    return pairs.agg(F.count_distinct("urn").alias("urns"), F.count_distinct("win").alias("slots"),
                     F.count(F.lit(1)).alias("pairs"))


# ---- pairwise running average: chunk summaries (first, k, c), see functions.pairfold ----

def _weight(k: str) -> Column:
    return F.pow(F.lit(0.5), F.least(F.col(k), F.lit(-pairfold.LEAST_EXPONENT)))


def pairwise_summary(rows: DataFrame, keys: list[str], value: str = "value", order: list[str] | None = None) -> DataFrame:
    """Per cell the summary ``(first, k, c, first_ts)`` of its readings in ``order``.

    Rows are range-partitioned and sorted by cell and order, so a hot cell is spread over many
    tasks; each streams its rows into one summary per cell, and the summaries of a cell (at most
    one per partition) are merged in the order of the partitions. NULL readings are left out.
    """
    rows = keyed(rows, keys).where(F.col(value).isNotNull())
    order = order or time_order(rows, value)
    n = len(keys)
    p = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ts = F.col("timestamp").cast("long") if "timestamp" in rows.columns else F.lit(None).cast("long")
    # aliases: an order column may be the value or the timestamp
    carried = rows.select(*keys, F.col(value).cast("double").alias("_v"), ts.alias("_ts"),
                          *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    by = [*keys, *[f"_o{i}" for i in range(len(order))]]
    ordered = carried.repartitionByRange(p, *by).sortWithinPartitions(*by).select(*keys, "_v", "_ts")
    cloudpickle.register_pickle_by_value(pairfold)

    def run(batches):
        from pyspark import TaskContext
        return pairfold.summarise(batches, n, TaskContext.get().partitionId())

    schema = T.StructType([rows.schema[k] for k in keys])
    for name, kind in (("part", "integer"), ("first", "double"), ("k", "long"), ("c", "double"), ("first_ts", "long")):
        schema = schema.add(name, kind)
    chunks = ordered.mapInArrow(run, schema)
    listed = chunks.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("part", "first", "k", "c"))).alias("xs"), F.min("first_ts").alias("first_ts"))

    def merge(acc, x):
        w = F.pow(F.lit(0.5), F.least(x.getField("k"), F.lit(-pairfold.LEAST_EXPONENT)))
        return F.struct((acc.getField("k") + x.getField("k")).alias("k"),
                        (acc.getField("c") * w + x.getField("c")).alias("c"))

    zero = F.struct(F.lit(0).cast("long").alias("k"), F.lit(0.0).alias("c"))
    merged = listed.select(*keys, F.col("xs")[0].getField("first").alias("first"),
                           F.aggregate("xs", zero, merge).alias("m"), "first_ts")
    return merged.select(*keys, "first", F.col("m.k").alias("k"), F.col("m.c").alias("c"), "first_ts")


def pairwise_merge(earlier: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    """Summaries of ``later``'s cells, each continued from its cell in ``earlier`` where there is one."""
    a = earlier.select(*keys, *[F.col(c).alias(f"_{c}") for c in ("first", "k", "c", "first_ts")])
    return later.join(a, keys, "left").select(
        *keys, F.coalesce("_first", "first").alias("first"), (F.coalesce("_k", F.lit(0)) + F.col("k")).alias("k"),
        (F.coalesce("_c", F.lit(0.0)) * _weight("k") + F.col("c")).alias("c"),
        F.least("_first_ts", "first_ts").alias("first_ts"))


def pairwise_value() -> Column:
    """The fold's result from a summary."""
    return F.col("first") * _weight("k") + F.col("c")


def pairwise_avg(rows: DataFrame, width: str | int | None = None, value: str = "value",
                 keys: list[str] | None = None, order: list[str] | None = None,
                 first_ts: bool = False) -> DataFrame:
    """Left fold ``(acc + v) / 2`` over each cell in time order, from merged chunk summaries.

    ``first_ts`` adds the earliest reading's ``timestamp`` (as the processing-time job reports it).
    """
    if width is not None:
        rows = with_window(rows, width)
    keys = keys or CELL
    out = pairwise_summary(rows, keys, value, order)
    return out.select(F.col(keys[0]).alias("urn"), F.col(keys[1]).alias("timestamp"), pairwise_value().alias("value"),
                      *(["first_ts"] if first_ts else []))
