"""Outlier rules per cell and outlier counting.

2-sigma rules (thresholds ``lo = mean - k*sd``, ``hi = mean + k*sd``):

* ``std_flag``            every reading, ``is_outlier = value < lo OR value > hi``
* ``std_mark_inside``     every reading and whether the next rule keeps it
* ``std_keep_inside``     readings with ``lo < value < hi`` (strict; a constant or
                          single-reading cell keeps nothing)
* ``std_remove_outliers`` readings that are not outliers (on-threshold readings stay)
* ``std_removed``         the removed readings (the reference logs them)

Quartile rule: ``iqr_keep_inside`` keeps ``q1 < value < q3`` with type-6 quartiles.

Plan: cell statistics by partial aggregation, frozen and probed once (``plans.attach``):
a small table is broadcast; if some cell is hot, the statistics are attached with a
hot-cell-salted shuffle join; otherwise (many cells, none above one task's share) with a
plain shuffle join. Readings with a NULL cell key are in no cell and leave every rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlytics.operators.cells import CELL, id_columns, keyed
from sensorlytics.plans.attach import attach, freeze, probe
from sensorlytics.plans.ranking import rank_by_window, rank_in_cells, size_probe
from sensorlytics.plans.selection import large_cells, select_ranks


def _with_bounds(rows: DataFrame, keys: list[str], value: str, k: float) -> DataFrame:
    return _bounds_for(rows, keys, {"": value}, k)


def _bounds_for(rows: DataFrame, keys: list[str], values: dict[str, str], k: float) -> DataFrame:
    """``rows`` plus ``lo{sfx}`` / ``hi{sfx}`` thresholds for each ``{sfx: value column}``.

    The cell statistics are a partial aggregate, frozen and probed once; every shape attaches
    this one table, so a reading is judged by the same thresholds however large the data is.
    """
    rows = keyed(rows, keys)
    aggs = [F.count(F.lit(1)).alias("n")]
    for sfx, value in values.items():
        v = F.col(value)
        aggs += [F.avg(v).alias(f"_a{sfx}"), F.stddev_samp(v).alias(f"_s{sfx}"),
                 F.min(v).alias(f"_mn{sfx}"), F.max(v).alias(f"_mx{sfx}")]
    raw = rows.groupBy(*keys).agg(*aggs)
    stats = freeze(raw.select(*keys, "n", *[c for sfx in values for c in _guarded(sfx, k)]))
    return attach(rows, stats, keys, decided=probe(stats, keys))


def _guarded(sfx: str, k: float) -> list[Column]:
    """Guarded thresholds from raw aggregates ``_a, _s, _mn, _mx`` (constant-cell guard)."""
    const = F.col(f"_mn{sfx}") == F.col(f"_mx{sfx}")
    mean = F.when(const, F.col(f"_mn{sfx}")).otherwise(F.col(f"_a{sfx}"))
    sd = F.when(const, F.lit(0.0)).otherwise(F.coalesce(F.col(f"_s{sfx}"), F.lit(0.0)))
    return [(mean - F.lit(k) * sd).alias(f"lo{sfx}"), (mean + F.lit(k) * sd).alias(f"hi{sfx}")]


def _outside(value: str) -> Column:
    v = F.col(value)
    return (v < F.col("lo")) | (v > F.col("hi"))


def std_flag(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0,
             flag: str = "is_outlier") -> DataFrame:
    cols = rows.columns
    return _with_bounds(rows, keys, value, k).select(*cols, _outside(value).alias(flag))


def std_mark_inside(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0,
                    mark: str = "inside") -> DataFrame:
    """Every reading, and whether :func:`std_keep_inside` keeps it."""
    cols = rows.columns
    v = F.col(value)
    return _with_bounds(rows, keys, value, k).select(*cols, ((v > F.col("lo")) & (v < F.col("hi"))).alias(mark))


def std_keep_inside(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0) -> DataFrame:
    return std_mark_inside(rows, keys, value, k, "_inside").where("_inside").drop("_inside")


def std_remove_outliers(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0) -> DataFrame:
    cols = rows.columns
    return _with_bounds(rows, keys, value, k).where(~_outside(value)).select(*cols)


def std_removed(rows: DataFrame, keys: list[str] = CELL, value: str = "value", k: float = 2.0) -> DataFrame:
    cols = rows.columns
    return _with_bounds(rows, keys, value, k).where(_outside(value)).select(*cols)


def std_flags(rows: DataFrame, flags: dict[str, str], keys: list[str] = CELL, k: float = 2.0) -> DataFrame:
    """Several 2-sigma flags at once (``{flag_column: value_column}``), one attach for all."""
    cols = rows.columns
    sfx = {f"_{i}": value for i, value in enumerate(flags.values())}
    joined = _bounds_for(rows, keys, sfx, k)
    outs = [((F.col(value) < F.col(f"lo_{i}")) | (F.col(value) > F.col(f"hi_{i}"))).alias(flag)
            for i, (flag, value) in enumerate(flags.items())]
    return joined.select(*cols, *outs)


def outlier_counts(flagged: DataFrame, keys: list[str] = CELL, flag: str = "is_outlier",
                   total: str = "values_count", outliers: str = "outliers_count") -> DataFrame:
    """Readings and flagged readings per cell (partial aggregation absorbs hot cells)."""
    return flagged.groupBy(*keys).agg(F.count(F.lit(1)).alias(total),
                                      F.count_if(F.col(flag)).alias(outliers))


# ---- quartiles (type 6: position p*(n+1), clamped to the first/last order statistic) ----

def _type6_ranks(p: float) -> tuple[Column, Column, Column]:
    """(lower rank, upper rank, fraction) of the type-6 position for cell size ``n``."""
    pos = F.lit(p) * (F.col("n") + 1)
    lower = F.least(F.greatest(F.floor(pos), F.lit(1)), F.col("n")).cast("long")
    upper = F.least(lower + 1, F.col("n")).cast("long")
    frac = F.when(pos < 1, F.lit(0.0)).when(pos >= F.col("n"), F.lit(0.0)).otherwise(pos - F.floor(pos))
    return lower, upper, frac


def quartiles(rows: DataFrame, keys: list[str] = CELL, value: str = "value",
              order: list[str] | None = None, force_range: bool = False) -> DataFrame:
    """Exact type-6 q1/q3 per cell, from ranks computed without a per-cell task. ``force_range``: the
    caller knows that some cell is too large for one."""
    tie = order or id_columns(rows)
    ranked = rank_in_cells(rows.select(*keys, value, *tie), keys, [value, *tie], force_range=force_range)
    lo1, up1, f1 = _type6_ranks(0.25)
    lo3, up3, f3 = _type6_ranks(0.75)
    rn, v = F.col("rn"), F.col(value)
    picked = (ranked.select(*keys, "n", rn, v, lo1.alias("_l1"), up1.alias("_u1"), f1.alias("_f1"),
                            lo3.alias("_l3"), up3.alias("_u3"), f3.alias("_f3"))
              .where(rn.isin(F.col("_l1"), F.col("_u1"), F.col("_l3"), F.col("_u3"))))
    agg = picked.groupBy(*keys).agg(
        F.first("n").alias("n"),
        F.max(F.when(rn == F.col("_l1"), v)).alias("_x1"), F.max(F.when(rn == F.col("_u1"), v)).alias("_y1"),
        F.first("_f1").alias("_f1"),
        F.max(F.when(rn == F.col("_l3"), v)).alias("_x3"), F.max(F.when(rn == F.col("_u3"), v)).alias("_y3"),
        F.first("_f3").alias("_f3"))
    return agg.select(*keys, "n",
                      (F.col("_x1") + F.col("_f1") * (F.col("_y1") - F.col("_x1"))).alias("q1"),
                      (F.col("_x3") + F.col("_f3") * (F.col("_y3") - F.col("_x3"))).alias("q3"))


def _window_quartiles(rows: DataFrame, keys: list[str], value: str, order: list[str] | None) -> DataFrame:
    """``rows`` plus ``q1`` / ``q3``, all by window functions over one cell partitioning; for bounded cells."""
    cols = rows.columns
    v = F.col(value)
    ranked = rank_by_window(rows, keys, [value, *(order or id_columns(rows))])
    w = Window.partitionBy(*keys)
    rn = F.col("rn")
    qs = []
    for name, p in (("q1", 0.25), ("q3", 0.75)):
        lower, upper, frac = _type6_ranks(p)
        x = F.max(F.when(rn == lower, v)).over(w)
        y = F.max(F.when(rn == upper, v)).over(w)
        qs.append((x + frac * (y - x)).alias(name))
    return ranked.select(*cols, *qs)


def selected_quartiles(rows: DataFrame, keys: list[str], value: str, per_task: int) -> DataFrame:
    """Exact type-6 q1/q3 of the cells with more than ``per_task`` readings, by selection (``plans.selection``)."""
    (l1, u1, f1), (l3, u3, f3) = _type6_ranks(0.25), _type6_ranks(0.75)
    found = select_ranks(rows, large_cells(rows, keys, value, per_task), keys, value,
                         {"_x1": l1, "_y1": u1, "_x3": l3, "_y3": u3}, per_task)
    return found.select(*keys, (F.col("_x1") + f1 * (F.col("_y1") - F.col("_x1"))).alias("q1"),
                        (F.col("_x3") + f3 * (F.col("_y3") - F.col("_x3"))).alias("q3"))


def _with_quartiles(rows: DataFrame, keys: list[str], value: str, order: list[str] | None) -> DataFrame:
    """``rows`` plus ``q1`` / ``q3`` of their cell.

    Bounded cells: ranks and quartiles are window functions over the same cell partitioning, so one shuffle and
    sort, no join. Cells above one task's share (found by one aggregate over the cell sizes): quartiles by
    selection. Their table has at most ``readings / per_task`` rows, the bound of the hot list of
    ``plans.attach``, and is broadcast, so that readings of a hot cell are never shuffled.
    """
    rows = keyed(rows, keys)
    cols = rows.columns
    d = size_probe(rows, keys)
    if d["bounded"]:
        return _window_quartiles(rows, keys, value, order)
    q = F.broadcast(freeze(selected_quartiles(rows, keys, value, d["per_task"])))
    rest = rows.join(q.select(*keys), keys, "left_anti").select(*cols)
    return rows.join(q, keys).select(*cols, "q1", "q3").unionByName(_window_quartiles(rest, keys, value, order))


def iqr_mark_inside(rows: DataFrame, keys: list[str] = CELL, value: str = "value", order: list[str] | None = None,
                    mark: str = "inside") -> DataFrame:
    """Every reading, and whether :func:`iqr_keep_inside` keeps it."""
    v = F.col(value)
    return _with_quartiles(rows, keys, value, order).select(*rows.columns, ((v > F.col("q1")) & (v < F.col("q3"))).alias(mark))


def iqr_keep_inside(rows: DataFrame, keys: list[str] = CELL, value: str = "value",
                    order: list[str] | None = None) -> DataFrame:
    """Readings strictly between the cell's q1 and q3 (no 1.5×IQR fence)."""
    return iqr_mark_inside(rows, keys, value, order, "_inside").where("_inside").drop("_inside")
