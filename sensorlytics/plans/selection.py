"""Order statistics of large cells by selection: their readings are neither sorted, shuffled nor copied.

A wanted rank of a cell is known to lie in a bracket ``[lo, hi]`` of the cell's own values, at first its
smallest and largest. One pass deals the readings of a bracket into ``BUCKETS`` value ranges of equal width, cut
again by ``BUCKETS`` ranges of equal ratio, and takes count, smallest and largest value of each: a partial
aggregate, so a partition shuffles at most ``2 * BUCKETS`` rows a bracket. A running sum over the ranges finds the
one that holds the rank; its smallest and largest value are the next bracket. Once no open bracket holds
more than ``per_task`` readings, the next pass counts per distinct value instead and finds them all. Ties end
early: a bracket of one value is closed whatever it holds.

``lo`` and ``hi`` fall into different ranges, so a bracket always shrinks. A pass leaves a 1024th of its width and
of the logarithm of its ratio: two passes for readings spread near evenly, at most about ten (by estimate) for any doubles.
All steps are exact.

NULL sorts first and NaN last, infinities in their place, as in ``ORDER BY``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlytics.plans.attach import freeze

BUCKETS = 1024


def large_cells(rows: DataFrame, keys: list[str], value: str, per_task: int) -> DataFrame:
    """(keys, n, known, lo, hi) of the cells with more than ``per_task`` readings, frozen: size, values that
    are not NULL, smallest and largest value. At most ``readings / per_task`` rows."""
    v = F.col(value)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.count(v).alias("known"), F.min(v).alias("lo"),
                                    F.max(v).alias("hi"))
    return freeze(sizes.where(F.col("n") > per_task))


def _part(v: Column, lo: Column, hi: Column, kind: str) -> Column:
    """The range of ``v`` in [lo, hi], monotone in ``v``: by width, then by ratio inside it. ``kind``: its type;
    differences of integers and decimals are taken exactly, as a double may not tell two of them apart."""
    largest = F.lit(sys.float_info.max)

    def half(x: Column) -> Column:  # halves, so that a width can't overflow; NaN, above all numbers, is cut like infinity
        return F.greatest(F.least(x.cast("double"), largest), -largest) / 2

    def size(x: Column) -> Column:  # the logarithm of a magnitude is above -746, and never falls as the magnitude grows
        return F.when(half(x) == 0, F.lit(0.0)).otherwise(F.signum(half(x)) * (F.ln(F.abs(half(x))) + 747))

    def place(at: Column, first: Column, last: Column) -> Column:
        return F.least(F.floor((at - first) / (last - first) * BUCKETS).cast("long"), F.lit(BUCKETS - 1))

    def beyond(x: Column) -> Column:
        return ((x - lo) if kind == "decimal" else (x.cast("decimal(20,0)") - lo.cast("decimal(20,0)"))).cast("double")

    if kind in ("double", "float"):
        by_width = F.when(half(hi) > half(lo), place(half(v), half(lo), half(hi))).otherwise((v > lo).cast("long"))
    else:
        by_width = F.when(hi > lo, place(beyond(v), F.lit(0.0), beyond(hi))).otherwise(0)
    by_ratio = F.when(size(hi) > size(lo), place(size(v), size(lo), size(hi))).otherwise(0)
    return by_width * BUCKETS + by_ratio


def _narrowed(rows: DataFrame, wanted: DataFrame, keys: list[str], names: list[str], exact: bool) -> DataFrame:
    """One pass: the ranks of ``wanted`` with the brackets that hold them among the readings of the old ones."""
    rank = F.col("rank")
    # at most one bracket for each wanted rank of a large cell; the ranks ride along as numbers, not as a second join
    brackets = F.broadcast(wanted.groupBy(*keys, "lo", "hi").agg(
        F.first("n").alias("n"), *[F.max(F.when(F.col("name") == x, rank)).alias(x) for x in names]))
    v = F.col("_v")
    held = rows.join(brackets, keys).where((v >= F.col("lo")) & (v <= F.col("hi")))
    part = v if exact else _part(v, F.col("lo"), F.col("hi"), rows.schema["_v"].dataType.typeName())
    counts = held.groupBy(*keys, "lo", "hi", part.alias("part")).agg(
        F.count(F.lit(1)).alias("held"), F.min(v).alias("least"), F.max(v).alias("most"),
        *[F.max(x).alias(x) for x in ("n", *names)])
    upto = Window.partitionBy(*keys, "lo", "hi").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    named = F.explode(F.array(*[F.struct(F.lit(x).alias("name"), (F.col(x) - F.col("upto") + F.col("held")).alias("rank"))
                                for x in names]))
    return (counts.withColumn("upto", F.sum("held").over(upto)).select("*", named.alias("w"))
            .where((F.col("w.rank") > 0) & (F.col("w.rank") <= F.col("held")))
            .select(*keys, "n", "w.name", "w.rank", F.col("least").alias("lo"), F.col("most").alias("hi"), "held"))


def select_ranks(rows: DataFrame, cells: DataFrame, keys: list[str], value: str, ranks: dict[str, Column],
                 per_task: int) -> DataFrame:
    """(keys, n, one column per name in ``ranks``): the values of these 1-based ranks, given over ``n``, in the
    ``cells`` of :func:`large_cells`."""
    slim = rows.select(*keys, F.col(value).alias("_v"))
    named = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank.cast("long").alias("rank"))
                                for name, rank in ranks.items()]))
    wanted = cells.select(*keys, "n", "known", "lo", "hi", named.alias("w"))
    place = F.col("w.rank") - (F.col("n") - F.col("known"))  # NULLs come first
    wanted = freeze(wanted.select(*keys, "n", F.col("w.name").alias("name"), place.alias("rank"),
                                  *[F.when(place > 0, F.col(c)).alias(c) for c in ("lo", "hi")], F.col("known").alias("held")))
    is_open = F.coalesce(F.col("lo") < F.col("hi"), F.lit(False))
    closed = wanted.where(~is_open)
    while True:
        wanted = wanted.where(is_open)
        most = wanted.agg(F.max("held")).first()[0]
        if most is None:
            break
        wanted = freeze(_narrowed(slim, wanted, keys, list(ranks), exact=most <= per_task))
        closed = closed.unionByName(wanted.where(~is_open))
    return closed.groupBy(*keys).agg(F.first("n").alias("n"), *[
        F.max(F.when(F.col("name") == name, F.col("lo"))).alias(name) for name in ranks])
