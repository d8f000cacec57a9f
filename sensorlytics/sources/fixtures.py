"""Reading tables derived from the driver's parquet tables (see FIXTURES.md).

Every fixture is a plain DataFrame projection of a given table, so column pruning and
filters reach the parquet scan; nothing is materialised on the driver.

Reading schema: ``urn STRING, value DOUBLE, timestamp BIGINT (epoch ms), seq BIGINT``
where ``seq`` is a unique tie-breaker that makes time order total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlytics.functions.timecols import ntz_epoch_ms

READING_COLUMNS = ["urn", "value", "timestamp", "seq"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str, urn: Column, value: Column) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        urn.alias("urn"),
        value.alias("value"),
        ntz_epoch_ms("ts").alias("timestamp"),
        F.col("event_id").alias("seq"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: urn = event_type, value = value, timestamp = epoch ms of ts."""
    return _events(spark, sf_dir, F.col("event_type"), F.col("value"))


def readings_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`readings` with value - 80 (exercises the zero-seeded min/max)."""
    return _events(spark, sf_dir, F.col("event_type"), F.col("value") - 80)


def readings_by_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`readings` keyed by user (many keys, small cells)."""
    return _events(spark, sf_dir, F.col("user_id").cast("string"), F.col("value"))


def readings_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``: urn = supplier, value = extended price, time = ship date."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").cast("string").alias("urn"),
        F.col("l_extendedprice").alias("value"),
        ntz_epoch_ms("l_shipdate").alias("timestamp"),
        (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("long").alias("seq"),
    )


def lines(spark: SparkSession, sf_dir: str, order: str = "uvt") -> DataFrame:
    """Raw text lines ``urn,value,timestamp`` (order ``uvt``) or ``urn,timestamp,value`` (``utv``).

    Rows with ``seq % 97 = 0`` use ``"; "`` as the delimiter. Columns: ``line``, ``seq``.
    """
    r = readings(spark, sf_dir)
    v, t = F.col("value").cast("string"), F.col("timestamp").cast("string")
    fields = [F.col("urn"), v, t] if order == "uvt" else [F.col("urn"), t, v]
    alt = F.col("seq") % 97 == 0
    line = F.when(alt, F.concat_ws("; ", *fields)).otherwise(F.concat_ws(",", *fields))
    return r.select(line.alias("line"), "seq")


def lines_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines(order='uvt')`` with bad value (seq % 101), bad timestamp (% 103), 4th field (% 107)."""
    r = readings(spark, sf_dir)
    seq = F.col("seq")
    v = F.when(seq % 101 == 0, F.lit("x")).otherwise(F.col("value").cast("string"))
    t = F.when(seq % 103 == 0, F.lit("x")).otherwise(F.col("timestamp").cast("string"))
    sep = F.when(seq % 97 == 0, F.lit("; ")).otherwise(F.lit(","))
    line = F.concat(F.col("urn"), sep, v, sep, t,
                    F.when(seq % 107 == 0, F.concat(sep, F.lit("extra"))).otherwise(F.lit("")))
    return r.select(line.alias("line"), "seq")


def lines_trailing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lines(order='uvt')`` with a trailing delimiter on every line (still valid)."""
    return lines(spark, sf_dir, "uvt").select(F.concat("line", F.lit(",")).alias("line"), "seq")


# The experiment grid of the scale-out suite.
GRID_WORKERS = [1, 2, 4, 8, 16]
GRID_SLOTS = [1, 2, 4]
SUITE = "gb.scale-out"
EXPERIMENT_PREFIX = "gb.top"


def experiments(spark: SparkSession) -> DataFrame:
    """15 grid points, id 0..14: name = prefix + 3-digit workers + '-' + slots."""
    ids = spark.range(len(GRID_WORKERS) * len(GRID_SLOTS))
    workers = F.element_at(F.array(*[F.lit(w) for w in GRID_WORKERS]),
                           (F.col("id") / len(GRID_SLOTS)).cast("int") + 1)
    slots = F.element_at(F.array(*[F.lit(s) for s in GRID_SLOTS]), (F.col("id") % len(GRID_SLOTS)).cast("int") + 1)
    return ids.select(
        F.col("id").cast("long").alias("id"),
        F.concat(F.lit(EXPERIMENT_PREFIX), F.lpad(workers.cast("string"), 3, "0"), F.lit("-"),
                 slots.cast("string")).alias("name"),
        F.lit(SUITE).alias("suite"),
    )


def experiment_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders``: experiment_id = custkey % 15, run = orderkey % 3 + 1, time = max(totalprice)."""
    o = table(spark, sf_dir, "orders")
    return (o.groupBy((F.col("o_custkey") % 15).alias("experiment_id"),
                      (F.col("o_orderkey") % 3 + 1).cast("int").alias("run"))
            .agg(F.max("o_totalprice").cast("long").alias("time")))


def power_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: run = day of month of ts, node = event_type, watts = floor(value)."""
    ev = table(spark, sf_dir, "events")
    return ev.select(F.dayofmonth("ts").alias("run"), F.col("event_type").alias("node"),
                     F.floor("value").cast("int").alias("watts"))
