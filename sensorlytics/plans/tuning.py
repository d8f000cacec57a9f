"""Tunables, read from the session so a cluster can override them with ``--conf``."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Largest cell table shipped to every executor as a broadcast, as estimated bytes
# (rows counted by an action × row width from the schema). Defaults to Spark's own
# spark.sql.autoBroadcastJoinThreshold; above it a shuffle join is used.
MAX_BROADCAST_BYTES = ("sensorlytics.broadcast.maxBytes", None)
# Broadcast a cell table only if its cells average at least this many readings: with
# tinier cells the table is about as large as the readings, so a broadcast saves little
# shuffle and costs a large hash table on every executor.
MIN_ROWS_PER_CELL = ("sensorlytics.broadcast.minRowsPerCell", 8)
# Target number of readings of one cell handled by one join task; hotter cells are salted.
ROWS_PER_TASK = ("sensorlytics.skew.rowsPerTask", 2_000_000)
# How intermediate tables that feed several actions are frozen: "checkpoint" (reliable RDD
# checkpoint in spark.checkpoint.dir, cleaned by Spark; set spark.checkpoint.compress),
# "table" (compressed parquet in the same folder, deleted at driver exit; smaller for very
# large tables, a fixed listing cost for small ones) or "persist" (cache; recomputed from
# lineage if an executor is lost). All but "persist" cut the lineage.
FREEZE_MODE = ("sensorlytics.freeze", "checkpoint")


# Most bytes of a hot-cell list, which is broadcast whatever the session's broadcast switch says.
HOT_LIST_BYTES = 10 << 20


def broadcast_limit(spark: SparkSession) -> int:
    key, _ = MAX_BROADCAST_BYTES
    v = spark.conf.get(key, None) or spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    v = str(v).strip().lower()
    mult = {"b": 1, "k": 1024, "kb": 1024, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(mult, key=len, reverse=True):
        if v.endswith(suffix) and v[: -len(suffix)].strip().lstrip("-").isdigit():
            return int(v[: -len(suffix)]) * mult[suffix]
    return int(v)


def row_bytes(schema) -> int:
    """Estimated in-memory width of a row (Spark's default type sizes; strings count 20),
    plus a per-row overhead of 16 bytes."""
    widths = {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4,
              "long": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8, "string": 20, "binary": 100}
    total = 16
    for f in schema.fields:
        name = f.dataType.typeName()
        total += widths.get(name, 16 if name == "decimal" else 32)
    return total


def get_int(spark: SparkSession, setting: tuple[str, int]) -> int:
    key, default = setting
    return int(spark.conf.get(key, str(default)))


def get_str(spark: SparkSession, setting: tuple[str, str]) -> str:
    key, default = setting
    return spark.conf.get(key, default)
