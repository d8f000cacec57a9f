"""Published payloads and their writers.

A published message is a row ``(routing_key STRING, payload STRING)``. The reference
sends them to a message exchange; here any Spark sink can carry them (files partitioned
by ``routing_key``, or a Kafka topic whose key is the routing key when that connector is
on the classpath).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Routing keys and wire field names of the published messages.
ROUTING_LEVEL1 = "5min"
ROUTING_ON_VALUES = "v60min"
ROUTING_ON_OUTLIERS = "o60min"
LEVEL1_FIELDS = ("urn", "timestamp", "valuesCount", "outliersCount")
ON_VALUES_FIELDS = ("urn", "timestamp", "valuesCount", "outliersOnValuesCount")
ON_OUTLIERS_FIELDS = ("urn", "timestamp", "outliersCount", "outliersOnOutliersCount")
READING_CSV_FORMAT = "%s,%f,%d"


def _message(routing_key: str, *fields) -> list:
    return [F.lit(routing_key).alias("routing_key"), F.to_json(F.struct(*fields)).alias("payload")]


def counts_payload(level1: DataFrame) -> DataFrame:
    """Level-1 counts → ``{"urn","timestamp","valuesCount","outliersCount"}``."""
    return level1.select(*_message(ROUTING_LEVEL1, F.col("urn"), F.col("timestamp"),
                                   F.col("values_count").alias("valuesCount"),
                                   F.col("outliers_count").alias("outliersCount")))


def on_values_payload(on_values: DataFrame, wire_compat: bool = False) -> DataFrame:
    """Level-2 (values) → ``{"urn","timestamp","valuesCount","outliersOnValuesCount"}``.

    The reference fills ``valuesCount`` from a field it never sets, so its wire value is
    always 0; ``wire_compat=True`` reproduces that, the default publishes the count.
    """
    vc = F.lit(0).cast("long") if wire_compat else F.col("values_count")
    return on_values.select(*_message(ROUTING_ON_VALUES, F.col("urn"), F.col("timestamp"), vc.alias("valuesCount"),
                                      F.col("outliers_on_values_count").alias("outliersOnValuesCount")))


def on_outliers_payload(on_outliers: DataFrame, wire_compat: bool = False) -> DataFrame:
    """Level-2 (outliers) → ``{"urn","timestamp","outliersCount","outliersOnOutliersCount"}``."""
    oc = F.lit(0).cast("long") if wire_compat else F.col("outliers_count")
    return on_outliers.select(*_message(ROUTING_ON_OUTLIERS, F.col("urn"), F.col("timestamp"),
                                        oc.alias("outliersCount"),
                                        F.col("outliers_on_outliers_count").alias("outliersOnOutliersCount")))


def reading_csv_payload(readings: DataFrame, routing_key: str = "readings") -> DataFrame:
    """A reading as ``urn,value,timestamp`` text with six decimals (``%s,%f,%d``)."""
    return readings.select(F.lit(routing_key).alias("routing_key"),
                           F.format_string(READING_CSV_FORMAT, "urn", "value", "timestamp").alias("payload"))


def second_level_payloads(second: DataFrame) -> DataFrame:
    """Both messages of a second-level row: its intervals with outlying counts, and with outlying outlier counts."""
    return on_values_payload(second.withColumnRenamed("intervals", "values_count")).unionByName(
        on_outliers_payload(second.withColumnRenamed("intervals", "outliers_count")))


def write_messages(messages: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write ``(routing_key, payload)`` rows as text, one folder per routing key. A retry of the whole write
    takes ``mode="overwrite"``; appending would publish twice (streams: ``streaming.sinks.write_messages``)."""
    messages.write.mode(mode).partitionBy("routing_key").text(path)


def export_counts_csv(level1: DataFrame, path: str) -> None:
    """Level-1 counts as CSV (overwrite, many part files; no single-file coalesce)."""
    (level1.select("urn", "timestamp", "values_count", "outliers_count")
     .write.mode("overwrite").option("header", "true").csv(path))
