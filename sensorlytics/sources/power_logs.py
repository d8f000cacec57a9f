"""Per-run power log files: ``<root>/<...top<workers>-<slots>.run<NN>>/<file>`` holding one
number (watts). Workers, slots and run come from the folder name; the files are read by
Spark (``wholetext``) with the file path from the hidden ``_metadata`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Folder-name patterns of a run folder.
WORKERS_PATTERN = r"top(.+?)-"
SLOTS_PATTERN = r"-(.+?)\.run"
RUN_PATTERN = r"\.run([0-9]+)"
POWER_FILE = "pdu.log"


def read_power_logs(spark: SparkSession, root: str, file_glob: str = POWER_FILE) -> DataFrame:
    """``worker, task_slots, run, pdu_w`` for every run folder under ``root``."""
    df = (spark.read.option("wholetext", "true").option("recursiveFileLookup", "true")
          .option("pathGlobFilter", file_glob).text(root)
          .select(F.col("value"), F.col("_metadata.file_path").alias("path")))
    folder = F.element_at(F.split(F.col("path"), "/"), -2)
    return df.select(
        F.regexp_replace(F.regexp_extract(folder, WORKERS_PATTERN, 1), "^0+", "").alias("worker"),
        F.regexp_extract(folder, SLOTS_PATTERN, 1).alias("task_slots"),
        F.regexp_replace(F.regexp_extract(folder, RUN_PATTERN, 1), "^0+", "").alias("run"),
        F.trim(F.col("value")).cast("double").alias("pdu_w"))


def write_power_logs(per_run: DataFrame, root: str) -> None:
    """Write one file per run folder from ``(folder, total_avg_watts)`` rows with Spark
    (``partitionBy`` names the folder ``folder=<name>``; the reader takes the last folder)."""
    (per_run.select(F.col("folder"), F.col("total_avg_watts").cast("string").alias("value"))
     .repartition("folder").write.mode("overwrite").partitionBy("folder").text(root))
