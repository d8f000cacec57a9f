"""Exactly-once file sinks for ``foreachBatch``.

Each micro-batch writes its rows to ``<path>/batch_id=<id>`` with overwrite, so a batch
replayed after a failure replaces its own output instead of duplicating it (the query's
checkpoint decides which batch ids are committed).

* append tables: every row is final (windows closed by the watermark);
* upsert tables: a key may be re-emitted by later batches (update mode, late data);
  :func:`read_latest` keeps the row of the highest batch id per key with ``max_by``,
  a partial aggregate, so no key is gathered in one task;
* messages: ``(routing_key, payload)`` rows as text, one folder per batch and routing key.

Upsert tables are compacted in tiers (:func:`compact`): after every ``FAN``-th batch the last
``FAN`` batches are merged into a run, after every ``FAN``-th run the last ``FAN`` runs into a
larger one, and so on. A reader takes the largest finished runs that cover the batches, so it
opens at most ``FAN - 1`` folders a tier, and a row is rewritten once a tier. What a run replaces
is deleted when the next run of its tier is finished: a reader that has just listed the
folders has that long to finish. A replayed batch rebuilds the same run.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FAN = 8


def batch_path(path: str, batch_id: int) -> str:
    return f"{path.rstrip('/')}/batch_id={batch_id}"


def batch_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                 publish: tuple[Callable[[DataFrame], DataFrame], str] | None = None,
                 keys: list[str] | None = None) -> Callable:
    """``foreachBatch`` function writing ``transform(micro_batch)`` to ``path/batch_id=N``.

    ``publish = (payloads, message_path)`` sends the written rows out as messages too, made by
    ``payloads`` from what the table holds. ``keys`` makes it an upsert table, compacted on the way."""

    def write(df: DataFrame, batch_id: int) -> None:
        spark, target = df.sparkSession, batch_path(path, batch_id)
        if transform is None:
            df.write.mode("overwrite").parquet(target)
        else:
            # the transform runs several actions; compute the micro-batch (and its stateful
            # part) once
            cached = df.persist(StorageLevel.MEMORY_AND_DISK)
            try:
                transform(cached).write.mode("overwrite").parquet(target)
            finally:
                cached.unpersist()
        if publish is not None:
            payloads, message_path = publish
            write_messages(payloads(spark.read.parquet(target)), message_path, batch_id)
        if keys is not None:
            compact(spark, path, keys, batch_id)

    return write


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """All rows of an append table (without the batch id)."""
    return spark.read.parquet(path).drop("batch_id")


# ---- messages

def write_messages(messages: DataFrame, path: str, batch_id: int) -> None:
    """The batch's ``(routing_key, payload)`` rows as text below ``path/batch_id=N``: a replayed batch
    replaces its messages, and no other batch's are touched."""
    messages.select("routing_key", "payload").write.mode("overwrite").partitionBy("routing_key").text(batch_path(path, batch_id))


def message_writer(path: str) -> Callable:
    """``foreachBatch`` function for a stream of ``(routing_key, payload)`` rows."""
    return lambda df, batch_id: write_messages(df, path, batch_id)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Messages of finished batches: ``(routing_key, payload)``."""
    done = [b for b, p in _numbered(spark, path, "batch_id=") if _finished(spark, p)]
    schema = "value STRING, routing_key STRING, batch_id INT"
    if not done:
        return spark.createDataFrame([], schema).select("routing_key", F.col("value").alias("payload"))
    rows = spark.read.schema(schema).option("basePath", path).text([batch_path(path, b) for b in done])
    return rows.select("routing_key", F.col("value").alias("payload"))


# ---- upsert tables

def _fs(spark: SparkSession, path: str):
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp, jp.getFileSystem(spark._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, path: str) -> bool:
    jp, fs = _fs(spark, f"{path}/_SUCCESS")
    return fs.exists(jp)


def _numbered(spark: SparkSession, path: str, prefix: str) -> list[tuple[int, str]]:
    """Folders ``<prefix><number>`` in ``path``, in the order of their numbers."""
    jp, fs = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jp)] if fs.exists(jp) else []
    found = [int(m.group(1)) for m in (re.fullmatch(f"{prefix}(\\d+)", n) for n in names) if m]
    return [(n, f"{path.rstrip('/')}/{prefix}{n}") for n in sorted(found)]


def _run_path(path: str, tier: int, last: int | None = None) -> str:
    """The run of a tier that ends with batch ``last``; runs live beside the batches."""
    folder = f"{path.rstrip('/')}_runs/tier={tier}"
    return folder if last is None else f"{folder}/upto={last}"


def _latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in rows.columns if c not in keys and c != "batch_id"]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*others, "batch_id"), F.col("batch_id")).alias("_row"))
    return best.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in [*others, "batch_id"]])


def parts_of(spark: SparkSession, path: str, before: int | None = None) -> list[tuple[str, int | None]]:
    """Folders that together hold all versions up to batch ``before`` (exclusive; None: all), as
    (folder, batch id or None for a run): per tier the largest finished runs, then single batches."""
    batches = [b for b, p in _numbered(spark, path, "batch_id=") if before is None or b < before]
    tiers, t = [], 1
    while found := _numbered(spark, _run_path(path, t), "upto="):
        tiers.append((t, [n for n, p in found if _finished(spark, p) and (before is None or n < before)]))
        t += 1
    out, covered = [], -1
    for t, ends in reversed(tiers):
        for end in ends:
            if end - FAN ** t + 1 == covered + 1:
                out.append((_run_path(path, t, end), None))
                covered = end
    return out + [(batch_path(path, b), b) for b in batches if b > covered]


def _versions(spark: SparkSession, parts: list[tuple[str, int | None]]) -> DataFrame | None:
    frames = []
    runs = [p for p, b in parts if b is None]
    if runs:
        frames.append(spark.read.parquet(*runs))
    frames += [spark.read.parquet(p).withColumn("batch_id", F.lit(b)) for p, b in parts if b is not None]
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def compact(spark: SparkSession, path: str, keys: list[str], batch_id: int) -> None:
    """Merge what batch ``batch_id`` completes: its tier-1 run, and larger ones that end with it."""
    tier = 1
    while (batch_id + 1) % FAN ** tier == 0:
        step = FAN ** (tier - 1)
        ends = range(batch_id - (FAN - 1) * step, batch_id + 1, step)
        parts = [(batch_path(path, e), e) if tier == 1 else (_run_path(path, tier - 1, e), None) for e in ends]
        target = _run_path(path, tier, batch_id)
        if not _finished(spark, target):  # batch ids have no gaps, and a batch without rows is an empty folder
            _latest(_versions(spark, parts), keys).write.mode("overwrite").parquet(target)
        # what the run before this one replaced has been out of use since then
        for e in (e - FAN ** tier for e in ends):
            old = batch_path(path, e) if tier == 1 else _run_path(path, tier - 1, e)
            if e >= 0 and _finished(spark, _run_path(path, tier, batch_id - FAN ** tier)):
                jp, fs = _fs(spark, old)
                fs.delete(jp, True)
        tier += 1


def read_latest(spark: SparkSession, path: str, keys: list[str], before: int | None = None) -> DataFrame:
    """Latest version of every key of an upsert table (of batches before ``before``, if given)."""
    rows = _versions(spark, parts_of(spark, path, before))
    if rows is None:
        return None if before is not None else spark.read.parquet(path)
    return _latest(rows, keys).drop("batch_id")
