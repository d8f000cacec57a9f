"""Stream jobs.

Readings streams carry ``urn, value, timestamp (epoch ms)`` and, where the source has one, a
unique ``seq``; the event time used for watermarks is ``timestamp_millis(timestamp)``. Without
``seq`` (text messages) equal readings are counted in state and told apart by a copy number.

* :func:`passthrough_lines` — text messages → lenient parse → CSV payloads (JOB6);
  :func:`passthrough` does the same for typed readings. Stateless.
* :func:`window_mean_updates` — windowed mean, update mode, unlimited lateness (JOB9):
  incremental state (sum, count) per (urn, window); late readings re-emit their window
  and the upsert sink keeps the latest value.
* :func:`start_outlier_counts` — JOB1 on a stream: readings are held in state until the
  watermark closes their window (late readings are dropped), each closed window is then
  handed to ``foreachBatch`` whole and flagged with the batch operators (skew-safe attach).
  State holds one row per buffered reading keyed by (window, urn, seq), or (window, urn,
  timestamp, value) without ``seq``, so even a hot cell's buffer is spread over all state
  partitions.
* :func:`start_second_level` — JOB2 on the stream of level-1 counts, same pattern.
* :func:`start_on_closed_windows` — any batch job on the closed windows (JOB3-JOB5).
* :func:`run_bounded` — a bounded input: once all of it is read, an end marker moves the
  watermark past every window, so the last windows are emitted too. Without an end marker the
  stream is endless and emits a window only when later readings close it.
* :func:`start_pairwise_updates` — pairwise running average (JOB8 event time with unlimited
  lateness, JOB7 processing time): each micro-batch is reduced to one summary per touched cell
  and merged into the cell's running summary.
* :func:`start_messages` — a stream of payloads into the message sink. The closed-window jobs and
  the running averages take ``publish=(payloads, path)`` and send each batch's results there.
* :func:`message_stream` — published messages as a stream: the second level can start from JSON.

Queries keep their state in RocksDB with changelog checkpoints unless the session names another
state store (:func:`state_store`): readings buffered for a window then live on disk, not in the heap.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorlytics.functions.timecols import spark_interval
from sensorlytics.operators.cells import CELL, time_order
from sensorlytics.sinks.publish import reading_csv_payload
from sensorlytics.streaming.sinks import batch_path, batch_writer, message_writer, read_latest

READING_SCHEMA = "urn STRING, value DOUBLE, timestamp BIGINT, seq BIGINT"
# The reference's watermark delay and unlimited lateness.
WATERMARK_DELAY = "5 minutes"
UNLIMITED_LATENESS = "10000 days"
# Event time of the end marker, 9999-12-30: later than any reading's window.
END_OF_INPUT_MS = 253_402_128_000_000
# Spark's settings of the state store.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_HEAP_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
# What a job publishes: payloads made from its result rows, and the folder of the messages.
Publish = tuple[Callable[[DataFrame], DataFrame], str]


def reading_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Parquet readings landing in ``path`` as a stream."""
    r = spark.readStream.schema(READING_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Text messages (one reading per line) landing in ``path`` as a stream: column ``line``."""
    r = spark.readStream
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.text(path).withColumnRenamed("value", "line")


def message_stream(spark: SparkSession, path: str, routing_key: str) -> DataFrame:
    """Messages of one routing key, published to ``path`` by a job, as a stream: column ``payload``."""
    folder = f"{path.rstrip('/')}/batch_id=*/routing_key={routing_key}"
    return spark.readStream.text(folder).select(F.col("value").alias("payload"))


def state_store(spark: SparkSession) -> None:
    """RocksDB state with changelog checkpoints, unless the session has a choice of its own."""
    if spark.conf.get(STATE_STORE, None) in (None, "", _HEAP_STORE):
        spark.conf.set(STATE_STORE, ROCKSDB)
        spark.conf.set(CHANGELOG, "true")


def state_sizes(query: StreamingQuery) -> list[tuple[int, int, int]]:
    """(batch id, rows in state, bytes of memory) of a query's recent batches."""
    return [(p["batchId"], sum(o["numRowsTotal"] for o in p["stateOperators"]),
             sum(o["memoryUsedBytes"] for o in p["stateOperators"])) for p in query.recentProgress]


def with_event_time(readings: DataFrame) -> DataFrame:
    return readings.withColumn("event_time", F.timestamp_millis("timestamp"))


def passthrough(readings: DataFrame) -> DataFrame:
    """Every reading re-published as ``urn,value,timestamp`` text (no state)."""
    return reading_csv_payload(readings)


def passthrough_lines(lines: DataFrame, order: str = "uvt", strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """JOB6: text messages → lenient parse → CSV payloads; returns ``(payloads, rejects)``.

    Both outputs are stateless streams (parsing is a projection and a filter)."""
    from sensorlytics.sources.ingest import parse_readings
    good, rejects = parse_readings(lines, order, strict=strict)
    return reading_csv_payload(good), rejects


def window_mean_updates(readings: DataFrame, width: str | int = "5 minutes",
                        lateness: str = UNLIMITED_LATENESS) -> DataFrame:
    """JOB9: mean per (urn, window), for ``outputMode("update")``."""
    w = spark_interval(width)
    g = (with_event_time(readings).withWatermark("event_time", lateness)
         .groupBy("urn", F.window("event_time", w).alias("w")).agg(F.avg("value").alias("value")))
    return g.select("urn", F.unix_millis("w.start").alias("timestamp"), "value")


def _with_end_marker(stream: DataFrame, marker_path: str | None) -> DataFrame:
    """The stream, and with it the end marker once :func:`end_input` has written it."""
    if marker_path is None:
        return stream
    spark = stream.sparkSession
    # the file source wants a folder to watch; an existing one (with its marker) is left alone
    spark.createDataFrame([], stream.schema).write.mode("ignore").parquet(marker_path)
    return stream.unionByName(spark.readStream.schema(stream.schema).parquet(marker_path))


def end_input(stream: DataFrame, marker_path: str) -> None:
    """Declare the input of ``stream`` complete: one row of no sensor, later than all readings.

    Its own window ends behind the watermark it sets, so it never reaches an output. A second
    marker (a retry) falls into the same window and changes nothing."""
    fields = {"timestamp": F.lit(END_OF_INPUT_MS)}
    row = stream.sparkSession.range(1).select(
        *[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in stream.schema.fields])
    row.coalesce(1).write.mode("append").parquet(marker_path)


def run_bounded(stream: DataFrame, marker_path: str, start: Callable[..., StreamingQuery]) -> None:
    """Run a closed-window job over a bounded input to its very end.

    ``start(end_marker=...)`` starts the query (the same checkpoint each time). The first run
    reads all input; then the end marker is written and the second run closes every window
    that is left, as a bounded source's final watermark does."""
    for last in (False, True):
        if last:
            end_input(stream, marker_path)
        query = start(end_marker=marker_path)
        query.awaitTermination()
        if query.exception():
            raise query.exception()


def _buffer_closed_windows(readings: DataFrame, width: str | int, delay: str, id_cols: list[str],
                           held: dict[str, Column]) -> DataFrame:
    """Hold readings until the watermark passes their window's end, then emit them (append),
    one row per ``id_cols`` within a sensor with the ``held`` aggregates."""
    w = spark_interval(width)
    g = (with_event_time(readings).withWatermark("event_time", delay)
         .groupBy(F.window("event_time", w).alias("w"), "urn", *id_cols)
         .agg(*[c.alias(name) for name, c in held.items()]))
    return g.select("urn", *id_cols, F.unix_millis("w.start").alias("win"), *held)


def _first(*names: str) -> dict[str, Column]:
    """A reading's columns, kept once: a replayed duplicate collapses."""
    return {name: F.first(name) for name in names}


def _buffer_closed_readings(readings: DataFrame, width: str | int, delay: str) -> DataFrame:
    """Closed windows' readings ``(urn, win, value, timestamp, seq)``, whole cells.

    Readings without ``seq`` are held as (timestamp, value, copies) and come out once per
    copy, with the copy's number as ``seq``: equal readings all count."""
    if "seq" in readings.columns:
        return _buffer_closed_windows(readings, width, delay, ["seq"], _first("value", "timestamp"))
    held = _buffer_closed_windows(readings, width, delay, ["timestamp", "value"], {"n": F.count(F.lit(1))})
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))
    return held.select("urn", "win", "value", "timestamp", copy.alias("seq"))


def start_on_closed_windows(readings: DataFrame, out_path: str, checkpoint: str, transform,
                            width: str | int = "5 minutes", delay: str = WATERMARK_DELAY,
                            available_now: bool = True, processing_time: str | None = None,
                            end_marker: str | None = None, publish: Publish | None = None) -> StreamingQuery:
    """Run a batch job on every window the watermark closes (JOB3, JOB4, JOB5 as streams).

    ``transform`` receives the closed windows' readings ``(urn, value, timestamp, seq)`` —
    whole cells — and returns the rows to append to ``out_path``. ``end_marker``: see
    :func:`run_bounded`."""
    closed = _buffer_closed_readings(_with_end_marker(readings, end_marker), width, delay)
    return _start(closed, batch_writer(out_path, lambda b: transform(b.drop("win")), publish), checkpoint, "append",
                  available_now, processing_time)


def start_outlier_counts(readings: DataFrame, out_path: str, checkpoint: str, width: str | int = "5 minutes",
                         delay: str = WATERMARK_DELAY, k: float = 2.0, available_now: bool = True,
                         processing_time: str | None = None, end_marker: str | None = None,
                         publish: Publish | None = None) -> StreamingQuery:
    """JOB1 as a stream: level-1 counts of every closed window, appended to ``out_path``."""
    closed = _buffer_closed_readings(_with_end_marker(readings, end_marker), width, delay)

    def counts(batch: DataFrame) -> DataFrame:
        from sensorlytics.operators import outliers as O
        # timestamp and seq keep equal values of a hot cell on different salts
        flagged = O.std_flag(batch.select("urn", "win", "value", "timestamp", "seq"), CELL, "value", k)
        return (O.outlier_counts(flagged, CELL)
                .select("urn", F.col("win").alias("timestamp"), "values_count", "outliers_count"))

    return _start(closed, batch_writer(out_path, counts, publish), checkpoint, "append", available_now, processing_time)


def level1_stream(spark: SparkSession, path: str) -> DataFrame:
    """The level-1 count table written by :func:`start_outlier_counts`, read as a stream."""
    return (spark.readStream.schema("urn STRING, timestamp BIGINT, values_count BIGINT, outliers_count BIGINT, "
                                    "batch_id INT").parquet(path).drop("batch_id"))


def start_second_level(level1: DataFrame, out_path: str, checkpoint: str, width: str | int = "60 minutes",
                       delay: str = WATERMARK_DELAY, k: float = 2.0, available_now: bool = True,
                       processing_time: str | None = None, end_marker: str | None = None,
                       publish: Publish | None = None) -> StreamingQuery:
    """JOB2 as a stream over level-1 counts (their window start is the event time)."""
    closed = _buffer_closed_windows(_with_end_marker(level1, end_marker), width, delay, ["timestamp"],
                                    _first("values_count", "outliers_count"))

    def second(batch: DataFrame) -> DataFrame:
        from sensorlytics.operators import outliers as O
        f = O.std_flags(batch.select("urn", "win", "values_count", "outliers_count"),
                        {"f_v": "values_count", "f_o": "outliers_count"}, ["urn", "win"], k)
        return (f.groupBy("urn", "win")
                .agg(F.count(F.lit(1)).alias("intervals"), F.count_if("f_v").alias("outliers_on_values_count"),
                     F.count_if("f_o").alias("outliers_on_outliers_count"))
                .select("urn", F.col("win").alias("timestamp"), "intervals", "outliers_on_values_count",
                        "outliers_on_outliers_count"))

    return _start(closed, batch_writer(out_path, second, publish), checkpoint, "append", available_now, processing_time)


def level1_messages(messages: DataFrame) -> DataFrame:
    """Level-1 counts from JSON messages (``payload``): the stream :func:`start_second_level` takes.
    Messages that don't parse are left out; ``ingest.parse_counts_json`` has them as rejects."""
    from sensorlytics.sources.ingest import parse_counts_json
    good, _ = parse_counts_json(messages)
    return good.select("urn", "timestamp", "values_count", "outliers_count")


def start_to_table(stream: DataFrame, out_path: str, checkpoint: str, output_mode: str = "append",
                   available_now: bool = True, processing_time: str | None = None, publish: Publish | None = None,
                   keys: list[str] | None = None) -> StreamingQuery:
    """Run any stream into a batch-id partitioned table: append, or with ``keys`` upsert, compacted."""
    return _start(stream, batch_writer(out_path, publish=publish, keys=keys), checkpoint, output_mode, available_now,
                  processing_time)


def start_messages(payloads: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                   processing_time: str | None = None) -> StreamingQuery:
    """Publish a stream of ``(routing_key, payload)`` rows (JOB6), each batch once."""
    return _start(payloads, message_writer(path), checkpoint, "append", available_now, processing_time)


def _start(stream: DataFrame, fn, checkpoint: str, mode: str, available_now: bool,
           processing_time: str | None) -> StreamingQuery:
    state_store(stream.sparkSession)
    w = stream.writeStream.outputMode(mode).foreachBatch(fn).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()


def _batch_arrival_ms(spark: SparkSession, out_path: str, batch_id: int, clock: Callable[[], int]) -> int:
    marker = batch_path(f"{out_path.rstrip('/')}_arrivals", batch_id)
    done = spark._jvm.org.apache.hadoop.fs.Path(f"{marker}/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):  # first run of this batch
        spark.createDataFrame([(int(clock()),)], "arrival_ms long").write.mode("overwrite").parquet(marker)
    return int(spark.read.parquet(marker).first()[0])


def start_pairwise_updates(readings: DataFrame, out_path: str, checkpoint: str, width: str | int = "5 minutes",
                           processing_time_width: str | int | None = None, available_now: bool = True,
                           processing_time: str | None = None, publish: Publish | None = None,
                           clock: Callable[[], int] = lambda: int(time.time() * 1000)) -> StreamingQuery:
    """JOB8 (event-time windows, unlimited lateness) or JOB7 (``processing_time_width``:
    windows over the arrival time of each micro-batch): pairwise running average per cell.

    Each micro-batch is reduced to one summary ``(first, k, c)`` per touched cell, in time order
    (``reductions.pairwise_summary``), and merged into the cell's running summary, the latest
    version in the upsert table ``out_path`` (:func:`sinks.read_latest` on urn, win). Readings are
    not kept: a late one is folded in when it arrives, after those that came before it, as in
    the reference. A replayed batch starts from the versions before it and writes the same rows.

    Without ``seq`` (text) equal times follow the value. ``clock`` gives the arrival time (epoch ms)
    of a batch; it is recorded once per batch, so that a replay lands in the same windows. JOB7
    rows carry the earliest reading's timestamp, as in the reference.
    """
    from sensorlytics.functions.timecols import window_start_ms
    from sensorlytics.operators import reductions as R

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if processing_time_width is None:
            cells = batch.withColumn("win", window_start_ms("timestamp", width))
            stamp = F.col("win")
        else:
            # one arrival time per micro-batch (current_timestamp() would be re-evaluated by
            # every action below and could cross a window boundary between them)
            arrival = F.lit(_batch_arrival_ms(spark, out_path, batch_id, clock)).cast("long")
            cells = batch.withColumn("arrival_ms", arrival).withColumn(
                "win", window_start_ms("arrival_ms", processing_time_width))
            stamp = F.col("first_ts")
        summary = R.pairwise_summary(cells, CELL, "value", time_order(cells))
        earlier = read_latest(spark, out_path, CELL, before=batch_id)
        if earlier is not None:
            summary = R.pairwise_merge(earlier, summary, CELL)
        rows = summary.select("urn", "win", stamp.alias("timestamp"), R.pairwise_value().alias("value"), "first", "k", "c",
                              "first_ts")
        batch_writer(out_path, publish=publish, keys=CELL)(rows, batch_id)

    return _start(readings, on_batch, checkpoint, "append", available_now, processing_time)
