"""

Every query reads the driver's parquet tables (through ``sensorlytics.sources.fixtures``)
and runs over the whole tables. Double results are rounded to 6 decimals (through 9) on
both sides so the value hashes do not depend on summation order. Window widths follow
FIXTURES.md §3 (dense enough that the 2-sigma rules have outliers to find).

``stream_*`` queries stage the readings (or text lines) as files under the checkpoint
folder, run the stream to completion with ``availableNow`` and return the sink table. Their
input is bounded, so it ends with an end marker that closes every window;
``stream_outliers_endless`` alone runs without one and holds the windows ending at least 5
minutes before the last reading (the final watermark), which its SQL states the same way.
``text_*`` and ``stream_text_*`` queries start from text lines without ``seq``.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlytics.operators import outliers as O
from sensorlytics.operators import reductions as R
from sensorlytics.functions.timecols import slot_floor_ms
from sensorlytics.operators.cells import with_window
from sensorlytics.operators import reports as P
from sensorlytics.plans import jobs as J
from sensorlytics.plans.attach import freeze
from sensorlytics.session import scratch_path
from sensorlytics.sinks import publish as K
from sensorlytics.sources import fixtures as X
from sensorlytics.sources import ingest as I
from sensorlytics.sources import power_logs as PL
from sensorlytics.streaming import jobs as SJ
from sensorlytics.streaming import sinks as SS

DAY = 86_400_000
HOUR = 3_600_000


def _r6(df: DataFrame) -> DataFrame:
    """Round doubles to 6 decimals through 9 (HALF_UP on decimals), so a one-ulp difference
    in a sum cannot land on different sides of a 6-decimal tie. The SQL side does the same
    with ``CAST(round(CAST(x AS DECIMAL(38, 9)), 6) AS DOUBLE)``."""
    cols = [F.round(F.round(F.col(f.name), 9), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name) for f in df.schema.fields]
    return df.select(*cols)


def _q(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: _r6(fn(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: JOB1 outlier counts per (sensor, 1-day window) on sf0.001."""
    return queries()["outliers_5min"](spark, "/root/testdata/sf0.001")


# ---------------------------------------------------------------- Spark side

def _level1_6h(spark, d):
    return J.outliers_level1(X.readings(spark, d), "6 hours")


def _flag_level1(spark, d, value):
    lvl = freeze(with_window(_level1_6h(spark, d), "3 days", ts="timestamp", out="win2"))
    f = O.std_flag(lvl, ["urn", "win2"], value, 2.0, flag="is_outlier")
    return f.select("urn", "timestamp", "values_count", "outliers_count", "is_outlier")


def _good(lines, order, strict=True):
    good, _ = I.parse_readings(lines, order, strict=strict)
    return good.select("seq", "urn", "value", "timestamp")


def _one_pass(spark, d):
    """Good readings and rejects of one write, next to each other."""
    good, rejects = I.ingest_lines(X.lines_bad(spark, d), "uvt", scratch_path(spark, "ingested"))
    return good.select("seq", "urn", "value", "timestamp", F.lit("").alias("reason")).unionByName(rejects.select(
        "seq", F.lit("").alias("urn"), F.lit(-1.0).alias("value"), F.lit(-1).cast("long").alias("timestamp"), "reason"))


def _csv_roundtrip(spark, d):
    path = scratch_path(spark, "typed-csv")
    I.write_typed_csv(X.readings(spark, d), path)
    return I.read_typed_csv(spark, path)


def _lines_nonfinite(spark, d):
    """Readings as lines, with NaN and Infinity as the value of some."""
    value = F.when(F.col("seq") % 97 == 0, "NaN").when(F.col("seq") % 97 == 1, "-Infinity").otherwise(
        F.col("value").cast("string"))
    return X.readings(spark, d).select("seq", F.concat_ws(",", "urn", value, F.col("timestamp").cast("string")).alias("line"))


def _counts_bad(spark, d):
    """Count messages with wrongly typed fields: what is good, and what is rejected."""
    seq = F.col("seq")
    ts = F.when(seq % 7 == 0, '"x"').when(seq % 7 == 1, "1.5").otherwise(F.col("timestamp").cast("string"))
    n = F.when(seq % 7 == 2, '"q"').otherwise(seq.cast("string"))
    payload = F.concat(F.lit('{"urn":"'), "urn", F.lit('","timestamp":'), ts, F.lit(',"valuesCount":'), n, F.lit("}"))
    good, rejects = I.parse_counts_json(X.readings(spark, d).select("seq", payload.alias("payload")))
    return good.select("seq", "timestamp", "values_count", F.lit("").alias("reason")).unionByName(
        rejects.select("seq", F.lit(-1).cast("long").alias("timestamp"), F.lit(-1).cast("long").alias("values_count"), "reason"))


def _flag_edge_cells(spark, d):
    """2-sigma flags on whole numbers, with readings of no sensor: those are in no cell."""
    r = X.readings(spark, d).withColumn("urn", F.when(F.col("seq") % 10 != 0, F.col("urn"))).withColumn(
        "value", F.floor(F.col("value")).cast("double"))
    return O.std_flag(with_window(r, "1 day")).select("seq", "urn", "is_outlier")


def _counts_roundtrip(spark, d):
    good, _ = I.parse_counts_json(K.counts_payload(J.outliers_level1(X.readings(spark, d), "1 day")))
    return good.select("urn", "timestamp", "values_count", "outliers_count")


def _export_roundtrip(spark, d):
    path = scratch_path(spark, "counts-csv")
    K.export_counts_csv(J.outliers_level1(X.readings(spark, d), "1 day"), path)
    return (spark.read.schema("urn STRING, timestamp BIGINT, values_count BIGINT, outliers_count BIGINT")
            .option("header", "true").option("mode", "FAILFAST").csv(path))


def _power_logs(spark, d):
    root = scratch_path(spark, "power-logs")
    per_run = P.power_by_run(X.power_samples(spark, d))
    grid = X.experiments(spark)
    folder = F.concat(F.col("name"), F.lit(".run"),
                      F.lpad((F.floor((F.col("run") - 1) / 15) + 1).cast("string"), 2, "0"))
    runs = per_run.join(F.broadcast(grid), ((per_run.run - 1) % 15) == grid.id).select(
        folder.alias("folder"), "total_avg_watts")
    PL.write_power_logs(runs, root)
    return PL.read_power_logs(spark, root, "*.txt")


_SUITE = X.SUITE


def _stage(spark, d, name="stream-src"):
    path = scratch_path(spark, name)
    X.readings(spark, d).write.parquet(path)
    return path


def _run(stream_start):
    q = stream_start
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _stream_passthrough(spark, d):
    src = scratch_path(spark, "stream-lines")
    X.lines(spark, d, "uvt").select("line").write.text(src)
    payloads, _ = SJ.passthrough_lines(SJ.text_stream(spark, src), "uvt", strict=False)
    out = scratch_path(spark, "passthrough")
    _run(SJ.start_to_table(payloads, out, scratch_path(spark, "ckpt")))
    return SS.read_table(spark, out)


def _published_messages(spark, d):
    out = scratch_path(spark, "messages")
    lvl1 = freeze(J.outliers_level1(X.readings(spark, d), "6 hours"))
    msgs = (K.counts_payload(lvl1)
            .unionByName(K.on_values_payload(J.outliers_on_values(lvl1, "3 days")))
            .unionByName(K.on_outliers_payload(J.outliers_on_outliers(lvl1, "3 days"))))
    K.write_messages(msgs, out)
    return spark.read.text(out).select("routing_key", F.col("value").alias("payload"))


def _stream_window_mean(spark, d):
    out = scratch_path(spark, "window-mean")
    _run(SJ.start_to_table(SJ.window_mean_updates(SJ.reading_stream(spark, _stage(spark, d)), "5 minutes"), out,
                           scratch_path(spark, "ckpt"), output_mode="update", keys=["urn", "timestamp"]))
    return SS.read_latest(spark, out, ["urn", "timestamp"])


def _stream_pairwise(spark, d, proc_width=None):
    out = scratch_path(spark, "pairwise")
    _run(SJ.start_pairwise_updates(SJ.reading_stream(spark, _stage(spark, d)), out, scratch_path(spark, "ckpt"), "1 day",
                                   processing_time_width=proc_width))
    return SS.read_latest(spark, out, ["urn", "win"]).select("urn", "timestamp", "value")


def _stream_text_pairwise(spark, d):
    src, out = scratch_path(spark, "text-readings"), scratch_path(spark, "pairwise")
    X.lines(spark, d, "uvt").select("line").write.text(src)
    readings, _ = I.parse_readings(SJ.text_stream(spark, src), "uvt")
    _run(SJ.start_pairwise_updates(readings, out, scratch_path(spark, "ckpt"), "1 day"))
    return SS.read_latest(spark, out, ["urn", "win"]).select("urn", "timestamp", "value")


def _stream_pairwise_batches(spark, d, batches, proc_width=None):
    """Readings in micro-batches by ``seq % batches``, each of them over the whole time: most are late. The
    clock shows 7 seconds more for every batch."""
    src, out, ckpt = (scratch_path(spark, n) for n in ("batches", "pairwise", "ckpt"))
    for b in range(batches):
        X.readings(spark, d).where(F.col("seq") % batches == b).write.mode("append").parquet(src)
        _run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src), out, ckpt, "1 day", processing_time_width=proc_width,
                                       clock=lambda b=b: 1_000_000 + 7000 * b))
    latest = SS.read_latest(spark, out, ["urn", "win"])
    return latest.select("urn", "win", "timestamp", "value") if proc_width else latest.select("urn", "timestamp", "value")


def _second_level_from_json(spark, messages, out, publish=None):
    """The level-1 messages, read back as JSON, through the second-level stream."""
    level1 = SJ.level1_messages(SJ.message_stream(spark, messages, K.ROUTING_LEVEL1))
    ckpt = scratch_path(spark, "ckpt")
    SJ.run_bounded(level1, scratch_path(spark, "end"), lambda end_marker: SJ.start_second_level(
        level1, out, ckpt, "3 days", end_marker=end_marker, publish=publish))


def _level1_messages(spark, d):
    messages = scratch_path(spark, "messages")
    publish = (K.counts_payload, messages)
    _bounded(spark, SJ.reading_stream(spark, _stage(spark, d)),
             partial(SJ.start_outlier_counts, width="6 hours", publish=publish), "level1")
    return messages


def _stream_json_second_level(spark, d):
    out = scratch_path(spark, "level2")
    _second_level_from_json(spark, _level1_messages(spark, d), out)
    return SS.read_table(spark, out)


def _stream_messages(spark, d):
    first, second, third = _level1_messages(spark, d), scratch_path(spark, "messages2"), scratch_path(spark, "messages3")
    _second_level_from_json(spark, first, scratch_path(spark, "level2"), (K.second_level_payloads, second))
    payloads = SJ.passthrough(SJ.reading_stream(spark, _stage(spark, d)))
    _run(SJ.start_messages(payloads, third, scratch_path(spark, "ckpt")))
    parts = [SS.read_messages(spark, p) for p in (first, second, third)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _bounded(spark, stream, start, name):
    """Run a closed-window job over all of its input, its last windows included."""
    out, ckpt = scratch_path(spark, name), scratch_path(spark, "ckpt")
    SJ.run_bounded(stream, scratch_path(spark, "end"),
                   lambda end_marker: start(stream, out, ckpt, end_marker=end_marker))
    return out


def _stream_closed(spark, d, transform):
    start = partial(SJ.start_on_closed_windows, transform=transform, width="1 day")
    return SS.read_table(spark, _bounded(spark, SJ.reading_stream(spark, _stage(spark, d)), start, "closed"))


def _stream_level1(spark, d, width):
    start = partial(SJ.start_outlier_counts, width=width)
    return _bounded(spark, SJ.reading_stream(spark, _stage(spark, d)), start, "level1")


def _stream_outliers(spark, d):
    return SS.read_table(spark, _stream_level1(spark, d, "1 day"))


def _stream_outliers_endless(spark, d):
    out = scratch_path(spark, "endless")
    _run(SJ.start_outlier_counts(SJ.reading_stream(spark, _stage(spark, d)), out, scratch_path(spark, "ckpt"), "1 day"))
    return SS.read_table(spark, out)


def _stream_second_level(spark, d):
    lvl1 = SJ.level1_stream(spark, _stream_level1(spark, d, "6 hours"))
    return SS.read_table(spark, _bounded(spark, lvl1, partial(SJ.start_second_level, width="3 days"), "level2"))


def _text_readings(spark, d):
    """Readings parsed from text lines: no ``seq``."""
    return I.parse_readings(X.lines(spark, d, "uvt").select("line"), "uvt")[0]


def _stream_text_outliers(spark, d):
    src = scratch_path(spark, "text-readings")
    X.lines(spark, d, "uvt").select("line").write.text(src)
    readings, _ = I.parse_readings(SJ.text_stream(spark, src), "uvt")
    return SS.read_table(spark, _bounded(spark, readings, partial(SJ.start_outlier_counts, width="1 day"), "text-level1"))


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # ingest
    "ingest_strict_uvt": lambda s, d: _good(X.lines_bad(s, d), "uvt"),
    "ingest_strict_rejects": lambda s, d: I.parse_readings(X.lines_bad(s, d), "uvt")[1].select("seq", "reason"),
    "ingest_strict_utv": lambda s, d: _good(X.lines(s, d, "utv"), "utv"),
    "ingest_trailing": lambda s, d: _good(X.lines_trailing(s, d), "uvt"),
    "ingest_one_pass": _one_pass,
    "ingest_lenient": lambda s, d: _good(X.lines_bad(s, d), "uvt", strict=False),
    "ingest_lenient_nonfinite": lambda s, d: _good(_lines_nonfinite(s, d), "uvt", strict=False),
    "ingest_csv_typed": _csv_roundtrip,
    "ingest_counts_json_bad": _counts_bad,
    "std_flag_edge_cells": _flag_edge_cells,
    "ingest_counts_json": _counts_roundtrip,
    # publish
    "publish_counts_json": lambda s, d: K.counts_payload(J.outliers_level1(X.readings(s, d), "1 day")),
    "publish_on_values_json": lambda s, d: K.on_values_payload(J.outliers_on_values(_level1_6h(s, d), "3 days")),
    "publish_on_outliers_json": lambda s, d: K.on_outliers_payload(
        J.outliers_on_outliers(_level1_6h(s, d), "3 days")),
    "publish_reading_csv": lambda s, d: K.reading_csv_payload(X.readings(s, d)),
    "publish_messages": _published_messages,
    "export_counts_csv": _export_roundtrip,
    # reports
    "runtimes_summary": lambda s, d: P.runtimes_summary(X.experiments(s), X.experiment_runs(s, d), _SUITE),
    "runtimes_stats": lambda s, d: P.runtimes_stats(X.experiments(s), X.experiment_runs(s, d)),
    "runtimes_runs": lambda s, d: P.runtimes_runs(X.experiments(s), X.experiment_runs(s, d)),
    "runtimes_csv": lambda s, d: P.runtimes_csv(X.experiments(s), X.experiment_runs(s, d), _SUITE),
    "power_by_run": lambda s, d: P.power_by_run(X.power_samples(s, d)),
    "power_log_table": _power_logs,
    # streaming (run to completion with availableNow, read back from the sink)
    "stream_passthrough": _stream_passthrough,
    "stream_window_mean": _stream_window_mean,
    "stream_outliers_5min": _stream_outliers,
    "stream_outliers_60min": _stream_second_level,
    "stream_outliers_endless": _stream_outliers_endless,
    "stream_text_outliers": _stream_text_outliers,
    "stream_pairwise_avg": _stream_pairwise,
    "stream_iqr_summary_raw_vs_clean": lambda s, d: _stream_closed(
        s, d, lambda b: J.iqr_summary_raw_vs_clean(b, "1 day")),
    "stream_std_summary_raw_vs_clean": lambda s, d: _stream_closed(
        s, d, lambda b: J.std_summary_raw_vs_clean(b, "1 day")),
    "stream_std_removed_summary": lambda s, d: _stream_closed(s, d, lambda b: J.std_removed_summary(b, "1 day")),
    "stream_proc_time_pairwise_avg": lambda s, d: _stream_pairwise(s, d, "10 seconds"),
    "stream_text_pairwise_avg": _stream_text_pairwise,
    "stream_pairwise_late": lambda s, d: _stream_pairwise_batches(s, d, 3),
    "stream_proc_time_windows": lambda s, d: _stream_pairwise_batches(s, d, 5, "10 seconds"),
    "stream_json_outliers_60min": _stream_json_second_level,
    "stream_publish_messages": _stream_messages,
    # file jobs from text lines
    "text_iqr_summary": lambda s, d: J.iqr_summary_raw_vs_clean(_text_readings(s, d), "1 day"),
    "text_std_removed_summary": lambda s, d: J.std_removed_summary(_text_readings(s, d), "1 day"),
    "text_pairwise_avg": lambda s, d: R.pairwise_avg(_text_readings(s, d), "1 day"),
    # JOB10 batch reductions on hourly slots
    "batch_sum": lambda s, d: J.batch_reductions(X.readings(s, d), 60).select("urn", "timestamp", "sum"),
    "batch_avg": lambda s, d: J.batch_reductions(X.readings(s, d), 60).select("urn", "timestamp", "average"),
    "batch_min": lambda s, d: J.batch_reductions(X.readings_signed(s, d), 60).select(
        "urn", "timestamp", "min_seed0", "min"),
    "batch_max": lambda s, d: J.batch_reductions(X.readings_signed(s, d), 60).select(
        "urn", "timestamp", "max_seed0", "max"),
    "batch_reductions_parts": lambda s, d: J.batch_reductions(X.readings_parts(s, d), 60),
    "batch_outlier_values": lambda s, d: J.batch_outlier_values(X.readings(s, d), 60),
    "batch_report": lambda s, d: J.batch_report(X.readings(s, d), 60),
    # JOB11
    "batch_group_mean": lambda s, d: R.batch_group_mean(X.readings(s, d), 1),
    "distinct_counts": lambda s, d: R.distinct_counts(X.readings(s, d), 1),
    "slot_floor": lambda s, d: X.readings(s, d).select(
        "seq", "urn", "timestamp", slot_floor_ms("timestamp", 7).alias("slot")),
    # summaries and means
    "window_summary": lambda s, d: R.window_summary(X.readings(s, d), "60 minutes"),
    "window_mean": lambda s, d: R.window_mean(X.readings(s, d), "5 minutes"),
    "window_int_mean": lambda s, d: R.window_int_mean(X.readings(s, d), "60 minutes"),
    "window_int_mean_signed": lambda s, d: R.window_int_mean(X.readings_signed(s, d), "60 minutes"),
    "pairwise_avg": lambda s, d: R.pairwise_avg(X.readings(s, d), "1 day"),
    "proc_time_pairwise_avg": lambda s, d: J.proc_time_pairwise_avg(
        X.readings(s, d).withColumn("arrival_ms", F.col("timestamp")), "arrival_ms", "10 seconds"),
    # 2-sigma rules, 1-day cells
    "std_flag": lambda s, d: O.std_flag(with_window(X.readings(s, d), "1 day")).drop("win"),
    "std_keep_inside": lambda s, d: O.std_keep_inside(with_window(X.readings(s, d), "1 day")).drop("win"),
    "std_remove_outliers": lambda s, d: O.std_remove_outliers(with_window(X.readings(s, d), "1 day")).drop("win"),
    "std_removed_log": lambda s, d: O.std_removed(with_window(X.readings(s, d), "1 day")).drop("win"),
    "iqr_keep_inside": lambda s, d: O.iqr_keep_inside(with_window(X.readings(s, d), "1 day")).drop("win"),
    # JOB1 / JOB2
    "outliers_5min": lambda s, d: J.outliers_level1(X.readings(s, d), "1 day"),
    "outliers_by_user": lambda s, d: J.outliers_level1(X.readings_by_user(s, d), "3 days"),
    "outliers_parts": lambda s, d: J.outliers_level1(X.readings_parts(s, d), "30 days"),
    "outliers_on_values_60min": lambda s, d: J.outliers_on_values(_level1_6h(s, d), "3 days"),
    "outliers_on_outliers_60min": lambda s, d: J.outliers_on_outliers(_level1_6h(s, d), "3 days"),
    "outliers_two_level": lambda s, d: J.outliers_two_level(X.readings(s, d), "6 hours", "3 days"),
    "flag_values_count": lambda s, d: _flag_level1(s, d, "values_count"),
    "flag_outliers_count": lambda s, d: _flag_level1(s, d, "outliers_count"),
    # JOB3-JOB5
    "iqr_summary_raw_vs_clean": lambda s, d: J.iqr_summary_raw_vs_clean(X.readings(s, d), "1 day"),
    "std_summary_raw_vs_clean": lambda s, d: J.std_summary_raw_vs_clean(X.readings(s, d), "1 day"),
    "std_removed_summary": lambda s, d: J.std_removed_summary(X.readings(s, d), "1 day"),
}


def _training_data() -> tuple[dict, dict]:
    """Queries and oracles of the training-data operators. Without their folder, or without a library
    they need, there are none (a warning says which), and the other queries stand."""
    try:
        from sensorlytics.llm import registry
        found, oracles = dict(registry.QUERIES), dict(registry.ORACLES)
    except ImportError as e:
        if e.name not in ("sensorlytics.llm", "sensorlytics.llm.registry"):
            warnings.warn(f"training-data queries left out: {e}")
        return {}, {}
    try:
        import corpus_pipeline
    except ImportError as e:
        if e.name != "corpus_pipeline":
            warnings.warn(f"pipeline left out: {e}")
        return found, oracles
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        oracles["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, oracles


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _q(v) for k, v in _QUERIES.items()} | _training_data()[0]


# ---------------------------------------------------------------- DuckDB side

def _pm(x: str, w: int) -> str:
    return f"({x} - ((({x}) % {w}) + {w}) % {w})"


_R = """r AS (SELECT event_type AS urn, value, (epoch_us(ts) // 1000) AS "timestamp", event_id AS seq FROM events)"""
_R_SIGNED = """r AS (SELECT event_type AS urn, value - 80 AS value, (epoch_us(ts) // 1000) AS "timestamp", event_id AS seq
                     FROM events)"""
_R_USER = """r AS (SELECT CAST(user_id AS VARCHAR) AS urn, value, (epoch_us(ts) // 1000) AS "timestamp", event_id AS seq
                   FROM events)"""
_R_PARTS = """r AS (SELECT CAST(l_suppkey AS VARCHAR) AS urn, l_extendedprice AS value,
                           (epoch_us(l_shipdate) // 1000) AS "timestamp", l_orderkey * 16 + l_linenumber AS seq FROM lineitem)"""


def _slot(x: str, minutes: int) -> str:
    hour = f"({x} - ((({x}) % {HOUR}) + {HOUR}) % {HOUR})"
    minute = f"floor(((({x}) % {HOUR}) + {HOUR}) % {HOUR} / 60000)"
    return f"CAST({hour} + floor({minute} / {minutes}) * {minutes * 60000} AS BIGINT)"


def _flag_ctes(src: str, keys: str, value: str, k: float = 2.0, name: str = "f") -> str:
    """``{name}``: rows of ``src`` plus a guarded 2-sigma ``is_outlier`` flag."""
    return f"""{name}_s AS (SELECT {keys}, avg({value}) AS a, stddev_samp({value}) AS sd, min({value}) AS mn,
                                max({value}) AS mx FROM {src} GROUP BY {keys}),
{name}_g AS (SELECT {keys}, CASE WHEN mn = mx THEN mn ELSE a END AS mean,
                    CASE WHEN mn = mx THEN 0.0 ELSE coalesce(sd, 0.0) END AS sd FROM {name}_s),
{name} AS (SELECT {src}.*, ({value} < mean - {k} * {name}_g.sd OR {value} > mean + {k} * {name}_g.sd) AS is_outlier,
                  mean - {k} * {name}_g.sd AS lo, mean + {k} * {name}_g.sd AS hi
           FROM {src} JOIN {name}_g USING ({keys}))"""


def _level1(readings_cte: str, width: int, name: str = "l1") -> str:
    return f"""{readings_cte},
c1 AS (SELECT urn, value, {_pm('"timestamp"', width)} AS win FROM r),
{_flag_ctes('c1', 'urn, win', 'value')},
{name} AS (SELECT urn, win AS "timestamp", count(*) AS values_count,
                  count(*) FILTER (WHERE is_outlier) AS outliers_count FROM f GROUP BY urn, win)"""


def _level2_flag(value: str) -> str:
    return f"""WITH {_level1(_R, 6 * HOUR)},
c2 AS (SELECT *, {_pm('"timestamp"', 3 * DAY)} AS win2 FROM l1),
{_flag_ctes('c2', 'urn, win2', value, name='f2')}"""


def _summary_sql(src: str, width: int) -> str:
    return f"""SELECT urn, {_pm('"timestamp"', width)} AS start, CAST(round(CAST(sum(value) / count(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS average,
       CAST(round(CAST(min(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "min", CAST(round(CAST(max(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "max", count(value) AS "count",
       CAST(round(CAST(sum(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "sum" FROM {src} GROUP BY urn, start"""


def _slot_red(readings_cte: str, minutes: int) -> str:
    return f"""WITH {readings_cte},
s AS (SELECT urn, {_slot('"timestamp"', minutes)} AS "timestamp", sum(value) AS sm, avg(value) AS av,
             min(value) AS mn, max(value) AS mx FROM r GROUP BY urn, 2)"""


def _ranked(src: str, keys: str, order: str) -> str:
    return f"""SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn,
                   count(*) OVER (PARTITION BY {keys}) AS n FROM {src}"""


def _type6(p: float, xs: str = "x") -> str:
    pos = f"({p} * (n + 1))"
    return (f"CASE WHEN {pos} < 1 THEN {xs}[1] WHEN {pos} >= n THEN {xs}[n] "
            f"ELSE {xs}[CAST(floor({pos}) AS BIGINT)] + ({pos} - floor({pos})) * "
            f"({xs}[CAST(floor({pos}) AS BIGINT) + 1] - {xs}[CAST(floor({pos}) AS BIGINT)]) END")


_IQR_CTES = f"""{_R},
c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', DAY)} AS win FROM r),
q AS (SELECT urn, win, x, len(x) AS n FROM (SELECT urn, win, list(value ORDER BY value) AS x FROM c GROUP BY urn, win)),
b AS (SELECT urn, win, {_type6(0.25)} AS q1, {_type6(0.75)} AS q3 FROM q),
kept AS (SELECT c.* FROM c JOIN b USING (urn, win) WHERE value > q1 AND value < q3)"""

_STD_KEEP = f"""{_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', DAY)} AS win FROM r),
{_flag_ctes('c', 'urn, win', 'value')}"""


def _raw_vs_clean(kept_cte: str, kept: str) -> str:
    return f"""WITH {kept_cte}
SELECT 'raw' AS kind, * FROM ({_summary_sql('r', DAY)})
UNION ALL SELECT 'clean' AS kind, * FROM ({_summary_sql(kept, DAY)})"""


_E = """e AS (SELECT i AS id, 'gb.top' || lpad(CAST(w AS VARCHAR), 3, '0') || '-' || CAST(sl AS VARCHAR) AS name,
                    'gb.scale-out' AS suite
             FROM (SELECT range AS i, [1, 2, 4, 8, 16][range // 3 + 1] AS w, [1, 2, 4][range % 3 + 1] AS sl
                   FROM range(15))),
er AS (SELECT o_custkey % 15 AS experiment_id, CAST(o_orderkey % 3 + 1 AS INTEGER) AS run,
              CAST(floor(max(o_totalprice)) AS BIGINT) AS "time" FROM orders GROUP BY 1, 2),
j AS (SELECT * FROM e JOIN er ON e.id = er.experiment_id)"""

_POWER = """p AS (SELECT CAST(day(ts) AS INTEGER) AS run, event_type AS node, CAST(floor(value) AS INTEGER) AS watts
             FROM events),
pn AS (SELECT run, node, avg(watts) AS a FROM p GROUP BY run, node),
pr AS (SELECT run, count(*) AS nodes, sum(a) AS total_avg_watts FROM pn GROUP BY run)"""

_BAD = f"""{_R}, b AS (SELECT *, CASE WHEN seq % 107 = 0 THEN 'field_count' WHEN seq % 101 = 0 THEN 'bad_value'
                               WHEN seq % 103 = 0 THEN 'bad_timestamp' END AS reason FROM r)"""


def _json(*pairs: tuple[str, str]) -> str:
    inner = ", ".join(f"'{k}', {v}" for k, v in pairs)
    return f"CAST(json_object({inner}) AS VARCHAR)"


_MAXTS = "(SELECT max(epoch_us(ts) // 1000) FROM events)"

_SQL: dict[str, str] = {
    "stream_passthrough": f"""WITH {_R} SELECT 'readings' AS routing_key,
       printf('%s,%f,%d', urn, value, "timestamp") AS payload FROM r WHERE seq % 97 <> 0""",
    "publish_messages": f"""WITH {_level1(_R, 6 * HOUR)},
c2 AS (SELECT *, {_pm('"timestamp"', 3 * DAY)} AS win2 FROM l1),
{_flag_ctes('c2', 'urn, win2', 'values_count', name='fv')},
{_flag_ctes('c2', 'urn, win2', 'outliers_count', name='fo')},
v AS (SELECT urn, win2 AS "timestamp", count(*) AS values_count,
             count(*) FILTER (WHERE is_outlier) AS outliers_on_values_count FROM fv GROUP BY urn, win2),
o AS (SELECT urn, win2 AS "timestamp", count(*) AS outliers_count,
             count(*) FILTER (WHERE is_outlier) AS outliers_on_outliers_count FROM fo GROUP BY urn, win2)
SELECT '5min' AS routing_key, {_json(('urn', 'urn'), ('timestamp', '"timestamp"'), ('valuesCount', 'values_count'),
                                      ('outliersCount', 'outliers_count'))} AS payload FROM l1
UNION ALL
SELECT 'v60min', {_json(('urn', 'urn'), ('timestamp', '"timestamp"'), ('valuesCount', 'values_count'),
                         ('outliersOnValuesCount', 'outliers_on_values_count'))} FROM v
UNION ALL
SELECT 'o60min', {_json(('urn', 'urn'), ('timestamp', '"timestamp"'), ('outliersCount', 'outliers_count'),
                         ('outliersOnOutliersCount', 'outliers_on_outliers_count'))} FROM o""",
    "stream_window_mean": f"""WITH {_R} SELECT urn, {_pm('"timestamp"', 300000)} AS "timestamp",
       CAST(round(CAST(avg(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value FROM r GROUP BY urn, 2""",
    "stream_iqr_summary_raw_vs_clean": _raw_vs_clean(_IQR_CTES, "kept"),
    "text_iqr_summary": _raw_vs_clean(_IQR_CTES, "kept"),
    "stream_std_summary_raw_vs_clean": _raw_vs_clean(
        _STD_KEEP + ", kept AS (SELECT * FROM f WHERE value > lo AND value < hi)", "kept"),
    "stream_std_removed_summary": f"""WITH {_STD_KEEP}, kept AS (SELECT * FROM f WHERE NOT is_outlier) {
        _summary_sql("kept", DAY)}""",
    "text_std_removed_summary": f"""WITH {_STD_KEEP}, kept AS (SELECT * FROM f WHERE NOT is_outlier) {
        _summary_sql("kept", DAY)}""",
    "text_pairwise_avg": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", {_pm('"timestamp"', DAY)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', '"timestamp", value')})
SELECT urn, win AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "stream_pairwise_avg": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', DAY)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', '"timestamp", seq')})
SELECT urn, win AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "stream_proc_time_pairwise_avg": f"""WITH {_R}, k AS ({_ranked('r', 'urn', '"timestamp", seq')})
SELECT urn, min("timestamp") AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn""",
    "stream_pairwise_late": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', DAY)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', 'seq % 3, "timestamp", seq')})
SELECT urn, win AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "stream_proc_time_windows": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('(1000000 + 7000 * (seq % 5))', 10000)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', 'seq % 5, "timestamp", seq')})
SELECT urn, win, min("timestamp") AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "stream_outliers_5min": f"WITH {_level1(_R, DAY)} SELECT * FROM l1",
    "stream_text_outliers": f"WITH {_level1(_R, DAY)} SELECT * FROM l1",
    "stream_outliers_endless": f"""WITH {_level1(_R, DAY)} SELECT * FROM l1
WHERE "timestamp" + {DAY} <= {_MAXTS} - 300000""",
    "stream_outliers_60min": f"""WITH {_level1(_R, 6 * HOUR)},
c2 AS (SELECT *, {_pm('"timestamp"', 3 * DAY)} AS win2 FROM l1),
{_flag_ctes('c2', 'urn, win2', 'values_count', name='fv')},
{_flag_ctes('c2', 'urn, win2', 'outliers_count', name='fo')}
SELECT urn, win2 AS "timestamp", count(*) AS intervals,
       count(*) FILTER (WHERE fv.is_outlier) AS outliers_on_values_count,
       (SELECT count(*) FROM fo WHERE fo.urn = fv.urn AND fo.win2 = fv.win2 AND fo.is_outlier)
         AS outliers_on_outliers_count
FROM fv GROUP BY urn, win2""",
    "ingest_strict_uvt": f"WITH {_BAD} SELECT seq, urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\" FROM b WHERE reason IS NULL",
    "ingest_strict_rejects": f"WITH {_BAD} SELECT seq, reason FROM b WHERE reason IS NOT NULL",
    "ingest_strict_utv": f"WITH {_R} SELECT seq, urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\" FROM r",
    "ingest_one_pass": f"""WITH {_BAD} SELECT seq, CASE WHEN reason IS NULL THEN urn ELSE '' END AS urn,
       CASE WHEN reason IS NULL THEN CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) ELSE -1 END AS value,
       CASE WHEN reason IS NULL THEN "timestamp" ELSE -1 END AS "timestamp", coalesce(reason, '') AS reason FROM b""",
    "ingest_trailing": f"WITH {_R} SELECT seq, urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\" FROM r",
    "ingest_lenient_nonfinite": f"""WITH {_R} SELECT seq, urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, "timestamp"
        FROM r WHERE seq % 97 > 1""",
    "ingest_counts_json_bad": f"""WITH {_R} SELECT seq, CASE WHEN seq % 7 > 2 THEN "timestamp" ELSE -1 END AS "timestamp",
        CASE WHEN seq % 7 > 2 THEN seq ELSE -1 END AS values_count, CASE WHEN seq % 7 > 2 THEN '' ELSE 'bad_message' END AS reason FROM r""",
    "std_flag_edge_cells": f"""WITH {_R}, c AS (SELECT seq, urn, floor(value) AS value, {_pm('"timestamp"', DAY)} AS win FROM r WHERE seq % 10 <> 0),
        {_flag_ctes('c', 'urn, win', 'value')} SELECT seq, urn, is_outlier FROM f""",
    "ingest_lenient": f"""WITH {_R} SELECT seq, urn, CASE WHEN seq % 101 = 0 THEN 0.0 ELSE CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) END AS value,
       CASE WHEN seq % 103 = 0 THEN 0 ELSE "timestamp" END AS "timestamp" FROM r WHERE seq % 97 <> 0""",
    "ingest_csv_typed": f"WITH {_R} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\" FROM r",
    "ingest_counts_json": f"WITH {_level1(_R, DAY)} SELECT * FROM l1",
    "publish_counts_json": f"""WITH {_level1(_R, DAY)} SELECT '5min' AS routing_key,
       {_json(('urn', 'urn'), ('timestamp', '"timestamp"'), ('valuesCount', 'values_count'),
              ('outliersCount', 'outliers_count'))} AS payload FROM l1""",
    "publish_on_values_json": _level2_flag("values_count") + f""",
v AS (SELECT urn, win2 AS "timestamp", count(*) AS values_count,
             count(*) FILTER (WHERE is_outlier) AS outliers_on_values_count FROM f2 GROUP BY urn, win2)
SELECT 'v60min' AS routing_key, {_json(('urn', 'urn'), ('timestamp', '"timestamp"'), ('valuesCount', 'values_count'),
                                        ('outliersOnValuesCount', 'outliers_on_values_count'))} AS payload FROM v""",
    "publish_on_outliers_json": _level2_flag("outliers_count") + f""",
v AS (SELECT urn, win2 AS "timestamp", count(*) AS outliers_count,
             count(*) FILTER (WHERE is_outlier) AS outliers_on_outliers_count FROM f2 GROUP BY urn, win2)
SELECT 'o60min' AS routing_key, {_json(('urn', 'urn'), ('timestamp', '"timestamp"'),
                                        ('outliersCount', 'outliers_count'),
                                        ('outliersOnOutliersCount', 'outliers_on_outliers_count'))} AS payload FROM v""",
    "publish_reading_csv": f"""WITH {_R} SELECT 'readings' AS routing_key,
       printf('%s,%f,%d', urn, value, "timestamp") AS payload FROM r""",
    "export_counts_csv": f"WITH {_level1(_R, DAY)} SELECT * FROM l1",
    "runtimes_summary": f"""WITH {_E} SELECT suite, name, min("time") AS min_time, max("time") AS max_time,
       CAST(sum("time") - min("time") - max("time") AS BIGINT) AS median_time,
       CAST(median("time") AS DOUBLE) AS median
FROM j WHERE suite = 'gb.scale-out' GROUP BY suite, name ORDER BY suite, name""",
    "runtimes_stats": f"""WITH {_E} SELECT name, suite, CAST(round(avg("time") / 1000.0, 2) AS DECIMAL(18, 2)) AS average,
       CAST(median("time") AS DOUBLE) / 1000.0 AS median, CAST(max("time") AS DOUBLE) / 1000.0 AS "max",
       CAST(min("time") AS DOUBLE) / 1000.0 AS "min", count(*) AS number_of_runs
FROM j GROUP BY suite, name ORDER BY name, suite""",
    "runtimes_runs": f"""WITH {_E} SELECT name, suite, "time" AS runtime, run FROM j""",
    "runtimes_csv": f"""WITH {_E} SELECT ltrim(regexp_replace(split_part(name, '-', 1), '[^0-9]', '', 'g'), '0') AS worker,
       ltrim(split_part(name, '-', 2), '0') AS task_slots, run, "time" AS runtime_ms
FROM j WHERE suite = 'gb.scale-out' ORDER BY suite, name""",
    "power_by_run": f"WITH {_POWER} SELECT run, nodes, CAST(round(CAST(total_avg_watts AS DECIMAL(38, 9)), 6) AS DOUBLE) AS total_avg_watts FROM pr",
    "power_log_table": f"""WITH {_POWER}
SELECT ltrim(CAST([1, 2, 4, 8, 16][((run - 1) % 15) // 3 + 1] AS VARCHAR), '0') AS worker,
       CAST([1, 2, 4][((run - 1) % 15) % 3 + 1] AS VARCHAR) AS task_slots,
       CAST((run - 1) // 15 + 1 AS VARCHAR) AS run, CAST(round(CAST(total_avg_watts AS DECIMAL(38, 9)), 6) AS DOUBLE) AS pdu_w FROM pr""",
    "batch_sum": _slot_red(_R, 60) + ' SELECT urn, "timestamp", CAST(round(CAST(sm AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "sum" FROM s',
    "batch_avg": _slot_red(_R, 60) + ' SELECT urn, "timestamp", CAST(round(CAST(av AS DECIMAL(38, 9)), 6) AS DOUBLE) AS average FROM s',
    "batch_min": _slot_red(_R_SIGNED, 60) + ' SELECT urn, "timestamp", CAST(round(CAST(least(0.0, mn) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS min_seed0, '
                                            'CAST(round(CAST(mn AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "min" FROM s',
    "batch_max": _slot_red(_R_SIGNED, 60) + ' SELECT urn, "timestamp", CAST(round(CAST(greatest(0.0, mx) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS max_seed0, '
                                            'CAST(round(CAST(mx AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "max" FROM s',
    "batch_reductions_parts": _slot_red(_R_PARTS, 60) + ''' SELECT urn, "timestamp", CAST(round(CAST(sm AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "sum",
        CAST(round(CAST(av AS DECIMAL(38, 9)), 6) AS DOUBLE) AS average, CAST(round(CAST(least(0.0, mn) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS min_seed0, CAST(round(CAST(mn AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "min",
        CAST(round(CAST(greatest(0.0, mx) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS max_seed0, CAST(round(CAST(mx AS DECIMAL(38, 9)), 6) AS DOUBLE) AS "max" FROM s''',
    "batch_outlier_values": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", {_slot('"timestamp"', 60)} AS win FROM r),
{_flag_ctes('c', 'urn, win', 'value')}
SELECT urn, win AS slot, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, "timestamp" FROM f WHERE is_outlier""",
    "batch_report": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", {_slot('"timestamp"', 60)} AS win FROM r),
{_flag_ctes('c', 'urn, win', 'value')},
g AS (SELECT count(*) AS n FROM (SELECT DISTINCT urn, win FROM c))
SELECT reduction, n AS result_rows FROM g, (VALUES ('min'), ('max'), ('sum'), ('average')) t(reduction)
UNION ALL SELECT 'outliers', count(*) FROM f WHERE is_outlier""",
    "batch_group_mean": f"""WITH {_R} SELECT urn, {_slot('"timestamp"', 1)} AS "timestamp", CAST(round(CAST(avg(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM r GROUP BY urn, 2""",
    "distinct_counts": f"""WITH {_R}, c AS (SELECT urn, {_slot('"timestamp"', 1)} AS win FROM r)
SELECT count(DISTINCT urn) AS urns, count(DISTINCT win) AS slots, count(DISTINCT (urn, win)) AS pairs FROM c""",
    "slot_floor": f"""WITH {_R} SELECT seq, urn, "timestamp", {_slot('"timestamp"', 7)} AS slot FROM r""",
    "window_summary": f"WITH {_R} " + _summary_sql("r", HOUR),
    "window_mean": f"""WITH {_R} SELECT urn, {_pm('"timestamp"', 300000)} AS "timestamp", CAST(round(CAST(avg(value) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM r GROUP BY urn, 2""",
    "window_int_mean": f"""WITH {_R}, c AS (SELECT urn, value, {_pm('"timestamp"', HOUR)} AS win FROM r)
SELECT urn, win AS "timestamp",
       CAST(round(CAST(CAST(floor(least(sum(floor(value)), 2147483647) / count(*)) AS DOUBLE) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM c GROUP BY urn, win""",
    "window_int_mean_signed": f"""WITH {_R_SIGNED}, c AS (SELECT urn, value, "timestamp", seq,
       {_pm('"timestamp"', HOUR)} AS win FROM r),
t AS (SELECT urn, win, count(*) AS n,
             list_reduce(list_prepend(0.0, list(value ORDER BY "timestamp", seq)),
                         lambda acc, x: least(greatest(trunc(acc + x), -2147483648.0), 2147483647.0)) AS total
      FROM c GROUP BY urn, win)
SELECT urn, win AS "timestamp", CAST(trunc(total / n) AS DOUBLE) AS value FROM t""",
    "pairwise_avg": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', DAY)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', '"timestamp", seq')})
SELECT urn, win AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "proc_time_pairwise_avg": f"""WITH {_R}, c AS (SELECT urn, value, "timestamp", seq, {_pm('"timestamp"', 10000)} AS win FROM r),
k AS ({_ranked('c', 'urn, win', '"timestamp", seq')})
SELECT urn, min("timestamp") AS "timestamp", CAST(round(CAST(sum(value * pow(0.5, least(n - 1, n - rn + 1))) AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value
FROM k GROUP BY urn, win""",
    "std_flag": f"WITH {_STD_KEEP} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\", seq, is_outlier FROM f",
    "std_keep_inside": f"WITH {_STD_KEEP} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\", seq FROM f "
                       f"WHERE value > lo AND value < hi",
    "std_remove_outliers": f"WITH {_STD_KEEP} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\", seq FROM f "
                           f"WHERE NOT is_outlier",
    "std_removed_log": f"WITH {_STD_KEEP} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\", seq FROM f "
                       f"WHERE is_outlier",
    "iqr_keep_inside": f"WITH {_IQR_CTES} SELECT urn, CAST(round(CAST(value AS DECIMAL(38, 9)), 6) AS DOUBLE) AS value, \"timestamp\", seq FROM kept",
    "outliers_5min": f"WITH {_level1(_R, DAY)} SELECT * FROM l1",
    "outliers_by_user": f"WITH {_level1(_R_USER, 3 * DAY)} SELECT * FROM l1",
    "outliers_parts": f"WITH {_level1(_R_PARTS, 30 * DAY)} SELECT * FROM l1",
    "outliers_on_values_60min": _level2_flag("values_count") + """
SELECT urn, win2 AS "timestamp", count(*) AS values_count, count(*) FILTER (WHERE is_outlier) AS outliers_on_values_count
FROM f2 GROUP BY urn, win2""",
    "outliers_on_outliers_60min": _level2_flag("outliers_count") + """
SELECT urn, win2 AS "timestamp", count(*) AS outliers_count,
       count(*) FILTER (WHERE is_outlier) AS outliers_on_outliers_count FROM f2 GROUP BY urn, win2""",
    "outliers_two_level": f"""WITH {_level1(_R, 6 * HOUR)},
c2 AS (SELECT *, {_pm('"timestamp"', 3 * DAY)} AS win2 FROM l1),
{_flag_ctes('c2', 'urn, win2', 'values_count', name='fv')},
{_flag_ctes('c2', 'urn, win2', 'outliers_count', name='fo')}
SELECT urn, win2 AS "timestamp", count(*) AS intervals,
       count(*) FILTER (WHERE fv.is_outlier) AS outliers_on_values_count,
       (SELECT count(*) FROM fo WHERE fo.urn = fv.urn AND fo.win2 = fv.win2 AND fo.is_outlier)
         AS outliers_on_outliers_count
FROM fv GROUP BY urn, win2""",
    "flag_values_count": _level2_flag("values_count") +
    ' SELECT urn, "timestamp", values_count, outliers_count, is_outlier FROM f2',
    "flag_outliers_count": _level2_flag("outliers_count") +
    ' SELECT urn, "timestamp", values_count, outliers_count, is_outlier FROM f2',
    "iqr_summary_raw_vs_clean": _raw_vs_clean(_IQR_CTES, "kept"),
    "std_summary_raw_vs_clean": _raw_vs_clean(_STD_KEEP + ", kept AS (SELECT * FROM f WHERE value > lo AND value < hi)",
                                              "kept"),
    "std_removed_summary": f"WITH {_STD_KEEP}, kept AS (SELECT * FROM f WHERE NOT is_outlier) "
                           + _summary_sql("kept", DAY),
}


_SQL["stream_text_pairwise_avg"] = _SQL["text_pairwise_avg"]
_SQL["stream_json_outliers_60min"] = _SQL["stream_outliers_60min"]
_SQL["stream_publish_messages"] = f"""SELECT * FROM ({_SQL["publish_messages"]})
UNION ALL SELECT * FROM ({_SQL["publish_reading_csv"]})"""


def oracle_sql() -> dict[str, str]:
    return dict(_SQL) | _training_data()[1]
