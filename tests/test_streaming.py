"""Streams: stream = batch in update mode, and late data (append drops, update keeps)."""

import time

from pyspark.sql import functions as F

from conftest import SF001
from sensorlytics.operators import reductions as R
from sensorlytics.session import scratch_path
from sensorlytics.sources import fixtures as X
from sensorlytics.streaming import jobs as SJ
from sensorlytics.streaming import sinks as SS

DAY = 86_400_000


def run(q):
    q.awaitTermination()
    assert q.exception() is None


def test_update_stream_equals_batch(spark):
    r = X.readings(spark, SF001)
    src = scratch_path(spark, "t-src")
    lo, hi = r.agg(F.min("timestamp"), F.max("timestamp")).first()
    step = (hi - lo) // 4 + 1
    for i in range(4):  # four files in time order, one per micro-batch
        r.where((F.col("timestamp") >= lo + i * step) & (F.col("timestamp") < lo + (i + 1) * step)) \
            .coalesce(1).write.mode("append").parquet(src)
    out = scratch_path(spark, "t-out")
    run(SJ.start_to_table(SJ.window_mean_updates(SJ.reading_stream(spark, src, max_files_per_trigger=1), "1 day"),
                          out, scratch_path(spark, "t-ck"), output_mode="update"))
    got = {(x.urn, x.timestamp): x.value for x in SS.read_latest(spark, out, ["urn", "timestamp"]).collect()}
    want = {(x.urn, x.timestamp): x.value for x in R.window_mean(r, "1 day").collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9


def test_late_reading_dropped_in_append_kept_in_update(spark):
    schema = "urn string, value double, timestamp long, seq long"
    day1 = [("s", float(v), 1000 * i, i) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 50])]
    day2 = [("s", 1.0, DAY + 600_000, 100)]          # moves the watermark past the end of day 1
    more = [("s", 2.0, DAY + 700_000, 102)]
    late = [("s", 1000.0, 500_000, 101)]             # day 1, behind the watermark
    src = scratch_path(spark, "t-late")
    # Spark drops a row as late against the watermark of the batch before the current one,
    # so the late reading arrives two micro-batches after the one that closed day 1.
    for i, rows in enumerate([day1 + day2, more, late]):
        if i:
            time.sleep(1.1)
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)

    out = scratch_path(spark, "t-late-out")
    run(SJ.start_outlier_counts(SJ.reading_stream(spark, src, max_files_per_trigger=1), out,
                                scratch_path(spark, "t-late-ck"), "1 day"))
    counts = {x.timestamp: (x.values_count, x.outliers_count) for x in SS.read_table(spark, out).collect()}
    assert counts[0] == (10, 1)                      # the late reading is not counted

    out2 = scratch_path(spark, "t-late-upd")
    run(SJ.start_to_table(SJ.window_mean_updates(SJ.reading_stream(spark, src, max_files_per_trigger=1), "1 day"),
                          out2, scratch_path(spark, "t-late-ck2"), output_mode="update"))
    means = {x.timestamp: x.value for x in SS.read_latest(spark, out2, ["urn", "timestamp"]).collect()}
    assert means[0] == (sum(range(1, 10)) + 50 + 1000.0) / 11  # unlimited lateness: included
    assert means[DAY] == 1.5


def test_pairwise_stream_refolds_late_cells(spark):
    schema = "urn string, value double, timestamp long, seq long"
    first = [("s", 1.0, 1000, 0), ("s", 2.0, 2000, 1), ("s", 8.0, DAY + 5000, 3)]
    late = [("s", 4.0, 3000, 2)]                     # lands in the first window after it was folded
    src = scratch_path(spark, "t-pw")
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(src)
    time.sleep(1.1)
    spark.createDataFrame(late, schema).coalesce(1).write.mode("append").parquet(src)
    out = scratch_path(spark, "t-pw-out")
    run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src, max_files_per_trigger=1), out,
                                  scratch_path(spark, "t-pw-ck"), "1 day"))
    got = {x.timestamp: x.value for x in SS.read_latest(spark, out, ["urn", "win"]).collect()}
    assert got == {0: ((1.0 + 2.0) / 2 + 4.0) / 2, DAY: 8.0}


def test_bounded_run_emits_the_last_windows(spark):
    schema = "urn string, value double, timestamp long, seq long"
    day1 = [("s", float(v), 1000 * i, i) for i, v in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 50])]
    day2 = [("s", 1.0, DAY + 600_000, 100), (None, 3.0, DAY + 700_000, 101)]
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-end", "t-end-out", "t-end-ck"))
    spark.createDataFrame(day1, schema).coalesce(1).write.parquet(src)
    time.sleep(1.1)
    spark.createDataFrame(day2, schema).coalesce(1).write.mode("append").parquet(src)
    stream = SJ.reading_stream(spark, src, max_files_per_trigger=1)
    marker = scratch_path(spark, "t-end-mark")

    def start(end_marker):
        return SJ.start_outlier_counts(stream, out, ckpt, "1 day", end_marker=end_marker)

    def counts():
        return sorted(((x.urn or "", x.timestamp, x.values_count, x.outliers_count)
                       for x in SS.read_table(spark, out).collect()))

    SJ.run_bounded(stream, marker, start)
    assert counts() == [("s", 0, 10, 1), ("s", DAY, 1, 0)]  # no marker row; a reading of no sensor is in no cell
    SJ.run_bounded(stream, marker, start)                  # a retry adds nothing
    assert counts() == [("s", 0, 10, 1), ("s", DAY, 1, 0)]


def test_stream_without_seq_counts_equal_readings(spark):
    rows = [("s", 1.0, 1000)] * 9 + [("s", 50.0, 2000)] + [("t", 2.0, 1000)] * 3
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-noseq", "t-noseq-out", "t-noseq-ck"))
    spark.createDataFrame(rows, "urn string, value double, timestamp long").repartition(3).write.parquet(src)
    stream = spark.readStream.schema("urn string, value double, timestamp long").parquet(src)
    SJ.run_bounded(stream, scratch_path(spark, "t-noseq-mark"),
                   lambda end_marker: SJ.start_outlier_counts(stream, out, ckpt, "1 day", end_marker=end_marker))
    got = sorted((x.urn, x.values_count, x.outliers_count) for x in SS.read_table(spark, out).collect())
    assert got == [("s", 10, 1), ("t", 3, 0)]


def test_batch_operators_without_seq(spark):
    r = X.readings(spark, SF001)
    plain = r.drop("seq")

    def rows(df):
        return sorted((x.urn, x.timestamp, round(x.value, 9)) for x in df.collect())

    # readings of one sensor at the same millisecond would differ only in the order of ties
    assert r.groupBy("urn", "timestamp").count().where("count > 1").isEmpty()
    assert rows(R.pairwise_avg(plain, "1 day")) == rows(R.pairwise_avg(r, "1 day"))
    signed = X.readings_signed(spark, SF001)
    assert rows(R.window_int_mean(signed.drop("seq"), "1 day")) == rows(R.window_int_mean(signed, "1 day"))
    shuffled = plain.unionByName(plain.limit(50)).repartition(5, "value")
    assert rows(R.pairwise_avg(shuffled, "1 day")) == rows(R.pairwise_avg(shuffled.repartition(2), "1 day"))


def test_int_mean_leaves_null_readings_out_at_every_size(spark):
    rows = [("s", v, 1000 * i, i) for i, v in enumerate([5.0, None, -2.0, 4.0, None, -1.0])] + [("t", None, 0, 9)]
    r = spark.createDataFrame(rows, "urn string, value double, timestamp long, seq long")
    want = [("s", 0, 1.0)]
    before = spark.conf.get("sensorlytics.skew.rowsPerTask", None)
    for limit in ("1000", "2"):
        spark.conf.set("sensorlytics.skew.rowsPerTask", limit)
        try:
            assert [tuple(x) for x in R.window_int_mean(r, "1 day").collect()] == want
        finally:
            spark.conf.unset("sensorlytics.skew.rowsPerTask") if before is None else spark.conf.set(
                "sensorlytics.skew.rowsPerTask", before)


def test_late_readings_fold_in_when_they_arrive(spark):
    schema = "urn string, value double, timestamp long, seq long"
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-late-pw", "t-late-pw-out", "t-late-pw-ck"))
    batches = [[("s", 1.0, 5000, 0), ("s", 2.0, 6000, 1), ("t", 7.0, 1, 2)], [("s", 8.0, 1000, 3)], [("s", 4.0, 2000, 4), ("u", 3.0, DAY, 5)]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(src)
        run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src), out, ckpt, "1 day"))

    def values():
        return {(x.urn, x.win): (x.value, x.k) for x in SS.read_latest(spark, out, ["urn", "win"]).collect()}

    want = {("s", 0): ((((1.0 + 2.0) / 2 + 8.0) / 2 + 4.0) / 2, 4), ("t", 0): (7.0, 1), ("u", DAY): (3.0, 1)}
    assert values() == want
    # the last batch again, as after a failure behind its output and before its commit
    jp = spark._jvm.org.apache.hadoop.fs.Path(f"{ckpt}/commits/2")
    assert jp.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jp, False)
    run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src), out, ckpt, "1 day"))
    assert values() == want


def test_processing_time_windows_follow_the_recorded_clock(spark):
    schema = "urn string, value double, timestamp long, seq long"
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-clock", "t-clock-out", "t-clock-ck"))
    for at, value in ((10_000, 1.0), (19_999, 3.0), (20_000, 5.0), (41_000, 9.0)):
        spark.createDataFrame([("s", value, 70_000 - at, int(value))], schema).coalesce(1).write.mode("append").parquet(src)
        run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src), out, ckpt, "1 day", processing_time_width="10 seconds",
                                      clock=lambda: at))
    got = {x.win: (x.value, x.timestamp) for x in SS.read_latest(spark, out, ["urn", "win"]).collect()}
    assert got == {10_000: (2.0, 50_001), 20_000: (5.0, 50_000), 40_000: (9.0, 29_000)}


def test_upsert_table_stays_small_over_fifty_batches(spark):
    path, write = scratch_path(spark, "t-upsert"), None
    write = SS.batch_writer(path, keys=["k"])
    want, most, old = {}, 0, None
    for b in range(50):
        rows = [(k, f"{b}") for k in range(b % 7, 20, 7)] + [(100 + b, "once")]
        write(spark.createDataFrame(rows, "k int, v string").coalesce(1), b)
        if b in (7, 22, 49):
            write(spark.createDataFrame(rows, "k int, v string").coalesce(1), b)  # a replayed batch
        want |= dict(rows)
        parts = SS.parts_of(spark, path)
        most = max(most, len(parts))
        if b == 15:
            old, seen = SS._versions(spark, parts), dict(want)  # a reader that has listed the folders
        if b == 16:
            assert {x.k: x.v for x in SS._latest(old, ["k"]).collect()} == seen
    assert {x.k: x.v for x in SS.read_latest(spark, path, ["k"]).collect()} == want
    assert {x.k: x.v for x in SS.read_latest(spark, path, ["k"], before=49).collect()} == {
        k: v for k, v in want.items() if v != "49" and k != 149} | {k: "42" for k in (0, 7, 14)}
    assert most <= 2 * (SS.FAN - 1)
    kept = len(SS._numbered(spark, path, "batch_id="))
    assert kept < 3 * SS.FAN


def test_a_replayed_batch_publishes_once(spark):
    path = scratch_path(spark, "t-messages")
    messages = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "3")], "routing_key string, payload string")
    for _ in range(2):
        SS.write_messages(messages, path, 0)
    SS.write_messages(messages.where("routing_key = 'b'"), path, 1)
    spark.range(1).selectExpr("'x' AS value").write.text(f"{path}/batch_id=2/routing_key=a")  # not committed as a batch
    got = sorted((x.routing_key, x.payload) for x in SS.read_messages(spark, path).collect())
    assert got == [("a", "1"), ("a", "2"), ("b", "3"), ("b", "3")]
    assert SS.read_messages(spark, scratch_path(spark, "t-none")).count() == 0


def test_stream_jobs_keep_state_in_rocksdb(spark):
    rows = [("hot", float(i % 50), 1000 + i, i) for i in range(3000)] + [("cold", 1.0, 5, 9999)]
    src, out, ckpt = (scratch_path(spark, n) for n in ("t-rocks", "t-rocks-out", "t-rocks-ck"))
    spark.createDataFrame(rows, "urn string, value double, timestamp long, seq long").write.parquet(src)
    q = SJ.start_outlier_counts(SJ.reading_stream(spark, src), out, ckpt, "1 day")
    run(q)
    assert spark.conf.get(SJ.STATE_STORE) == SJ.ROCKSDB and spark.conf.get(SJ.CHANGELOG) == "true"
    sizes = SJ.state_sizes(q)
    print("state of a hot sensor (batch, rows, bytes):", sizes)
    assert sizes[-1][1] == 3001  # every open reading is in state, on disk


def test_results_are_published_with_the_table(spark):
    from sensorlytics.sinks import publish as K
    rows = [("s", float(i), 1000 * i, i) for i in range(12)]
    src, out, ckpt, sent = (scratch_path(spark, n) for n in ("t-pub", "t-pub-out", "t-pub-ck", "t-pub-sent"))
    spark.createDataFrame(rows, "urn string, value double, timestamp long, seq long").write.parquet(src)
    run(SJ.start_pairwise_updates(SJ.reading_stream(spark, src), out, ckpt, "1 day", publish=(K.reading_csv_payload, sent)))
    row = SS.read_latest(spark, out, ["urn", "win"]).first()
    assert [x.payload for x in SS.read_messages(spark, sent).collect()] == [f"s,{row.value:.6f},0"]
