"""Ingest (strict / lenient / CSV / JSON), payloads, and the round trip between them."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sensorlytics.sinks import publish as K
from sensorlytics.sources import ingest as I

STRICT_LINES = [
    ("a,1.5,100", ("a", 1.5, 100)),
    ("b; 2.5;  200", ("b", 2.5, 200)),
    ("c,3,300,", ("c", 3.0, 300)),        # trailing delimiter is ignored
    ("c2,3,300; , ", ("c2", 3.0, 300)),
    (",1,2", ("", 1.0, 2)),               # a leading empty field is still a field
    ("d,x,1", "bad_value"),
    ("e,1,y", "bad_timestamp"),
    ("f,1,2,3", "field_count"),
    ("g,1,", "field_count"),              # trailing empty field dropped: two fields
    ("g2,1, ", "field_count"),
    ("h,NaN,5", "non_finite_value"),
    ("i,,5", "bad_value"),
    ("", "field_count"),
]


def _lines(spark, items):
    return spark.createDataFrame([(i, x[0]) for i, x in enumerate(items)], "seq long, line string")


def test_strict_quarantine(spark):
    good, rej = I.parse_readings(_lines(spark, STRICT_LINES), "uvt")
    got = {r.seq: (r.urn, r.value, r.timestamp) for r in good.collect()}
    bad = {r.seq: r.reason for r in rej.collect()}
    for i, (_, want) in enumerate(STRICT_LINES):
        if isinstance(want, tuple):
            assert got[i] == want
        else:
            assert bad[i] == want
    assert len(got) + len(bad) == len(STRICT_LINES)


def test_strict_order_utv(spark):
    good, rej = I.parse_readings(_lines(spark, [("a,100,1.5", None)]), "utv")
    assert [(r.urn, r.value, r.timestamp) for r in good.collect()] == [("a", 1.5, 100)]
    with pytest.raises(ValueError):
        I.parse_readings(_lines(spark, [("a,1,2", None)]), "xyz")


def test_strict_failfast(spark):
    ok, _ = I.parse_readings(_lines(spark, [("a,1,2", None)]), "uvt", mode="failfast")
    assert ok.count() == 1
    bad, _ = I.parse_readings(_lines(spark, [("a,1,2", None), ("b,x,2", None)]), "uvt", mode="failfast")
    with pytest.raises(PySparkException):
        bad.collect()


def test_lenient(spark):
    items = [("a,1.5,100", None), ("b,x,200", None), ("c,1,y", None), ("d,1,2,extra", None), ("e,1", None),
             ("f;1;2", None), ("g,1,,", None), ("h,1, ", None), ("k,1,,5", None)]
    good, rej = I.parse_readings(_lines(spark, items), "uvt", strict=False)
    got = {r.urn: (r.value, r.timestamp) for r in good.collect()}
    assert got == {"a": (1.5, 100), "b": (0.0, 200), "c": (1.0, 0), "d": (1.0, 2), "h": (1.0, 0), "k": (1.0, 0)}
    assert sorted(r.seq for r in rej.collect()) == [4, 5, 6]


def test_counts_json(spark):
    msgs = spark.createDataFrame([
        ('{"urn":"a","timestamp":5,"valuesCount":3,"outliersCount":1}',),
        ('{"urn":"b","timestamp":6,"valuesCount":2,"outliersCount":0,"extra":1}',),
        ('not json',), ('{"timestamp":7}',)], "payload string")
    good, rej = I.parse_counts_json(msgs)
    assert sorted((r.urn, r.timestamp, r.values_count, r.outliers_count) for r in good.collect()) == [
        ("a", 5, 3, 1), ("b", 6, 2, 0)]
    assert rej.count() == 2


def test_payloads(spark):
    lvl1 = spark.createDataFrame([("a", 10, 5, 1)], "urn string, timestamp long, values_count long, outliers_count long")
    assert K.counts_payload(lvl1).first().payload == '{"urn":"a","timestamp":10,"valuesCount":5,"outliersCount":1}'
    l2 = spark.createDataFrame([("a", 10, 12, 2)],
                               "urn string, timestamp long, values_count long, outliers_on_values_count long")
    assert K.on_values_payload(l2).first().payload == \
        '{"urn":"a","timestamp":10,"valuesCount":12,"outliersOnValuesCount":2}'
    assert K.on_values_payload(l2, wire_compat=True).first().payload == \
        '{"urn":"a","timestamp":10,"valuesCount":0,"outliersOnValuesCount":2}'
    l3 = spark.createDataFrame([("a", 10, 12, 3)],
                               "urn string, timestamp long, outliers_count long, outliers_on_outliers_count long")
    assert K.on_outliers_payload(l3).first().payload == \
        '{"urn":"a","timestamp":10,"outliersCount":12,"outliersOnOutliersCount":3}'
    r = spark.createDataFrame([("a", 6.55, 12345)], "urn string, value double, timestamp long")
    m = K.reading_csv_payload(r).first()
    assert (m.routing_key, m.payload) == ("readings", "a,6.550000,12345")


def test_csv_payload_round_trip(spark):
    r = spark.createDataFrame([("a", 6.55, 12345), ("b", -1.25, 7)], "urn string, value double, timestamp long")
    lines = K.reading_csv_payload(r).select(F.col("payload").alias("line"))
    good, rej = I.parse_readings(lines, "uvt")
    assert rej.count() == 0
    assert sorted(good.collect()) == sorted(r.collect())


def test_counts_json_round_trip(spark):
    lvl1 = spark.createDataFrame([("a", 10, 5, 1), ("b", 20, 7, 0)],
                                 "urn string, timestamp long, values_count long, outliers_count long")
    good, _ = I.parse_counts_json(K.counts_payload(lvl1))
    assert sorted(good.select(*lvl1.columns).collect()) == sorted(lvl1.collect())


def test_typed_csv_and_messages(spark, tmp_path):
    from sensorlytics.session import scratch_path
    r = spark.createDataFrame([("a", 1.5, 100), ("b", 2.0, 200)], "urn string, value double, timestamp long")
    p = scratch_path(spark, "t-csv")
    I.write_typed_csv(r, p)
    assert sorted(I.read_typed_csv(spark, p).collect()) == sorted(r.collect())
    m = scratch_path(spark, "t-msg")
    K.write_messages(K.reading_csv_payload(r), m)
    back = spark.read.text(m)
    assert sorted(x.value for x in back.collect()) == ["a,1.500000,100", "b,2.000000,200"]
    assert {x.routing_key for x in back.select("routing_key").collect()} == {"readings"}


@pytest.mark.parametrize("agg", ["sum(value)", "count(1)", "min(timestamp)"])
def test_failfast_fails_whatever_is_read(spark, agg):
    lines = spark.createDataFrame([("a,1.0,100",), ("garbage",)], "line string")
    good, _ = I.parse_readings(lines, "uvt", mode="failfast")
    with pytest.raises(Exception, match="malformed reading"):
        good.selectExpr(agg).collect()
