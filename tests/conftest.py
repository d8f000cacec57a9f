import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sensorlytics.session import get_session
    s = get_session("local[*]", app_name="sensorlytics-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def conf(spark):
    """Set session confs for one test and restore them afterwards."""
    saved = {}

    def set_(key, value):
        if key not in saved:
            saved[key] = spark.conf.get(key, None)
        spark.conf.set(key, str(value))

    yield set_
    for k, v in saved.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def cell(spark, values, urn="u", win=0, start_ts=0, step=1000):
    """Readings of one cell, in time order."""
    rows = [(urn, float(v), start_ts + i * step, i, win) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "urn string, value double, timestamp long, seq long, win long")
