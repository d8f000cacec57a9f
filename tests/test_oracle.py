"""The correctness gate: every registered query against its DuckDB oracle at sf0.01."""

import pytest

from conftest import SF01  # noqa: F401
from oracle_harness import compare, duck
from __spark_entry__ import _QUERIES, _SQL, entry

_CON = {}


def _con():
    if "c" not in _CON:
        _CON["c"] = duck(SF01)
    return _CON["c"]


def test_every_query_has_an_oracle():
    assert set(_SQL) == set(_QUERIES)


@pytest.mark.parametrize("key", sorted(_QUERIES))
def test_query_matches_oracle(spark, key):
    r = compare(spark, key, SF01, _con())
    assert r["status"] == "match", r
    assert "types" not in r, r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["urn", "timestamp", "values_count", "outliers_count"]
    assert df.count() > 0
