"""Every oracle-checked key matches its DuckDB twin (sf0.001)."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SMALL
from tools.check_oracle import digest

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, duck, key):
    df = entry.queries()[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows)[0] == digest(ocols, orows)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["IsDepDelayed", "n"]
    assert df.count() >= 1


def test_every_key_has_a_callable():
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    assert len(qs) >= 98
