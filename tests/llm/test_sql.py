"""Every query with SQL matches it on the small tables."""

import pytest

import __spark_entry__ as entry
from emberstat.llm.queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tools.check_oracle import digest


def test_queries_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert sorted(k.split("_")[0] for k in QUERIES) == sorted(f"op{n}" for n in range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_duckdb(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLES[key])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert digest(df.columns, rows)[1] == digest(names, cur.fetchall())[1]
