"""Every query with a SQL twin agrees with it at the smallest scale."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from tools.check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
FAST = [n for n in entry.oracle_sql() if n[0] in "efjksuw"] if Path(SF).exists() else []


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    assert compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_states_its_ids():
    from airq.plans.registry import QUERIES

    assert set(entry.oracle_sql()) <= set(entry.queries()) and all(q.ids for q in QUERIES.values())
