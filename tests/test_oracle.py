"""Every registered query against its DuckDB oracle on the smallest tables,
plus the driver's smoke check of ``entry``."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as E
from check_oracle import compare
from marquee.plans import catalog, oracle

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_kind", "title", "avg_rating", "n"]
    got = df.collect()
    assert got and got[-1].row_kind in ("top", "none")


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) == set(oracle.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle(spark):
    res = compare(spark, SF_DIR, sorted(catalog.queries()))
    bad = {n: r for n, r in res.items() if r.get("error") or (r["has_oracle"] and not r.get("value_match"))}
    assert not bad
