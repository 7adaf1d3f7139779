"""Registered queries against their DuckDB SQL, and the registration itself."""

from __future__ import annotations

import __spark_entry__ as E
from check_oracle import compare
from marquee.llm import catalog
from tables import sf_dir  # noqa: F401


def test_registered_names():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) <= set(E.queries())
    numbers = sorted(int(q[2:].split("_")[0]) for q in catalog.queries() if q.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in catalog.queries()


def test_queries_match_their_sql(spark, sf_dir):
    found = compare(spark, sf_dir, sorted(catalog.oracle_sql()))
    assert not {n: r for n, r in found.items() if not r.get("value_match")}
