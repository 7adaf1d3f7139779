from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marquee.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        master="local[4]",
        app_name="marquee-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="marquee-test-ckpt-")},
    )
    yield session
    session.stop()


def lines(spark, *text: str):
    return spark.createDataFrame([(t,) for t in text], "value string")


def rows(df, *cols):
    """Collected rows as sorted tuples (optionally a column subset)."""
    sel = df.select(*cols) if cols else df
    return sorted(tuple(r) for r in sel.collect())
