"""Every registered query against its SQL on the smallest data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__  # noqa: E402
from linkharbor.catalog.queries import ORACLES, QUERIES  # noqa: E402
from compare import compare, connect  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_agrees_with_its_sql(spark, duck, key):
    verdict = compare(spark, duck, FOLDER, key)
    assert verdict.startswith("ok"), verdict


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
