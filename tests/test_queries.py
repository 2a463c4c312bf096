"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import os

import pytest

from checks import all_queries, compare
from checks.registry import ORACLES, QUERIES

FOLDER = os.environ.get("ITINERA_TEST_DATA", "/root/testdata/sf0.001")
all_queries()


@pytest.fixture(scope="module")
def duck():
    con = compare.connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    ok, note = compare.run_one(spark, duck, FOLDER, name)
    assert ok, note


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
