"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from reclake.workloads.registry import ORACLES, QUERIES
from tests.compare import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_of_the_inventory_is_registered():
    wanted = {f"{letter}{n}" for letter, last in {
        "s": 10, "k": 8, "c": 11, "e": 10, "f": 7, "j": 8, "a": 8, "w": 9, "t": 5, "n": 5, "m": 11, "q": 13, "r": 6, "l": 6,
    }.items() for n in range(1, last + 1)}
    assert wanted == {name.split("_")[0] for name in QUERIES} and set(QUERIES) <= set(entry.queries())
    without_sql = {"m1_rating_model", "m2_two_heads", "m9_index_search"}
    assert set(QUERIES) - set(ORACLES) == without_sql and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    assert {row["split"] for row in entry.entry(spark).collect()} == {"train", "val", "test"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert result.count() > 0
    else:
        assert difference(result, duck, sql) == ""
