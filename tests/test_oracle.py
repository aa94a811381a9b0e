"""Every named query against its SQL twin on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as entry
from lexifacet.plans import ORACLES, QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, _, _ = oracle.compare(spark, con, name, SF_DIR)
    assert problem is None, problem


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["doc_id", "weight", "lang", "n_chars"]
    assert 0 < df.count() <= 20


def test_each_twin_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"group_distinct_approx"}


def test_approximate_distinct_is_close(spark):
    rough = {x.group_key: x for x in entry.queries()["group_distinct_approx"](spark, SF_DIR).collect()}
    exact = {x.group_key: x for x in entry.queries()["group_distinct"](spark, SF_DIR).collect()}
    assert rough.keys() == exact.keys()
    for key, row in exact.items():
        assert rough[key].group_count == row.group_count
        assert abs(rough[key].group_distinct - row.group_distinct) <= 0.1 * row.group_distinct
