"""Every registered query against its SQL counterpart."""

import compare
import pytest

import __spark_entry__ as entry_points
from dealreports.registry.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, con, name):
    assert compare.differences(con, QUERIES[name](spark, sf_dir), ORACLE[name]) == ""


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


def test_entry_gives_the_closings_of_ten_months(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["kpi", "state", "month", "n"]
    assert df.count() == 10


def test_statuses_come_in_order(spark, sf_dir):
    found = [r[0] for r in QUERIES["status_catalogue"](spark, sf_dir).collect()]
    assert found == sorted(found, key=str.encode) and len(found) > 10
