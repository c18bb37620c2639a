"""Every query equals its SQL in a second engine."""

import pytest
from compare import connect, difference

from changeflow.plans.oracle import ORACLE_SQL
from changeflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, ORACLE_SQL[name]) is None


def test_feed_has_the_known_counts(spark, sf_dir):
    if not sf_dir.endswith("sf0.001"):
        pytest.skip("counts are known for sf0.001")
    rows = QUERIES["change_summary"](spark, sf_dir).groupBy("_change_type").sum("rows").collect()
    assert dict(rows) == {"insert": 170, "update_preimage": 629, "update_postimage": 629, "delete": 158}
    assert QUERIES["current_snapshot"](spark, sf_dir).count() == 12
    assert QUERIES["apply_changes_scd2"](spark, sf_dir).count() == 748
