"""Every query with a SQL twin gives the same rows; the others return rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from cohortflow.plans.catalog import ORACLE, QUERIES
from tests import oracle

# full-size fits of minutes each; the driver's correctness run covers them
SLOW = {"model_comparison", "tuned_comparison", "three_scorer_selection", "grid_search", "train_model", "fit_gbt", "fit_hist_gbt"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def test_keys():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 75


@pytest.mark.parametrize("name", sorted(set(ORACLE) - SLOW))
def test_same_rows(spark, sf_dir, con, name):
    assert oracle.compare(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE) - SLOW))
def test_gives_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    assert entry(spark).limit(5).count() == 5
