"""Every query with an SQL form, next to DuckDB; the others at least run."""

import pytest

from tideguard.plans import catalogue
from tools.check_oracles import compare, duck

SLOW = {"cv_grid", "train_gbt", "model_metrics_table",
        "model_roundtrip_scores", "train_lr_baseline"}


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - SLOW))
def test_query(spark, con, sf, name):
    verdict, detail = compare(spark, con, name, sf)
    assert verdict in ("ok", "rows"), detail


def test_every_oracle_has_its_query():
    assert set(catalogue.ORACLES) <= set(catalogue.QUERIES)


def test_entry(spark):
    import __spark_entry__ as driver
    assert driver.entry(spark).count() == 6
    assert set(driver.oracle_sql()) <= set(driver.queries())
