"""Every registered query runs; those with a SQL twin give the same rows."""
import oracle
import pytest

from statement_spark.plans import catalogue

catalogue.load()


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_matches_sql(spark, con, sf_dir, name):
    ok, message = oracle.compare(spark, con, catalogue.QUERIES[name], catalogue.ORACLES[name], sf_dir)
    assert ok, message


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLES)))
def test_runs(spark, sf_dir, name):
    assert catalogue.QUERIES[name](spark, sf_dir).count() > 0
