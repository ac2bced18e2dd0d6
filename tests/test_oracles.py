import pytest

from gleanworks.plans import packs  # noqa: F401
from gleanworks.plans.catalog import ORACLES, QUERIES
from oracle import check


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf_dir, name):
    check(spark, sf_dir, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0
