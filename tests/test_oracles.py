"""Every registered query against its SQL counterpart, on one shared job."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from footfall import registry
from footfall.job import Job

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def job(spark):
    return Job(spark, SF_DIR)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", registry.OUTPUTS)
def test_matches_sql(job, con, key):
    result = registry.present(getattr(job, key), registry.OUTPUTS[key])
    assert differences(result, con, registry.oracle(key)) == []
    assert not result.isEmpty()


def test_contract(spark):
    assert set(registry.OUTPUTS) <= set(contract.queries())
    assert set(registry.OUTPUTS) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["guid", "userid"]
    one = contract.queries()["identity_delta"](spark, SF_DIR)
    assert differences(one, connect(SF_DIR), contract.oracle_sql()["identity_delta"]) == []
