"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import os

import pytest

from tests.compare import connect, differences
from workload import ORACLES, QUERIES, checks, galaxy
from workload.inputs import Galaxy

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def database():
    return connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def one_galaxy(spark):
    """The queries share staged tables here, as they would in a warehouse."""
    shared = Galaxy(spark, FOLDER)
    with pytest.MonkeyPatch.context() as patch:
        for module in (galaxy, checks):
            patch.setattr(module, "Galaxy", lambda *_: shared)
        yield


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, database, name):
    result = QUERIES[name](spark, FOLDER)
    assert differences(result, database, ORACLES[name]) is None
