from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle_check import compare
from tracewell.plans import catalog

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the tables")
@pytest.mark.parametrize("name", ["technical_aliases", "specific_terms", "relation_edges", "url_policy", "discovery_candidates", "refresh_audit", "coverage", "preflight_errors"])
def test_same_as_sql(spark, name):
    assert compare(spark, name, catalog.QUERIES[name], catalog.SQL[name], DATA) is None


def test_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
