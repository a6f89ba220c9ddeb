"""Every registered query against its DuckDB oracle at sf0.01 (the same
row-count + schema + order-insensitive value-hash check the verification
driver applies). Queries without an oracle get a rows-only smoke run."""

import pytest

import __spark_entry__ as entry
from hublytics.plans import catalog
from oracle.compare import compare, duck_connect
from tests.conftest import SF_CHECK

QUERIES = {n: f for n, f in entry.queries().items() if n in catalog.QUERIES}  # the library's own
ORACLE = {n: q for n, q in entry.oracle_sql().items() if n in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_CHECK)


def test_every_query_has_an_oracle_or_is_documented():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == []


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], ORACLE[name], SF_CHECK, con)
    assert r["match"], r


def test_sample_is_exact_size_and_deterministic(spark):
    a = QUERIES["sample_k"](spark, SF_CHECK).select("client_id").collect()
    b = QUERIES["sample_k"](spark, SF_CHECK).select("client_id").collect()
    assert len(a) == 100 and sorted(a) == sorted(b)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "success_rate_pct" in df.columns
