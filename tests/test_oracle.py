"""Every registered query against its DuckDB oracle on the smallest tables."""
import pytest

from ledgerflow.plans.check import compare
from ledgerflow.plans.queries import ORACLE, QUERIES

from paths import SF_SMALL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    r = compare(QUERIES[name](spark, SF_SMALL), ORACLE[name], SF_SMALL)
    assert r["schema_match"] and r["match"], r


def test_every_query_has_an_oracle_or_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLE)):
        QUERIES[name](spark, SF_SMALL).count()
