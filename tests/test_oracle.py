"""Every registered query against its SQL oracle (DuckDB) on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_all_queries_match_oracle(spark):
    from check_oracle import compare
    from orderlake import queries
    res = compare(spark, SF, names=list(queries.queries()), verbose=True)
    bad = {k: v for k, v in res.items() if not (v.startswith("OK") or v.startswith("no-oracle"))}
    assert not bad, bad


def test_every_query_has_an_oracle():
    from orderlake import oracle, queries
    assert set(queries.queries()) == set(oracle.oracle_sql())
