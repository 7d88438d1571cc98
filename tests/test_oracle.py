"""Every registered query against its DuckDB statement (sf0.001), as the driver does."""

import pytest

from conftest import SF_SMALL
from oracle_check import compare


@pytest.mark.parametrize("sf_dir", [SF_SMALL])
def test_all_queries_match_sql(spark, sf_dir):
    results = compare(spark, sf_dir, verbose=False)
    bad = {k: v for k, v in results.items() if v[0] not in ("OK", "NO-ORACLE")}
    assert not bad, bad
