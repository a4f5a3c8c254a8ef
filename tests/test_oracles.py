"""Every core query against its DuckDB SQL on the smallest tables."""

import pytest
from oracle import differences

from millrace.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert differences(df, ORACLE[name], SF) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 200
    assert set(e.oracle_sql()) <= set(e.queries())
