"""Every driver query against its DuckDB oracle on the smallest test data."""

import os
from functools import partial

import duckdb
import pytest

from tests.oracle_compare import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _names():
    import __spark_entry__ as E
    from parcelbeam.plans.queries import QUERIES
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) >= set(QUERIES)
    return list(QUERIES)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    import __spark_entry__ as E
    df = E.queries()[name](spark, SF)
    s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    sql = E.oracle_sql()[name]
    res = con.execute(sql)
    o_cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(o_cols)
    assert s_rows == rows_of(o_cols, res.fetchall())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "model_ratio" in df.columns


RATIO_QUERIES = ["ratio_town_stats", "ratio_deciles", "neighborhood_medians_long", "strict_vs_lenient_median"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", RATIO_QUERIES)
def test_many_selection_rounds_match_oracle(spark, con, name, monkeypatch):
    """The same queries with small ranges and few parts, so that ranks take several rounds."""
    import __spark_entry__ as E
    from parcelbeam.operators import ratio
    monkeypatch.setattr(ratio, "select_ranks", partial(ratio.select_ranks, most=3, buckets=4))
    df = E.queries()[name](spark, SF)
    s_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[name])
    o_cols = [d[0] for d in res.description]
    assert s_rows == rows_of(o_cols, res.fetchall())
