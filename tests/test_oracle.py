"""Registered queries against their DuckDB SQL on the smallest scale (a quick subset by
default; OEEFLOW_FULL_ORACLE=1 runs every query that has SQL)."""

import os

import pytest

from tests.conftest import SF_SMALL
from tests.oracle_compare import compare, duck

QUICK = ["compute_oee", "oee_monthly_trend", "clean_raw_export", "iqr_filter", "quantiles", "features_inefficiency",
         "smooth_times", "add_oee_features", "temporal_split", "time_series_folds", "table_sort", "oee_kpis_by_period",
         "last_n_per_group", "histogram", "correlated_pairs"]


def _names():
    import __spark_entry__ as E
    sql = E.oracle_sql()
    if os.environ.get("OEEFLOW_FULL_ORACLE") == "1":
        return sorted(sql)
    return [q for q in QUICK if q in sql]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", _names())
def test_query_matches_sql(spark, con, name):
    import __spark_entry__ as E
    s = E.queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(E.oracle_sql()[name]).fetchdf()
    ok, msg = compare(s, d)
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0


def test_every_query_has_a_callable():
    import __spark_entry__ as E
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
