"""Every registered query equals its DuckDB oracle (rows, values, types) at sf0.001.
The sf0.01 run is ``python tools/oracle_check.py``."""

import decimal
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from storelens.plans.registry import QUERIES

from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _norm(rowset, cols):
    return Counter(tuple(r[c] for c in cols) for r in rowset)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_oracle(spark, con, key):
    df = queries()[key](spark, SF_SMALL)
    got = [r.asDict() for r in df.collect()]
    rel = con.execute(oracle_sql()[key])
    names = [d[0] for d in rel.description]
    want = [dict(zip(names, r)) for r in rel.fetchall()]
    cols = sorted(df.columns)
    assert cols == sorted(names)
    assert _norm(got, cols) == _norm(want, cols)


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "review_score" in df.columns


def test_decimal_outputs_list_is_in_sync(spark):
    from pyspark.sql import types as T

    from storelens.plans.oracle import DECIMAL_OUTPUTS
    from storelens.plans.registry import LIBRARY_QUERIES, QUERIES

    for key, fn in LIBRARY_QUERIES.items():
        dec = tuple(f.name for f in fn(spark, SF_SMALL).schema.fields
                    if isinstance(f.dataType, T.DecimalType))
        assert dec == DECIMAL_OUTPUTS.get(key, ()), key
        assert not any(isinstance(f.dataType, T.DecimalType)
                       for f in QUERIES[key](spark, SF_SMALL).schema.fields)
