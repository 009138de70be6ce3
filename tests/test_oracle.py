"""Every key with an oracle: Spark result == DuckDB result (rows, columns, values)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_CHECK, SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


#: The smallest tables leave these fewer rows than coefficients.
LARGER = {"ols_multi", "ols_multi_fit"}


def views(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return c


@pytest.fixture(scope="module")
def cons():
    return {sf_dir: views(sf_dir) for sf_dir in (SF_SMALL, SF_CHECK)}


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, cons, key):
    sf_dir = SF_CHECK if key in LARGER else SF_SMALL
    df = E.queries()[key](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = cons[sf_dir].execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, rows) == _rows(ocols, orows)


def test_every_oracle_key_is_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["rank", "est_id", "est_name", "headcount", "annual_pay_10k"]
    assert df.count() >= 0
