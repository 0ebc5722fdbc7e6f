"""Every registered query against its DuckDB oracle (the driver's check, at
sf0.001 here to keep the suite quick; tools/check_oracle.py runs sf0.01)."""

import datetime as dt
import math

import pytest

import __spark_entry__ as E

SQL = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def test_every_query_registered_has_callable():
    q = E.queries()
    assert set(SQL) <= set(q)
    assert len(q) >= 45


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    from conftest import SF_SMALL
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck(SF_SMALL).execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, got) == _rows(ocols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Origin", "Dest", "Distance"]
    assert df.count() > 0
