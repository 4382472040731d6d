"""Every job with a SQL twin returns the same rows as DuckDB (sf0.001)."""

import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

SQL = E.oracle_sql()
JOBS = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR",
          "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}


def _spark_type(t):
    s = t.simpleString()
    if s in _TYPES:
        return _TYPES[s]
    if s.startswith("array<"):
        return _spark_type(t.elementType) + "[]"
    return s.split("<")[0].split("(")[0].upper()


def test_every_oracle_has_a_job():
    assert set(SQL) <= set(JOBS)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, duck, name):
    df = JOBS[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQL[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)
    rel = duck.sql(SQL[name])
    duck_types = {c: str(t).split("(")[0] for c, t in zip(rel.columns, rel.types)}
    for f in df.schema.fields:
        a, b = _spark_type(f.dataType), duck_types[f.name]
        if a.startswith(("MAP", "STRUCT")):
            assert b.startswith(a[:3])
        else:
            assert a == b, (name, f.name, a, b)


@pytest.mark.parametrize("name", sorted(set(JOBS) - set(SQL)))
def test_rows_only_jobs_run(spark, name):
    df = JOBS[name](spark, SF_SMALL)
    assert df.count() >= 0
