"""Every registered query outside the corpus operators against its DuckDB counterpart, and the rows of those without one."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import subprocess
import sys

import duckdb
import pytest

from tidemark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    yield con
    con.close()


def plain(v):
    """One form for the values of both engines; floats to nine digits."""
    if isinstance(v, (bool, str)) or v is None:
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        return None if math.isnan(v) else float(f"{float(v):.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if isinstance(v, datetime.date) and not isinstance(v, datetime.datetime):
        v = datetime.datetime(v.year, v.month, v.day)
    return v.isoformat() if isinstance(v, datetime.datetime) else v


def table(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_duckdb(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    result = duck.execute(ORACLES[name])
    assert table(df.columns, df.collect()) == table([c[0] for c in result.description], result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_import_needs_no_session():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()) >= len(e.oracle_sql()) > 100)"], cwd=root, capture_output=True, text=True)
    assert said.stdout.split()[-1:] == ["True"], said.stderr
