"""Every registered query against its SQL, run by another engine on the same files."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def normal(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ("", "null")
    if isinstance(value, bool):
        return ("b", value)
    if isinstance(value, (int, float)):
        return ("n", round(float(value), 6))
    return ("s", str(value))


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(normal(r[i]) for i in order) for r in rows], key=repr)


KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


#: Queries of the library itself; those of the optional part are tested beside it.
OWN = sorted(entry._QUERIES)


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    assert rows
    want = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    kinds = {d[0]: str(d[1]) for d in want.description}
    assert sorted(got.columns) == sorted(columns)
    assert bag(got.columns, rows) == bag(columns, want.fetchall())
    assert {c: KINDS[t] for c, t in got.dtypes} == kinds


def test_entry_has_every_kind_of_check(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 47
    assert len({r.kind for r in rows}) == 42  # 40 expectations, the LIKE list and the SQL constraint
    assert all(r.success is not None for r in rows)


def test_every_query_has_its_sql():
    assert set(OWN) == set(entry._ORACLES)
