"""Registered queries against SQL where SQL can express them."""

import duckdb
import pytest

import __spark_entry__ as entry
from plumbline.llm import queries
from tests.test_oracle import KINDS, SF, bag


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, rows, name):
    got = entry.queries()[name](spark, SF)
    want = duck.execute(entry.oracle_sql()[name])
    columns, kinds = [d[0] for d in want.description], {d[0]: str(d[1]) for d in want.description}
    assert bag(got.columns, [tuple(r) for r in got.collect()]) == bag(columns, want.fetchall())
    assert {c: KINDS[t] for c, t in got.dtypes} == kinds


def test_every_query_is_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in names


def test_near_copies_of_a_small_fixture_match_sql(spark, documents):
    """Edges of the definition: short texts, equal sets of different texts, exactly four fifths, chains."""
    words = [f"w{i}" for i in range(60)]
    near = words[:56] + ["x0", "x1", "x2", "x3"]
    far = near[:40] + ["y"] * 4 + near[44:]
    nine = " ".join(words[:13])  # nine shingles; one word less leaves eight of nine
    pairs = [
        (1, " ".join(words)), (2, " ".join(near)), (3, " ".join(far)), (4, "One two"), (5, "one, TWO"), (6, "one"), (7, ""), (8, None), (9, "!!!"), (10, ""),
        (11, nine), (12, nine + " more"), (13, " ".join(words[:12])), (14, " ".join(words).upper()), (15, "one two three four five"), (16, "a a a a a a a a"), (17, "a a a a a"),
    ]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", pairs)
    want = con.execute(queries.ORACLES["op9_jaccard"])
    columns = [d[0] for d in want.description]
    from plumbline.llm import jaccard

    got = jaccard.similar(documents(*pairs))
    assert bag(got.columns, [tuple(r) for r in got.collect()]) == bag(columns, want.fetchall())
