import duckdb
import pytest

import __spark_entry__ as entry
from tests.test_oracle import SF, TABLES


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


@pytest.fixture(scope="session")
def rows(spark):
    """Rows of a registered query, run once per session."""
    kept = {}

    def run(name):
        if name not in kept:
            kept[name] = entry.queries()[name](spark, SF).collect()
        return kept[name]

    return run


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, with the other columns and some that clash with results."""

    def make(*pairs, **columns):
        rows = [(i, t, columns.get("lang", "en"), "s", None, 7, "x", True) for i, t in pairs]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int, digest string, row boolean"
        ).repartition(3)

    return make
