"""Every registered query with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as spark_entry
from catalog import ENTRIES  # the optional operators have tests of their own
from tools.check_queries import canonical

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in sorted(Path(FOLDER).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def test_names():
    names = [e.name for e in ENTRIES]
    assert len(names) == len(set(names))
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 2


@pytest.mark.parametrize("entry", [e for e in ENTRIES if e.sql], ids=lambda e: e.name)
def test_query_equals_sql(spark, duck, entry):
    df = entry.run(spark, FOLDER)
    cursor = duck.execute(entry.sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(columns, cursor.fetchall())
