"""Every query with SQL equals it on the smallest tables; the others return rows."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from corpuskit import queries as library

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return float(v) if type(v).__name__ == "Decimal" else v


def table_of(rows):
    return sorted((tuple(plain(v) for v in r) for r in rows), key=repr)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(library.QUERIES))
def test_query(spark, db, name):
    df = library.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = table_of(df.select(*columns).collect())
    if name not in library.ORACLE_SQL:
        assert got
        return
    want = db.sql(library.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert got == table_of([[r[i] for i in at] for r in want.fetchall()])


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "decontam_funnel" in entry.queries()


def test_library_does_not_need_llm():
    import pathlib

    root = pathlib.Path(library.__file__).parent.parent
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "llm" not in path.read_text(), path
