"""Registered queries of the subpackage on the smallest tables: SQL where there is some, contract columns elsewhere."""

import hashlib
import zlib

import duckdb
import pytest

from corpuskit.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    db = duckdb.connect()
    for t in ("documents", "pages"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = db.sql(queries.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    at = [want.columns.index(c) for c in columns]
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(tuple(r[i] for i in at) for r in want.fetchall())


def test_media_contract(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.QUERIES["op4_media"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        payload = t + b" " * (-len(t) % 192 or (0 if t else 192))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]))
