"""Every registered engine query against its SQL, in DuckDB on the same files."""

from decimal import Decimal

import duckdb
import pytest

from millrace import queries as q

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def rows_of(cols, rows):
    plain = lambda v: float(v) if isinstance(v, Decimal) else round(v, 9) if isinstance(v, float) else v
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(plain(r[i]) for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(q.SQL))
def test_query_matches_sql(spark, sf, oracle, name):
    df = q.QUERIES[name](spark, sf)
    want = oracle.execute(q.SQL[name])
    cols = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, want.fetchall())


def test_every_query_is_registered(spark):
    import __spark_entry__ as e

    assert set(q.QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() == 1403


def test_byte_batches_follow_the_rules(spark, sf):
    rows = q.QUERIES["batch_assign_bytes"](spark, sf).orderBy("stream", "event_id").collect()
    assert rows
    by: dict = {}
    for r in rows:
        by.setdefault((r["stream"], r["batch"]), []).append(r["bytes"])
    for sizes in by.values():
        assert len(sizes) <= 100 and sum(sizes[:-1]) < 4096
