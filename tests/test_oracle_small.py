"""Registered queries against their DuckDB oracle on the smallest data folder."""

import duckdb
import pytest

import __spark_entry__ as E

from tools.check_oracle import TABLES, rows_of  # noqa: E402

NAMES = sorted(E.catalog.ORACLE)


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_most_an_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    own = E.catalog.QUERIES            # the billing queries; the optional part has tests of its own
    assert len(set(sql) & set(own)) >= len(own) - 3


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name, sf_small):
    sdf = E.queries()[name](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert rows_of(sdf.columns, srows) == rows_of(ocols, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "amount" in df.columns


def test_bill_rerun_is_idempotent(spark, sf_small):
    rows = E.queries()["day_replace_sink"](spark, sf_small).count()
    assert rows == E.queries()["itemized_bill"](spark, sf_small).count()


def test_every_oracle_plans_in_duckdb(con):
    for name, sql in E.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")          # raises on any syntax or binding error
